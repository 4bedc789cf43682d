"""Windowed stability monitor on a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestat.operators.counts import long_values
from lodestat.operators.drift import baseline_counts, psi_against
from lodestat.operators.fitted import quoted


def count_windows(
    records: DataFrame, ts: str, columns: Sequence[str], out: str, checkpoint: str,
    width: str = "1 day", late: str = "1 day", available_now: bool = True,
) -> StreamingQuery:
    """Write the category counts of every window to ``out`` as they grow.

    State holds one counter per open window, column and value; the watermark
    closes windows and drops later rows.  Each batch writes the counters it changed
    to a folder of its own, which a repeated batch overwrites; so the last windows,
    which nothing closes, are there as well.
    """
    stamped = records.select(quoted(ts).cast("timestamp").alias("__ts"), *[quoted(c) for c in columns])
    watched = stamped.withWatermark("__ts", late)
    cells = long_values(watched, columns, [F.col("__ts")], digest=True).filter(F.col("value").isNotNull())
    counts = cells.groupBy(F.window("__ts", width).alias("w"), "column", "value").agg(
        F.count(F.lit(1)).alias("n_a")
    ).select(F.col("w.start").alias("window_start"), "column", "value", "n_a")

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def monitor(spark: SparkSession, counted_path: str, baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Index per window from the counts written so far."""
    written = spark.read.schema("window_start timestamp, column string, value string, n_a bigint").parquet(counted_path)
    # Counts only grow, so the largest is the latest.
    counted = written.groupBy("window_start", "column", "value").agg(F.max("n_a").alias("n_a"))
    return psi_against(baseline_counts(baseline, columns), counted)
