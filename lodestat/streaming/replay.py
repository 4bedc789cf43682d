"""A table as a file stream, its rows in the order of their times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.fitted import quoted
from lodestat.session import scratch_path

# Rows of a file, about, and files a batch reads.  A batch is of one size whatever the table.
FILE_ROWS = 250_000
BATCH_FILES = 8


def write_in_order(rows: DataFrame, ts: str, ties: list[str], source: str) -> int:
    """Write ``rows`` to numbered folders below ``source``, a file each, later times later, and return their number.

    A file stream on ``source/*`` reads the oldest file first, so however many files a batch has
    (``maxFilesPerTrigger``), no row of a later batch is earlier than one of a batch before, and
    none is late.  Rows of one time are divided by ``ties``.
    """
    spark, path = rows.sparkSession, scratch_path(rows.sparkSession, "ordered")
    number = max(1, -(-rows.count() // FILE_ROWS))
    ranged = rows.repartitionByRange(number, quoted(ts), *[quoted(c) for c in ties]).withColumn("__file", F.spark_partition_id())
    ranged.write.partitionBy("__file").parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path)
    files = sorted(r[0] for r in placed.select("__file").distinct().collect())
    # One after another: a stream goes by the time at which a file was written.
    for n, file in enumerate(files):
        placed.filter(F.col("__file") == file).drop("__file").coalesce(1).write.parquet(f"{source}/{n:06d}")
    return len(files)
