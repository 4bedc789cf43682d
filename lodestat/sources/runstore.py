"""Run records: the long metric table and the folder-per-run text store."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestat.operators.fitted import join_fitted
from lodestat.operators.runs import safe_name
from lodestat.sources.snapshots import SnapshotTable

RECORD = (
    "experiment_id string, run_id string, kind string, name string, value string, ts timestamp, run_date date"
)


def _part(position_from_end: int) -> Column:
    return F.element_at(F.split(F.col("path"), "/"), -position_from_end)


def _lines(spark: SparkSession, glob: str) -> DataFrame:
    return spark.read.text(glob).select("value", F.col("_metadata.file_path").alias("path"))


def read_metrics(spark: SparkSession, root: str) -> DataFrame:
    """Metric files ``<root>/<experiment>/<run>/metrics/<name>`` of ``timestamp value step`` lines."""
    return _metric_rows(_lines(spark, f"{root}/*/*/metrics/*"))


def _metric_rows(lines: DataFrame) -> DataFrame:
    words = F.split(F.col("value"), " ")
    return lines.select(
        _part(4).alias("experiment_id"), _part(3).alias("run_id"),
        F.url_decode(_part(1)).alias("name"),
        words[0].try_cast("bigint").alias("ts"), words[1].try_cast("double").alias("value"),
        F.coalesce(F.get(words, 2).try_cast("bigint"), F.lit(0)).alias("step"),
    )


METRIC = "experiment_id string, run_id string, name string, ts bigint, value double, step bigint"


def sync_metrics(spark: SparkSession, root: str, store: str, checkpoint: str) -> StreamingQuery:
    """Read the metric files that came since the last call into ``store``, a folder for each batch.

    The checkpoint knows the files read; a batch that is run again overwrites its folder.  A
    file is read once, when it appears, so a value logged later belongs in a file of its own
    (any name after a ``@`` in the file's name counts as a further part of the metric).
    """
    lines = spark.readStream.schema("value string").text(f"{root}/*/*/metrics/*").select("value", F.col("_metadata.file_path").alias("path"))

    def write(batch: DataFrame, number: int) -> None:
        _metric_rows(batch).withColumn("name", F.split_part("name", F.lit("@"), F.lit(1))).write.mode("overwrite").parquet(f"{store}/new/batch={number}")

    return lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _latest(metrics: DataFrame) -> DataFrame:
    """The last logged value of every metric of a run."""
    best = F.max(F.struct("step", "ts", "value")).alias("last")
    return metrics.groupBy("experiment_id", "run_id", "name").agg(best, F.max("batch").alias("batch")).select(
        "experiment_id", "run_id", "name", "last.ts", "last.value", "last.step", "batch")


def read_synced(spark: SparkSession, store: str) -> DataFrame:
    """The last value of every metric: the compacted table and the batches since, by the same rule."""
    table = SnapshotTable(f"{store}/table")
    parts = []
    upto = -1
    if table.latest(spark):
        done = table.load(spark)
        upto = done.agg(F.max("batch")).first()[0]
        parts.append(done)
    new = spark.read.schema(f"{METRIC}, batch bigint").parquet(f"{store}/new")
    parts.append(new.filter(F.col("batch") > F.lit(upto if upto is not None else -1)))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return _latest(rows)


def compact(spark: SparkSession, store: str) -> int:
    """Merge the batches so far into a new version of the table; later reads take only the batches after it."""
    table = SnapshotTable(f"{store}/table")
    base = table.latest(spark)
    return table.save(read_synced(spark, store), after=base)


def read_texts(spark: SparkSession, root: str, kind: str) -> DataFrame:
    """Parameter or tag files, one value per file."""
    return _lines(spark, f"{root}/*/*/{kind}/*").select(
        _part(4).alias("experiment_id"), _part(3).alias("run_id"), F.url_decode(_part(1)).alias("name"), "value"
    )


def _yaml_fields(lines: DataFrame) -> DataFrame:
    pair = F.split(F.col("value"), ": ", 2)
    return lines.filter(F.col("value").rlike("^[A-Za-z_]+: ")).select(
        "path", pair[0].alias("name"), F.trim(F.regexp_replace(pair[1], "^['\"]|['\"]$", "")).alias("text")
    )


def read_runs(spark: SparkSession, root: str) -> DataFrame:
    """``(experiment_id, run_id, run_name, status, end_time)`` from the run descriptions."""
    fields = _yaml_fields(_lines(spark, f"{root}/*/*/meta.yaml"))
    pick = lambda n: F.max(F.when(F.col("name") == n, F.col("text")))
    return fields.groupBy(_part(3).alias("experiment_id"), _part(2).alias("run_id")).agg(
        pick("run_name").alias("run_name"), pick("status").alias("status"),
        pick("end_time").try_cast("bigint").alias("end_time"),
    )


def read_experiments(spark: SparkSession, root: str) -> DataFrame:
    fields = _yaml_fields(_lines(spark, f"{root}/*/meta.yaml"))
    return fields.filter(F.col("name") == "name").select(_part(2).alias("experiment_id"), F.col("text").alias("experiment"))


def append_records(records: DataFrame, path: str) -> None:
    """Append report or run rows ``(experiment_id, run_id, kind, name, value)``, stamped and kept by day."""
    stamped = records if "ts" in records.columns else records.withColumn("ts", F.current_timestamp())
    stamped.withColumn("run_date", F.to_date("ts")).write.mode("append").partitionBy("run_date").parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(path)


def latest_records(records: DataFrame) -> DataFrame:
    """The rows of the newest run of every experiment; on equal times the larger run id."""
    newest = records.groupBy("experiment_id").agg(F.max_by("run_id", F.struct("ts", "run_id")).alias("run_id"))
    return join_fitted(records, newest, ["experiment_id", "run_id"], "left_semi")


def write_by_experiment(df: DataFrame, path: str, experiment: str = "experiment") -> str:
    """One output folder per experiment, its name made safe for a path."""
    named = df.withColumn("experiment_safe", safe_name(F.col(experiment)))
    named.write.mode("overwrite").partitionBy("experiment_safe").parquet(path)
    return path


def metric_records(metrics: DataFrame, experiment_id: str, run_id: str, kind: str = "metric") -> DataFrame:
    """A one-row metric frame as long records."""
    names = metrics.columns
    return metrics.select(*[F.col(c).cast("string").alias(c) for c in names]).unpivot([], names, "name", "value").select(
        F.lit(experiment_id).alias("experiment_id"), F.lit(run_id).alias("run_id"), F.lit(kind).alias("kind"),
        "name", "value",
    )


def text_records(spark: SparkSession, values: Mapping[str, object], experiment_id: str, run_id: str, kind: str) -> DataFrame:
    """Parameters or tags of a run as long records; None is left out."""
    rows = [(experiment_id, run_id, kind, name, str(value)) for name, value in values.items() if value is not None]
    return spark.createDataFrame(rows, "experiment_id string, run_id string, kind string, name string, value string")


def log_run(spark: SparkSession, path: str, experiment_id: str, run_id: str, metrics: DataFrame, params: Mapping[str, object],
            tags: Mapping[str, object] | None = None) -> None:
    """Append a whole run at once: its metrics (one row), parameters and tags share one time."""
    rows = metric_records(metrics, experiment_id, run_id)
    for kind, values in (("param", params), ("tag", tags or {})):
        rows = rows.unionByName(text_records(spark, values, experiment_id, run_id, kind))
    append_records(rows, path)
