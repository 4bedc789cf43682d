"""Table zones: where raw, interim and processed tables live."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.text import CSV_NULLS, null_if_token
from lodestat.operators.fitted import quoted
from lodestat.sources.snapshots import SnapshotTable

# Default table names.
INTERIM_NAME, PROCESSED_NAME = "clean", "features"
# Bytes of a CSV file that may be one task unasked.
MULTILINE_BYTES = 256 << 20


def read_csv(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None,
    null_tokens: Sequence[str] = CSV_NULLS, multiline: bool | None = None,
) -> DataFrame:
    """Read a CSV with header, every column as text, null tokens as NULL.

    Types are decided later by the typing operator.  ``columns`` are found by their
    names in the header, in whatever order the file has them.  Line breaks inside
    quotes belong to the value; a file is then one task.  ``multiline=False``, for files
    without such breaks, lets several tasks share a file; unless one of the two is
    chosen, a file of more than ``MULTILINE_BYTES`` is refused.
    """
    if multiline is None:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0  # sizes only, no content
        if largest > MULTILINE_BYTES:
            raise ValueError(f"{path} holds a file of {largest} bytes, which would be one task: pass multiline=False if no value has a "
                             "line break, multiline=True to read it so")
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline is not False)
    raw = reader.csv(path)
    names = raw.columns if columns is None else list(columns)
    return raw.select(*[null_if_token(quoted(c), tuple(null_tokens)).alias(c) for c in names])


def read_if_exists(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The table, or None when the path does not exist."""
    try:
        return read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Zones:
    """Locations below one root; Spark creates folders on write."""

    root: str

    def path(self, zone: str, name: str) -> str:
        return f"{self.root.rstrip('/')}/{zone}/{name}"

    def load(self, spark: SparkSession, zone: str, name: str, version: int | None = None) -> DataFrame:
        """The newest version, or the one asked for; a folder written by others is read as it is."""
        table = SnapshotTable(self.path(zone, name))
        return table.load(spark, version) if table.latest(spark) else spark.read.parquet(table.path)

    def load_interim(self, spark: SparkSession, name: str = INTERIM_NAME) -> DataFrame:
        return self.load(spark, "interim", name)

    def load_processed(self, spark: SparkSession, name: str = PROCESSED_NAME) -> DataFrame:
        return self.load(spark, "processed", name)

    def load_original_if_exists(self, spark: SparkSession, name: str) -> DataFrame | None:
        return read_if_exists(spark, self.path("raw", name))

    def save_interim(self, df: DataFrame, name: str = INTERIM_NAME) -> str:
        return self._save(df, "interim", name)

    def save_processed(self, df: DataFrame, name: str = PROCESSED_NAME) -> str:
        return self._save(df, "processed", name)

    def _save(self, df: DataFrame, zone: str, name: str) -> str:
        """Publish a new version: the table may be read from its own name, and a failed write changes nothing."""
        path = self.path(zone, name)
        SnapshotTable(path).save(df)
        return path


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return path


def features_and_target(df: DataFrame, target: str, out: str = "label") -> DataFrame:
    """Keep features and target in one table, the target named ``out``.

    The two are never separated: rows have no position to pair them by again.
    """
    return df.select(*[quoted(c) for c in df.columns if c != target], F.col(f"`{target}`").alias(out))
