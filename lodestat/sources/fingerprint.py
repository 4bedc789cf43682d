"""Dataset record: size, schema, missing values and a content digest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.hashing import field_text
from lodestat.operators.counts import value_text
from lodestat.operators.fitted import quoted


def row_number_digest(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """48 bits of the row's md5 as a number."""
    names = list(columns) if columns is not None else df.columns
    parts = [field_text(value_text(c, df.schema[c].dataType)) for c in names]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("decimal(38,0)")


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, source: str | None = None) -> DataFrame:
    """Row count, cell count and a digest that ignores row order and partitioning."""
    names = list(columns) if columns is not None else df.columns
    summed = df.select(row_number_digest(df, names).alias("d")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("d"), F.lit(0)).cast("decimal(38,0)").alias("digest")
    )
    record = summed.select("n_rows", (F.col("n_rows") * len(names)).alias("n_elements"),
                           F.col("digest").cast("string").alias("digest"))
    return record.withColumn("source", F.lit(source)) if source else record


def column_record(df: DataFrame) -> DataFrame:
    """``(column, dtype, required)``: a column without missing values is required."""
    row = df.agg(*[F.count_if(quoted(c).isNull()).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                 (F.col(f"c{i}") == 0).alias("required"))
        for i, f in enumerate(df.schema.fields)
    ])))
