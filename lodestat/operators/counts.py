"""The shared long count frame: one row per (column, value).

Cardinality, category tables, modes, target shares and drift all start from this
frame.  Rows are counted before the shuffle, so a value that holds a third of
the table crosses the network as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.numbers import is_floating, present
from lodestat.operators.fitted import quoted

# Texts longer than this are compared by digest when only identity matters.
LONG_TEXT = 64


def value_text(name: str, dtype: T.DataType) -> Column:
    """A column as text for grouping: NaN is missing, -0.0 equals 0.0."""
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.when(quoted(name).isNotNull(), F.to_json(F.struct(quoted(name).alias("v"))))
    col = present(name, dtype)
    return (col + F.lit(0.0) if is_floating(dtype) else col).cast("string")


def cell_text(name: str, dtype: T.DataType, digest: bool) -> Column:
    value = value_text(name, dtype)
    if digest and isinstance(dtype, T.StringType):
        # The mark makes a digest longer than any text that stays as it is, so the two never meet.
        value = F.when(F.length(value) > LONG_TEXT, F.concat(F.lit("sha256:"), F.sha2(value, 256))).otherwise(value)
    return value.alias(name)


def long_values(
    df: DataFrame, columns: Sequence[str], ids: Sequence[Column] = (), digest: bool = False
) -> DataFrame:
    """One row per cell: ``(*ids, column, value)``."""
    types = {f.name: f.dataType for f in df.schema.fields}
    if not columns:
        return df.limit(0).select(*ids, F.lit("").alias("column"), F.lit(None).cast("string").alias("value"))
    # Ids come first under positional names, so they can never clash with a data column.
    id_frame = df.select(*ids).schema.names if ids else []
    marked = [col.alias(f"__id{i}") for i, col in enumerate(ids)]
    wide = df.select(*marked, *[cell_text(c, types[c], digest) for c in columns])
    cells = wide.unpivot(
        [F.col(f"__id{i}") for i in range(len(ids))], [quoted(c) for c in columns], "__column", "__value"
    )
    return cells.select(
        *[F.col(f"__id{i}").alias(name) for i, name in enumerate(id_frame)],
        F.col("__column").alias("column"),
        F.col("__value").alias("value"),
    )


def value_counts(
    df: DataFrame, columns: Sequence[str], ids: Sequence[Column] = (), digest: bool = False
) -> DataFrame:
    """``(*ids, column, value, n)``; NULL is a value of its own."""
    cells = long_values(df, columns, ids, digest)
    return cells.groupBy(*[quoted(c) for c in cells.columns]).agg(F.count(F.lit(1)).alias("n"))


def position_of(columns: Sequence[str], column: Column) -> Column:
    """0-based schema position of a column name held as data."""
    return (F.array_position(F.array(*[F.lit(c) for c in columns]), column) - F.lit(1)).cast("int")
