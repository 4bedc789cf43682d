"""Bringing small fitted tables to the driver, with their size checked."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from lodestat.session import materialize

# A fitted table within both bounds is pinned as a local relation and broadcast.
PIN_ROWS = 100_000
PIN_BYTES = 32 << 20


def pin(df: DataFrame, max_rows: int = PIN_ROWS) -> tuple[DataFrame, bool]:
    """Return ``(table, pinned)``.

    At most ``max_rows + 1`` rows are fetched, partition by partition.  When the
    table fits it comes back as a local relation, so it is computed once and its
    broadcast is bounded; otherwise the distributed table itself is returned and
    joins shuffle.
    """
    rows = df.take(max_rows + 1)
    if len(rows) > max_rows:
        return df, False
    fetched = pa.Table.from_pylist([r.asDict(recursive=True) for r in rows], schema=to_arrow_schema(df.schema))
    if fetched.nbytes > PIN_BYTES:
        return df, False
    return df.sparkSession.createDataFrame(fetched, schema=df.schema), True


def settle(df: DataFrame, name: str, max_rows: int = PIN_ROWS) -> tuple[DataFrame, bool]:
    """Compute a table that several later jobs read: pinned when small, else written once."""
    table, pinned = pin(df, max_rows)
    return (table, True) if pinned else (materialize(df, name), False)


def join_fitted(df: DataFrame, fitted: DataFrame, on, how: str = "left", max_rows: int = PIN_ROWS) -> DataFrame:
    """Join a fitted table: broadcast when its checked size allows, else by shuffle."""
    table, pinned = pin(fitted, max_rows)
    return df.join(F.broadcast(table) if pinned else table, on, how)


def quoted(name: str) -> Column:
    """Column by its exact name, blanks and dots included."""
    return F.col("`" + name.replace("`", "``") + "`")
