"""Typing of dirty text columns (all-or-nothing numeric parse) and column roles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions import text
from lodestat.functions.numbers import is_numeric, present
from lodestat.operators.counts import value_counts
from lodestat.operators.fitted import quoted, settle

# Fixed value: columns with at most this many distinct values are categories.
CATEGORY_MAX = 30


def _text_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and (columns is None or f.name in columns)
    ]


def fit_typing(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, str]:
    """Decide the type of every text column in one aggregation.

    A column becomes ``bigint`` or ``double`` only if each of its non-missing
    values parses as a whole; otherwise it stays ``string``.  A column without
    any value becomes ``double``.
    """
    names = _text_columns(df, columns)
    if not names:
        return {}
    # Cleaned once per cell, then tested; columns by position, whatever their names.
    cleaned = df.select(*[text.clean_numeric_text(quoted(c)).alias(f"c{i}") for i, c in enumerate(names)])
    flags: list[Column] = []
    for i in range(len(names)):
        cell = F.col(f"c{i}")
        flags += [
            F.count(cell).alias(f"n{i}"),
            F.bool_and(cell.isNull() | text.is_number_text(cell)).alias(f"number{i}"),
            F.bool_and(cell.isNull() | text.is_integer_text(cell)).alias(f"integer{i}"),
        ]
    row = cleaned.agg(*flags).first()
    decided = {}
    for i, name in enumerate(names):
        if row[f"number{i}"] is None:  # zero rows: nothing to decide
            decided[name] = "string"
        elif row[f"n{i}"] == 0:
            decided[name] = "double"
        elif row[f"integer{i}"]:
            decided[name] = "bigint"
        else:
            decided[name] = "double" if row[f"number{i}"] else "string"
    return decided


def typed_column(name: str, target: str) -> Column:
    cleaned = text.clean_numeric_text(quoted(name))
    if target == "bigint":
        return cleaned.cast("bigint")
    if target == "double":
        return text.number_from_text(cleaned)
    return cleaned


def apply_typing(df: DataFrame, decided: dict[str, str]) -> DataFrame:
    return df.select(
        *[
            typed_column(c, decided[c]).alias(c) if c in decided else quoted(c)
            for c in df.columns
        ]
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type the named columns only; numeric columns pass untouched."""
    return apply_typing(df, fit_typing(df, columns))


def basic_typing(df: DataFrame) -> DataFrame:
    """Type every text column of the table."""
    return apply_typing(df, fit_typing(df))


def _screen(df: DataFrame, columns: Sequence[str], cap: int) -> list[str]:
    """Columns that may have at most ``cap`` distinct values.

    The distinct sketch with relative error 0.05 has 512 registers and counts
    small sets linearly, so ``cap`` distinct values can never be estimated above
    ``512 * ln(512 / (512 - cap))``.  A larger estimate proves the column has
    more values; the remaining columns are counted exactly afterwards.
    """
    if not columns:
        return []
    if cap > 200:
        return list(columns)
    bound = 512 * math.log(512 / (512 - cap)) + 1
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.agg(
        *[F.approx_count_distinct(present(c, types[c]), 0.05).alias(f"d{i}") for i, c in enumerate(columns)]
    ).first()
    return [c for i, c in enumerate(columns) if row[f"d{i}"] <= bound]


def small_cardinalities(df: DataFrame, columns: Sequence[str], cap: int = CATEGORY_MAX) -> dict[str, tuple[int, int]]:
    """``{column: (distinct non-null, rows with null)}`` for columns within the cap.

    Exact.  Columns above the cap are left out after the screening pass, so the
    exact count shuffles a few rows per column only.
    """
    candidates = _screen(df, columns, cap)
    if not candidates:
        return {}
    found = _distinct_and_nulls(value_counts(df, candidates, digest=True))
    # A zero-row table has no cells at all: every column has zero values.
    return {c: found.get(c, (0, 0)) for c in candidates if found.get(c, (0, 0))[0] <= cap}


def _distinct_and_nulls(counts: DataFrame) -> dict[str, tuple[int, int]]:
    rows = counts.groupBy("column").agg(
        F.count("value").alias("distinct"), F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("nulls")
    ).collect()
    return {r["column"]: (r["distinct"], r["nulls"] or 0) for r in rows}


def small_value_counts(
    df: DataFrame, columns: Sequence[str], cap: int
) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """Value counts of the columns that may be within the cap, computed once.

    Returns the counts and, per column found, its distinct values and rows with
    null; columns that turn out to be above the cap are still among them.
    """
    counts, _ = settle(value_counts(df, _screen(df, columns, cap)), "counts")
    return counts, _distinct_and_nulls(counts)


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]


def split_num_cat(df: DataFrame, max_categories: int = CATEGORY_MAX, exclude: Sequence[str] = ()) -> Roles:
    """Split columns into numeric and categorical, in schema order.

    A column is categorical when it is not a number, or when it has at most
    ``max_categories`` distinct non-null values.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    numeric = [f.name for f in fields if is_numeric(f.dataType)]
    few = small_cardinalities(df, numeric, max_categories)
    numeric = [c for c in numeric if c not in few]
    return Roles(numeric, [f.name for f in fields if f.name not in numeric])


def roles_table(df: DataFrame, roles: Roles) -> DataFrame:
    """Roles as data, one row per column (schema sized)."""
    rows = [(c, "numeric" if c in roles.numeric else "categorical") for c in df.columns
            if c in roles.numeric or c in roles.categorical]
    return df.sparkSession.createDataFrame(rows, "column string, role string")
