"""Category normalisation, row filters and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions import text
from lodestat.operators.fitted import quoted

# Fixed value: the helper column that cleaning removes.
JUNK_COLUMN = "mixed_type_col"


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def clean_categoricals(df: DataFrame, columns: Sequence[str], null_token: str | None = None) -> DataFrame:
    """Normalise the text columns among ``columns``; other types stay as they are."""
    texts = set(text_columns(df)) & set(columns)
    return df.select(
        *[
            text.normalize_category(quoted(c), null_token).alias(c) if c in texts else quoted(c)
            for c in df.columns
        ]
    )


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[quoted(c) for c in df.columns if c not in names])


def drop_missing_target(df: DataFrame, target: str) -> DataFrame:
    return df.filter(~text.is_missing_target(quoted(target)))


def _valid_features(df: DataFrame, target: str | None, exempt: Sequence[str]) -> Column:
    skip = [*exempt, *([target] if target else [])]
    checks = [~text.is_missing_feature(quoted(c)) for c in text_columns(df, skip)]
    return reduce(and_, checks, F.lit(True))


def drop_invalid_features(df: DataFrame, target: str | None = None, exempt: Sequence[str] = ()) -> DataFrame:
    """Keep rows whose text features all hold a value; numeric columns are exempt."""
    return df.filter(_valid_features(df, target, exempt))


def drop_label(df: DataFrame, column: str, label: str) -> DataFrame:
    """Remove one label; rows without a label stay."""
    return df.filter(~quoted(column).eqNullSafe(F.lit(label)))


def cleaning_audit(df: DataFrame, target: str, exempt: Sequence[str] = ()) -> DataFrame:
    """What the row filters remove, as ``(rule, column, n)``, in one pass.

    Feature rules are counted after the target rule, the order in which the
    filters run.
    """
    bad_target = text.is_missing_target(quoted(target))
    features = text_columns(df, [target, *exempt])
    valid = _valid_features(df, target, exempt)
    counters = [
        ("rows_in", None, F.count(F.lit(1))),
        ("missing_target", target, F.count_if(bad_target)),
        *[("invalid_value", c, F.count_if(~bad_target & text.is_missing_feature(quoted(c)))) for c in features],
        ("invalid_features", None, F.count_if(~bad_target & ~valid)),
        ("rows_out", None, F.count_if(~bad_target & valid)),
    ]
    row = df.agg(*[counter.alias(f"c{i}") for i, (_, _, counter) in enumerate(counters)])
    entries = [
        F.struct(F.lit(rule).alias("rule"), F.lit(name).cast("string").alias("column"), F.col(f"c{i}").alias("n"))
        for i, (rule, name, _) in enumerate(counters)
    ]
    return row.select(F.inline(F.array(*entries)))


def class_shift(df: DataFrame, target: str, exempt: Sequence[str] = ()) -> DataFrame:
    """Class sizes before and after the row filters."""
    kept = ~text.is_missing_target(quoted(target)) & _valid_features(df, target, exempt)
    return df.groupBy(quoted(target).alias("class")).agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if(kept).alias("n_after")
    )


def select_features(df: DataFrame, wanted: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Project the wanted features that exist, in the wanted order; drop the rest."""
    names = [c for c in [*keep, *wanted] if c in df.columns]
    return df.select(*[quoted(c) for c in names])


def resolve_aliases(df: DataFrame, aliases: Mapping[str, Sequence[str]]) -> DataFrame:
    """Accept any alias of a column and expose the canonical name.

    The first non-null among the canonical column and its aliases wins.
    """
    known = {name for canonical, names in aliases.items() for name in (canonical, *names)}
    resolved = {}
    for canonical, names in aliases.items():
        found = [quoted(c) for c in (canonical, *names) if c in df.columns]
        if found:
            resolved[canonical] = F.coalesce(*found).alias(canonical)
    return df.select(*[quoted(c) for c in df.columns if c not in known], *resolved.values())
