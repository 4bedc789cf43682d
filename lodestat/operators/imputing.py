"""Median and mode imputation: fit small statistics, apply a projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.numbers import present
from lodestat.operators.counts import LONG_TEXT, long_values
from lodestat.operators.fitted import join_fitted, quoted, settle
from lodestat.operators.ranking import exact_quantiles
from lodestat.operators.typing import CATEGORY_MAX, Roles, split_num_cat


def fit_medians(df: DataFrame, columns: Sequence[str], accuracy: int | None = None) -> dict[str, float | None]:
    """Exact interpolated medians, or sketch medians when ``accuracy`` is given."""
    if accuracy is None:
        return {c: q[0.5] for c, q in exact_quantiles(df, columns, [0.5]).items()}
    if not columns:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    row = df.agg(
        *[F.percentile_approx(present(c, types[c]), 0.5, accuracy).alias(f"m{i}") for i, c in enumerate(columns)]
    ).first()
    return {c: row[f"m{i}"] for i, c in enumerate(columns)}


# Counters of a column in the first pass over its values.
MODE_BUCKETS = 1 << 16


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, object]:
    """Most frequent value per column, the smallest one on ties.

    Values are dealt into ``MODE_BUCKETS`` counters by hash: a counter is an upper bound for
    each of its values.  The best value of the fullest counter is counted exactly, and only
    counters that reach that count can hold a better one; the values of these are counted, long
    texts by digest, and of the values that tie the smallest is looked up.  So what is
    shuffled depends neither on the texts' length nor, where a value stands out, on
    how many other values there are.  A column without any value has no mode and is an error.
    """
    if not columns:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = long_values(df, columns, digest=True).filter(F.col("value").isNotNull())
    cells = cells.withColumn("bucket", F.pmod(F.xxhash64("value"), F.lit(MODE_BUCKETS)).cast("int"))
    buckets, _ = settle(cells.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("most")), "buckets", MODE_BUCKETS)

    def counted(within: DataFrame) -> DataFrame:
        return join_fitted(cells, within, ["column", "bucket"], "left_semi").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))

    fullest = buckets.groupBy("column").agg(F.max_by("bucket", F.struct("most", "bucket")).alias("bucket"))
    floor = counted(fullest).groupBy("column").agg(F.max("n").alias("floor"))
    chosen = buckets.join(floor, "column").filter(F.col("most") >= F.col("floor")).select("column", "bucket")
    counts = counted(settle(chosen, "chosen", MODE_BUCKETS)[0])
    best = counts.groupBy("column").agg(F.max("n").alias("best"))
    ties = counts.join(best, "column").filter(F.col("n") == F.col("best")).select("column", "value")
    # Numbers tie-break by value, texts by code point; a digest stands for its text only here.
    texts = long_values(df, columns)
    known = F.when(F.length("value") > LONG_TEXT, F.concat(F.lit("sha256:"), F.sha2("value", 256))).otherwise(F.col("value"))
    is_text = F.col("column").isin(*[c for c in columns if isinstance(types[c], T.StringType)])
    texts = texts.filter(F.col("value").isNotNull()).select("column", F.when(is_text, known).otherwise(F.col("value")).alias("known"), "value")
    numeric = [c for c in columns if isinstance(types[c], T.NumericType)]
    size = F.when(F.col("column").isin(*numeric), F.col("value").try_cast("double")) if numeric else F.lit(None).cast("double")
    tied = join_fitted(texts, ties.withColumnRenamed("value", "known"), ["column", "known"], "left_semi")
    rows = tied.withColumn("size", size).groupBy("column").agg(F.min(F.struct("size", "value")).alias("mode")).collect()  # one row per column
    modes = {r["column"]: r["mode"]["value"] for r in rows}
    empty = [c for c in columns if c not in modes]
    if empty:
        raise ValueError(f"columns without any value have no mode: {empty}")
    return modes


@dataclass(frozen=True)
class Imputer:
    medians: dict[str, float | None] = field(default_factory=dict)
    modes: dict[str, object] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in df.schema.fields}

        def filled(name: str):
            col = present(name, types[name])
            if name in self.medians and self.medians[name] is not None:
                # An interpolated median may fall between two integers.
                return F.coalesce(col.cast("double"), F.lit(float(self.medians[name]))).alias(name)
            if name in self.modes:
                return F.coalesce(col, F.lit(self.modes[name]).cast(types[name])).alias(name)
            return quoted(name)

        return df.select(*[filled(c) for c in df.columns])


def fit_imputer(df: DataFrame, roles: Roles) -> Imputer:
    return Imputer(fit_medians(df, roles.numeric), fit_modes(df, roles.categorical))


def minimal_preprocess(df: DataFrame, max_categories: int = CATEGORY_MAX) -> tuple[DataFrame, Roles]:
    """Roles, then median for numeric and mode for categorical columns."""
    roles = split_num_cat(df, max_categories)
    return fit_imputer(df, roles).transform(df), roles
