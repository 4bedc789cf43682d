"""Deterministic splits, folds and samples.

Membership is a comparison of the row's hash with a fitted threshold, so it
depends on the key and seed only and applying it never shuffles the table.
``key_cols`` must identify rows; rows sharing a key land on the same side, and a
quota that would part them is an error.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.hashing import hash_order
from lodestat.operators.fitted import join_fitted, quoted, settle
from lodestat.operators.ranking import HashOrder, SortKey, global_rank, hash_order_of, hash_thresholds


def exact_share(share: float) -> Fraction:
    # 0.2 means one fifth, not its nearest double.
    return Fraction(str(share))


def class_quotas(sizes: DataFrame, test_share: float = 0.2) -> DataFrame:
    """``(grp, n, quota)`` from ``(grp, n)``: test rows per class by largest remainder.

    The test size is the rounded-up share of all rows.  Each class first gets
    the whole part of its proportional size; the rows still missing go to the
    largest remainders, ties to the smaller label.
    """
    total = sizes.agg(F.sum("n")).first()[0] or 0
    n_test = math.ceil(total * exact_share(test_share))
    # Proportional size n * n_test / total in whole numbers: no rounding noise.
    product = f"cast(n AS decimal(19,0)) * {n_test}"
    parts = sizes.selectExpr(
        "grp", "n", f"({product}) div {max(total, 1)} AS base",
        f"cast(({product}) % {max(total, 1)} AS bigint) AS remainder",
    )
    parts, _ = settle(parts, "quotas")
    assigned = parts.agg(F.sum("base")).first()[0] or 0
    ordered = global_rank(parts, [SortKey("remainder", descending=True), SortKey("grp")], "place")
    return ordered.select(
        "grp", "n", (F.col("base") + (F.col("place") <= F.lit(n_test - assigned)).cast("bigint")).alias("quota")
    )


def stratified_split(
    df: DataFrame,
    key_cols: Sequence[str],
    label: str,
    test_share: float = 0.2,
    seed: int = 42,
    rare: str = "raise",
    split_col: str = "split",
) -> DataFrame:
    """Add ``split_col`` = ``train`` / ``test`` with class shares kept.

    Reads the table three times, label and key only but for the last: rows per
    class and hash bucket, the rows of the buckets at a class's quota, and the
    projection itself.  A class with a single row cannot be on both sides:
    ``rare="raise"`` refuses it, ``rare="train"`` keeps such classes in the
    training part.
    """
    if rare not in ("raise", "train"):
        raise ValueError(f"unknown rare option: {rare}")
    order = hash_order_of(df, key_cols, seed, label)
    quotas = class_quotas(settle(order.sizes(), "sizes")[0], test_share)
    if rare == "raise":
        lonely = [r["grp"] for r in quotas.filter("n < 2").orderBy("grp").collect()]  # one row per class
        if lonely:
            raise ValueError(f"classes with fewer than 2 rows cannot be split: {lonely}")
    targets = quotas.filter("n >= 2").select("grp", F.lit(0).alias("slot"), F.col("quota").alias("rank"))
    limits = hash_thresholds(order, targets).select(
        F.col("grp").alias("__grp"), F.col("threshold").alias("__threshold")
    )
    joined = join_fitted(df, limits, F.equal_null(quoted(label), F.col("__grp")))
    in_test = F.coalesce(hash_order(key_cols, seed) <= F.col("__threshold"), F.lit(False))
    return joined.select(
        *[quoted(c) for c in df.columns], F.when(in_test, "test").otherwise("train").alias(split_col)
    )


def holdout_rows(other: DataFrame, split: DataFrame, key_cols: Sequence[str], split_col: str = "split") -> DataFrame:
    """Rows of another version of the table that belong to the test side of ``split``."""
    keys = split.filter(F.col(split_col) == "test").select(*[quoted(c) for c in key_cols])
    return other.join(keys, list(key_cols), "left_semi")


def stratified_folds(
    df: DataFrame, key_cols: Sequence[str], label: str, k: int = 3, seed: int = 42, fold_col: str = "fold"
) -> DataFrame:
    """Add a fold number ``0..k-1``; per class the fold sizes differ by at most one.

    Folds are consecutive stretches of the hash order, larger ones first, so a
    fold is found by comparing with ``k - 1`` thresholds per class.
    """
    order = hash_order_of(df, key_cols, seed, label)
    ends = order.sizes().select(
        "grp",
        F.posexplode(F.transform(F.sequence(F.lit(1), F.lit(k - 1)), lambda i: (
            i * F.floor(F.col("n") / F.lit(k)) + F.least(i, F.pmod(F.col("n"), F.lit(k)))
        ).cast("bigint"))).alias("slot", "rank"),
    )
    found = hash_thresholds(order, ends)
    limits = found.groupBy(F.col("grp").alias("__grp")).agg(
        F.array_sort(F.collect_list("threshold")).alias("__limits")  # at most k - 1 per class
    )
    joined = join_fitted(df, limits, F.equal_null(quoted(label), F.col("__grp")))
    # Plain comparisons share one hash per row; a lambda would hash per threshold.
    h = hash_order(key_cols, seed)
    passed = F.lit(0)
    for i in range(k - 1):
        passed = passed + F.coalesce(F.get("__limits", F.lit(i)) < h, F.lit(False)).cast("int")
    return joined.select(*[quoted(c) for c in df.columns], passed.alias(fold_col))


def sample_ranks(order: HashOrder, cuts: Sequence[int]) -> list[str | None]:
    """Thresholds of the first ``c`` rows of the hash order, per cut ``c``."""
    spark = order.hashed.sparkSession
    targets = spark.createDataFrame([(0, i, int(c)) for i, c in enumerate(cuts)], "grp int, slot int, rank bigint")
    found = {r["slot"]: r["threshold"] for r in hash_thresholds(order, targets).collect()}
    return [found.get(i) for i in range(len(cuts))]


def within(key_cols: Sequence[str], seed: int | str, threshold: str | None) -> Column:
    """Whether a row is among the first rows of the hash order."""
    return F.lit(False) if threshold is None else hash_order(key_cols, seed) <= F.lit(threshold)


def seeded_sample(df: DataFrame, key_cols: Sequence[str], share: float, seed: int | str = 42) -> DataFrame:
    """Exactly ``floor(n * share)`` rows without replacement."""
    order = hash_order_of(df, key_cols, seed)
    (threshold,) = sample_ranks(order, [math.floor(order.total() * exact_share(share))])
    return df.filter(within(key_cols, seed, threshold))


def split_shares(df: DataFrame, split_col: str, label: str) -> DataFrame:
    """Rows and class share per split part."""
    counts = df.groupBy(quoted(split_col).alias("split"), quoted(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    totals = counts.groupBy("split").agg(F.sum("n").alias("total"))
    return join_fitted(counts, totals, "split").select(
        "split", "class", "n", (F.col("n") / F.col("total")).alias("share")
    )
