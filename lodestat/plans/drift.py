"""Drift report of a classifier between two versions of a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.cleaning import drop_invalid_features, drop_missing_target
from lodestat.operators.drift import drift_record, psi, status_table
from lodestat.operators.evaluation import summary_metrics
from lodestat.operators.sampling import holdout_rows, stratified_split
from lodestat.operators.training import Classifier
from lodestat.plans.train import holdout_counts


def drift_report(
    classifier: Classifier, baseline: DataFrame, current: DataFrame, key_cols: Sequence[str],
    columns: Sequence[str] | None = None, filtered: bool = False, seed: int = 42, null_as_category: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(record, index per column)``.

    ``filtered`` first drops rows with a missing target or feature from both versions.
    The metrics use the same holdout rows in both versions; the indexes use the
    whole tables.
    """
    label = classifier.label_col
    if filtered:
        baseline, current = (drop_invalid_features(drop_missing_target(df, label), label) for df in (baseline, current))
    split = stratified_split(baseline, key_cols, label, seed=seed)
    before = holdout_counts(classifier, split.filter("split = 'test'"))
    after = holdout_counts(classifier, holdout_rows(current, split, key_cols))
    named = lambda counts, side: summary_metrics(counts).select(
        F.col("accuracy").alias(f"acc_{side}"), F.col("f1_weighted").alias(f"f1_{side}"))
    base, now = named(before, "baseline"), named(after, "current")
    metrics = base.select(
        "acc_baseline", now.select("acc_current").scalar().alias("acc_current"), "f1_baseline",
        now.select("f1_current").scalar().alias("f1_current"),
    )
    names = columns if columns is not None else classifier.features
    indexes = psi(baseline, current, [c for c in names if dict(baseline.dtypes)[c] == "string"], null_as_category)
    return drift_record(metrics, indexes, filtered), status_table(indexes)
