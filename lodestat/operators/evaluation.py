"""Classification and ordinal metrics from one grouped count.

Every metric of a prediction table derives from ``confusion_counts``: the one
aggregation over the rows.  What follows works on at most classes squared rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.functions.numbers import half_even_class, ratio
from lodestat.operators.fitted import quoted, settle


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     ids: Sequence[str] = ()) -> DataFrame:
    """``(*ids, label, prediction, n)``; a missing prediction is a class of its own that is never right.

    Rows without a label have no truth to compare with and are left out.
    """
    return (
        df.filter(quoted(label).isNotNull())
        .groupBy(*ids, quoted(label).alias("label"), quoted(prediction).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def class_report(counts: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support per class; 0 where undefined.

    Each count row contributes to its true class and to its predicted class, so
    one more aggregation replaces a join of row and column sums.
    """
    n = F.col("n")
    sides = counts.select(*ids, F.inline(F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("label") == F.col("prediction"), n).otherwise(0).alias("hits")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("support"),
                 n.alias("predicted"), F.lit(0).cast("bigint").alias("hits")),
    )))
    sums = sides.filter(F.col("class").isNotNull()).groupBy(*ids, "class").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    return sums.select(
        *ids, "class",
        ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        ratio(F.col("hits"), F.col("support")).alias("recall"),
        ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1"),
        "support", "hits",
    )


def _weighted(metric: str) -> Column:
    return ratio(F.sum(F.col(metric) * F.col("support")), F.sum("support"))


def summary_metrics(counts: DataFrame, ids: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the weighted, macro and micro averages in one row per group."""
    report = class_report(counts, ids)
    return report.groupBy(*ids).agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        _weighted("precision").alias("precision_weighted"),
        _weighted("recall").alias("recall_weighted"),
        _weighted("f1").alias("f1_weighted"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        ratio(F.sum("hits"), F.sum("support")).alias("f1_micro"),
        F.sum("support").alias("n"),
    )


def report_rows(counts: DataFrame) -> DataFrame:
    """The classification report as rows: one per class, then the averages."""
    report = class_report(counts)
    averages = summary_metrics(counts)
    lines = averages.select(F.inline(F.array(
        F.struct(F.lit("accuracy").alias("class"), F.col("accuracy").alias("precision"),
                 F.col("accuracy").alias("recall"), F.col("accuracy").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("precision_macro").alias("precision"),
                 F.col("recall_macro").alias("recall"), F.col("f1_macro").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), F.col("precision_weighted").alias("precision"),
                 F.col("recall_weighted").alias("recall"), F.col("f1_weighted").alias("f1"),
                 F.col("n").alias("support")),
    )))
    return report.select(F.col("class").cast("string"), "precision", "recall", "f1", "support").unionByName(lines)


def confusion_matrix(
    counts: DataFrame, labels: Sequence[str], exclude_true: Sequence[str] = ("none",)
) -> DataFrame:
    """Dense ``(label, prediction, n)`` over the given labels.

    Rows whose true label is excluded, or whose pair lies outside the list, are
    dropped; pairs that never occur show 0.
    """
    shown = [x for x in labels if x not in exclude_true]
    spark = counts.sparkSession
    names = F.array(*[F.lit(x) for x in shown])
    grid = spark.range(1).select(F.explode(names).alias("label")).select("label", F.explode(names).alias("prediction"))
    found = counts.select(
        F.col("label").cast("string").alias("label"), F.col("prediction").cast("string").alias("prediction"), "n"
    ).filter(F.col("label").isin(*shown) & F.col("prediction").isin(*shown))
    # Both sides hold at most len(labels) squared rows.
    return grid.join(found, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).alias("n")
    )


def confusion_wide(counts: DataFrame, labels: Sequence[str], exclude_true: Sequence[str] = ("none",)) -> DataFrame:
    """The same matrix with one column per predicted label."""
    shown = [x for x in labels if x not in exclude_true]
    return confusion_matrix(counts, labels, exclude_true).groupBy("label").pivot("prediction", shown).sum("n")


def mean_absolute_error(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.agg(F.avg(F.abs(quoted(label) - quoted(prediction))).alias("mae"))


def ordinal_metrics(df: DataFrame, label: str, prediction: str, n_classes: int) -> DataFrame:
    """MAE of the continuous prediction and class metrics after rounding.

    The absolute errors are summed inside the confusion count, so the rows are
    read once; everything else works on at most classes squared rows.
    """
    error = F.abs(quoted(label) - quoted(prediction))
    cells = (
        df.filter(quoted(label).isNotNull())
        .groupBy(quoted(label).cast("int").alias("label"),
                 half_even_class(quoted(prediction), n_classes).alias("prediction"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(error).alias("error"))
    )
    cells, _ = settle(cells, "cells")
    # A missing prediction has no distance, but counts as a wrong class.
    mae = cells.agg(ratio(F.sum("error"), F.sum(F.when(F.col("prediction").isNotNull(), F.col("n")))).alias("mae"))
    return summary_metrics(cells.select("label", "prediction", "n")).select(
        mae.scalar().alias("mae"), "accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "n"
    )


def prediction_shift(baseline: DataFrame, current: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Predicted-class counts and shares of two versions side by side; a missing class is 0."""
    side = lambda df, flag: df.select(quoted(prediction).alias("class"), F.lit(flag).alias("side"))
    both = side(baseline, 0).unionAll(side(current, 1))
    counts = both.groupBy("class").agg(
        F.count_if(F.col("side") == 0).alias("n_baseline"), F.count_if(F.col("side") == 1).alias("n_current")
    )
    # One row per class from here on; the window is over classes, not rows.
    share = lambda n: ratio(F.col(n), F.sum(n).over(Window.partitionBy()))
    return counts.withColumns({"share_baseline": share("n_baseline"), "share_current": share("n_current")})


def overfit_gap(df: DataFrame, split_col: str, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Training accuracy beside test accuracy, and their difference."""
    hit = quoted(label).eqNullSafe(quoted(prediction))
    train, test = quoted(split_col) == "train", quoted(split_col) == "test"
    sums = df.agg(
        F.count_if(train & hit).alias("th"), F.count_if(train).alias("tn"),
        F.count_if(test & hit).alias("eh"), F.count_if(test).alias("en"),
    )
    return sums.select(
        ratio(F.col("th"), F.col("tn")).alias("acc_train"), ratio(F.col("eh"), F.col("en")).alias("acc_test")
    ).withColumn("gap", F.col("acc_train") - F.col("acc_test"))
