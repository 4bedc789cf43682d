import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import evaluation as e

PAIRS = [("a", "a")] * 5 + [("a", "b")] * 2 + [("b", "a")] + [("c", "a")] * 3 + [("none", "b")] * 2 + [("b", "d")]


def counts(spark, pairs=PAIRS):
    return e.confusion_counts(spark.createDataFrame(pairs, "label string, prediction string"))


def brute(pairs):
    names = sorted({x for p in pairs for x in p})
    out = {}
    for k in names:
        hits = sum(p == (k, k) for p in pairs)
        support = sum(p[0] == k for p in pairs)
        predicted = sum(p[1] == k for p in pairs)
        precision = hits / predicted if predicted else 0.0
        recall = hits / support if support else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        out[k] = (precision, recall, f1, support)
    return out


def test_report_with_absent_classes(spark):
    found = {r["class"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in e.class_report(counts(spark)).collect()}
    expected = brute(PAIRS)
    assert set(found) == set(expected)
    for k in expected:
        assert found[k] == pytest.approx(expected[k])


def test_averages(spark):
    row = e.summary_metrics(counts(spark)).first()
    report = brute(PAIRS)
    total = len(PAIRS)
    assert row["accuracy"] == pytest.approx(5 / total)
    assert row["f1_micro"] == row["accuracy"]
    assert row["f1_macro"] == pytest.approx(np.mean([v[2] for v in report.values()]))
    assert row["f1_weighted"] == pytest.approx(sum(v[2] * v[3] for v in report.values()) / total)
    assert row["n"] == total


def test_matrix_is_dense_and_leaves_out_none(spark):
    rows = {(r["label"], r["prediction"]): r["n"] for r in e.confusion_matrix(counts(spark), ["a", "b", "c", "none"]).collect()}
    assert len(rows) == 9 and rows[("a", "a")] == 5 and rows[("c", "b")] == 0
    assert sum(rows.values()) == 11  # the pair with an unlisted prediction is dropped
    wide = e.confusion_wide(counts(spark), ["a", "b", "c"]).orderBy("label").collect()
    assert tuple(wide[0]) == ("a", 5, 2, 0)


def test_half_even_and_clip(spark):
    from lodestat.functions.numbers import half_even_class

    df = spark.createDataFrame([(i, v) for i, v in enumerate([0.5, 1.5, 2.5, -0.7, 3.9])], "i int, p double")
    assert [r[0] for r in df.orderBy("i").select(half_even_class(F.col("p"), 4)).collect()] == [0, 2, 2, 0, 3]


def test_ordinal_metrics(spark):
    df = spark.createDataFrame([(0, 0.5), (2, 1.5), (2, 2.5), (1, -0.7), (3, 3.9)], "y int, p double")
    row = e.ordinal_metrics(df, "y", "p", 4).first()
    assert row["mae"] == pytest.approx((0.5 + 0.5 + 0.5 + 1.7 + 0.9) / 5)
    assert row["accuracy"] == pytest.approx(4 / 5)
    assert e.mean_absolute_error(df, "y", "p").first()["mae"] == pytest.approx(row["mae"])


def test_one_pass_over_the_rows(spark):
    df = spark.createDataFrame(PAIRS, "label string, prediction string")
    shown = e.summary_metrics(e.confusion_counts(df))._jdf.queryExecution().optimizedPlan().toString()
    assert shown.count("LogicalRDD") == 1


def test_empty_predictions(spark):
    df = spark.createDataFrame([], "label string, prediction string")
    assert e.class_report(e.confusion_counts(df)).count() == 0
    assert e.summary_metrics(e.confusion_counts(df)).first()["accuracy"] in (None, 0.0)


def test_shift_and_gap(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "prediction string")
    b = spark.createDataFrame([("y",), ("z",)], "prediction string")
    rows = {r["class"]: (r["n_baseline"], r["n_current"]) for r in e.prediction_shift(a, b).collect()}
    assert rows == {"x": (2, 0), "y": (1, 1), "z": (0, 1)}
    df = spark.createDataFrame([("train", "a", "a"), ("train", "a", "b"), ("test", "a", "a")],
                               "split string, label string, prediction string")
    assert tuple(e.overfit_gap(df, "split").first()) == (0.5, 1.0, -0.5)
