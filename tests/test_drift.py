import math
from collections import Counter

import pytest
from helpers import plan, skewed
from pyspark.sql import functions as F

from lodestat.operators import drift as d


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def brute(expected, actual):
    e, a = Counter(x for x in expected if x is not None), Counter(x for x in actual if x is not None)
    total = 0.0
    for k in set(e) | set(a):
        se = e[k] / sum(e.values()) if k in e else 1e-6
        sa = a[k] / sum(a.values()) if k in a else 1e-6
        total += (sa - se) * math.log(sa / se)
    return total


CASES = {
    "plain": (["a"] * 50 + ["b"] * 50, ["a"] * 80 + ["b"] * 20),
    "nulls": (["a"] * 50 + ["b"] * 50 + [None] * 30, ["a"] * 80 + ["b"] * 20 + [None]),
    "one_sided": (["a"] * 5 + ["b"] * 5 + ["x"], ["a"] * 8 + ["c"] * 3 + ["d"]),
    "disjoint": (["a"] * 5, ["b"] * 7),
    "same": (["a"] * 5 + ["b"], ["a"] * 5 + ["b"]),
}


@pytest.mark.parametrize("name", CASES)
def test_index_matches_the_definition(spark, name):
    expected, actual = CASES[name]
    found = d.psi(frame(spark, expected), frame(spark, actual)).first()["psi"]
    assert found == pytest.approx(brute(expected, actual), abs=1e-9)
    if name == "plain":
        assert found == pytest.approx(0.415888, abs=1e-6)
    assert found >= -1e-12


def test_index_of_skewed_high_cardinality_text(spark):
    base = skewed(spark).select("text")
    now = skewed(spark).filter("key % 5 <> 1").select("text")
    found = d.psi(base, now).first()["psi"]
    expected = brute([r[0] for r in base.collect()], [r[0] for r in now.collect()])
    assert found == pytest.approx(expected, abs=1e-9)


def test_missing_values_as_category_and_columns_without_values(spark):
    a, b = frame(spark, ["a", "a", None]), frame(spark, ["a", None, None])
    assert d.psi(a, b).first()["psi"] == pytest.approx(0.0, abs=1e-12)
    assert d.psi(a, b, null_as_category=True).first()["psi"] == pytest.approx(brute(["a", "a", "-"], ["a", "-", "-"]))
    assert d.psi(frame(spark, [None]), frame(spark, [None])).first()["psi"] is None


def test_no_window_and_no_row_join(spark):
    shown = plan(d.psi_of(d.side_counts(frame(spark, ["a"]), frame(spark, ["b"]), ["v"])))
    assert "Window" not in shown and "Join" not in shown and "Python" not in shown


def test_status_drop_and_alert(spark):
    df = spark.createDataFrame([(0.05,), (-0.1,), (0.2499,), (0.25,), (None,)], "x double")
    assert [r[0] for r in df.select(d.psi_status(F.col("x"))).collect()] == ["ok", "moderate", "moderate", "high", None]
    pairs = spark.createDataFrame([(0.5368, 0.5074), (0.0, 0.5), (1.0, 0.89), (1.0, 0.949)], "a double, b double")
    drop = d.metric_drop(F.col("a"), F.col("b"))
    rows = pairs.select(drop, d.alert_level(drop)).collect()
    assert rows[0][0] == pytest.approx(5.4769, abs=1e-3)
    assert [r[1] for r in rows] == ["amber", "ok", "red", "amber"]
    assert rows[1][0] == 0.0


def test_injection(spark):
    rows = [(i, ["good", "vg"][i % 2], ["yes", "no"][i % 3 == 0], ["one", "two", "four"][i % 3],
             ["average", "vg", "good"][i % 3], f"m{i % 4}") for i in range(100)]
    df = spark.createDataFrame(rows, "key long, Performance string, coaching string, time string, pct string, medium string")
    plan_ = d.DriftPlan("Performance", (
        d.Force("coaching", "no", 0, 0.4), d.Draw("time", 0.4, 0.7, smallest=2),
        d.Draw("pct", 0, 0.5, preferred=("average", "good"))))
    out = d.inject_drift(df, ["key"], plan_)
    both = df.alias("a").join(out.alias("b"), "key")
    assert both.filter("a.Performance <> b.Performance").count() == 0
    touched = both.filter("a.medium <> b.medium or a.coaching <> b.coaching or a.time <> b.time or a.pct <> b.pct")
    assert 0 < touched.count() <= 30
    assert {r["time"] for r in out.select("time").distinct().collect()} <= {"one", "two", "four"}
    assert out.groupBy("medium").count().orderBy(F.desc("count")).first()["medium"] == "m0"
    assert out.schema == df.schema or out.columns == df.columns
    again = d.inject_drift(df.repartition(5), ["key"], plan_)
    assert sorted(again.collect()) == sorted(out.collect())


def test_windowed_index_matches_the_definition(spark):
    rows = [(f"2024-01-0{1 + i % 3} 10:00:00", "abcd"[(i * i) % (2 + i % 3)]) for i in range(200)]
    df = spark.createDataFrame(rows, "ts string, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    base = frame(spark, ["a"] * 4 + ["b"] * 3 + ["z"])
    found = {str(r["window_start"])[:10]: r["psi"] for r in d.windowed_psi(base, df, "ts", ["v"]).collect()}
    for day in {r[0][:10] for r in rows}:
        expected = brute(["a"] * 4 + ["b"] * 3 + ["z"], [v for t, v in rows if t.startswith(day)])
        assert found[day] == pytest.approx(expected, abs=1e-9)
