"""Exact ranks, quantiles and splits on skewed data, forced through the large-table paths."""

import numpy as np
import pytest
from helpers import skewed
from pyspark.sql import functions as F

from lodestat.operators import fitted, ranking, sampling
from lodestat.operators.encoding import label_map
from lodestat.operators.ranking import SortKey, exact_quantiles, global_rank


def test_global_rank_spreads_a_hot_value(spark):
    df = skewed(spark).select("key", "label", "x")
    ranked = global_rank(df, [SortKey("label", True), SortKey("x"), SortKey("key")], small_rows=1000)
    rows = ranked.toPandas()
    expected = rows.sort_values(["label", "x", "key"], ascending=[False, True, True])
    assert expected["rank"].tolist() == list(range(1, 30_001))
    assert len(rows) == 30_000


def test_rank_within_a_hot_group(spark):
    df = skewed(spark).select("key", "label", "x")
    rows = ranking.rank_within(df, "label", [SortKey("x", True), SortKey("key")], small_rows=1000).toPandas()
    for _, part in rows.groupby("label"):
        ordered = part.sort_values(["x", "key"], ascending=[False, True])
        assert ordered["rank"].tolist() == list(range(1, len(part) + 1))


def test_ranges_stay_balanced_under_skew(spark):
    df = skewed(spark).select("key", "label")
    order = [SortKey("label").ordering(), SortKey("key").ordering()]
    sizes = df.repartitionByRange(8, *order).groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert sizes.max() < 30_000 / 8 * 2  # the hot third is spread over several ranges


def test_global_rank_with_nulls(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 != 0, F.col("id") % 11).alias("v"))
    rows = global_rank(df, [SortKey("v", True), SortKey("id")], small_rows=200).toPandas().sort_values("rank")
    assert rows["rank"].tolist() == list(range(1, 3001))
    assert rows["v"].tail(1000).isna().all()
    top = rows.head(2000)
    assert top["v"].is_monotonic_decreasing


@pytest.mark.parametrize("finish", [200_000, 500])
def test_quantiles_match_numpy(spark, finish):
    df = skewed(spark)
    values = np.array([r["x"] for r in df.select("x").collect()])
    ps = [0.0, 0.01, 0.25, 0.5, 0.61, 0.99, 1.0]
    found = exact_quantiles(df, ["x"], ps, finish_rows=finish)["x"]
    for p in ps:
        assert found[p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_quantiles_of_extreme_ranges(spark):
    values = [-1e300, 1e300, 0.0, 1e-300, -1e-300] + [float(i) ** 9 for i in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, ["x"], [0.1, 0.5, 0.9], finish_rows=10)["x"]
    for p in found:
        assert found[p] == pytest.approx(np.quantile(np.array(values), p), rel=1e-9)


def test_quantiles_without_values(spark):
    df = spark.createDataFrame([(None, 1.0), (float("nan"), 2.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], [0.5]) == {"a": {0.5: None}, "b": {0.5: 1.5}}


def _split(spark, **options):
    df = skewed(spark).select("key", "label")
    return df, sampling.stratified_split(df, ["key"], "label", **options)


def test_split_is_exact_disjoint_and_complete(spark):
    df, split = _split(spark)
    rows = split.toPandas()
    assert len(rows) == 30_000 and rows["key"].is_unique
    assert (rows["split"] == "test").sum() == 6000
    shares = rows.groupby("label")["split"].apply(lambda s: (s == "test").mean())
    assert ((shares - 0.2).abs() < 0.001).all()
    again = sampling.stratified_split(df.repartition(3), ["key"], "label").toPandas()
    assert rows.sort_values("key")["split"].tolist() == again.sort_values("key")["split"].tolist()


def test_split_without_pinning_gives_the_same_rows(spark, monkeypatch):
    _, pinned = _split(spark)
    expected = pinned.filter("split = 'test'").select("key").toPandas()["key"].sort_values().tolist()
    monkeypatch.setattr(fitted.pin, "__defaults__", (2,))
    monkeypatch.setattr(fitted.settle, "__defaults__", (2,))
    monkeypatch.setattr(fitted.join_fitted, "__defaults__", ("left", 2))
    _, spread = _split(spark)
    assert spread.filter("split = 'test'").select("key").toPandas()["key"].sort_values().tolist() == expected


@pytest.mark.parametrize("ranked_rows", [1_000_000, 3, 1])
def test_thresholds_by_longer_prefixes(spark, ranked_rows):
    # With a low bound the prefix is lengthened until one task ranks few rows.
    df = skewed(spark).select("key", "label")
    order = ranking.hash_order_of(df, ["key"], 42, "label")
    targets = spark.createDataFrame(
        [("hot", 0, 5000), ("hot", 1, 1), ("hot", 2, 10_000), ("c1", 0, 7), ("c1", 1, 8)], "grp string, slot int, rank long")
    rows = ranking.hash_thresholds(order, targets, ranked_rows).collect()
    assert len(rows) == 5
    ranks = {("hot", 0): 5000, ("hot", 1): 1, ("hot", 2): 10_000, ("c1", 0): 7, ("c1", 1): 8}
    for r in rows:
        below = order.hashed.filter((F.col("grp") == r["grp"]) & (F.col("h") <= r["threshold"])).count()
        assert below == ranks[(r["grp"], r["slot"])]


def test_first_prefixes_cut_a_hot_class(spark):
    df = skewed(spark).select("key", "label")
    order = ranking.hash_order_of(df, ["key"], 42, "label")
    assert order.total() == 30_000
    assert order.prefixes.filter("grp = 'hot'").agg(F.max("n")).first()[0] < 30


def test_rare_classes(spark):
    df = spark.createDataFrame([(i, "a") for i in range(9)] + [(9, "b")], "key long, label string")
    with pytest.raises(ValueError, match="fewer than 2 rows"):
        sampling.stratified_split(df, ["key"], "label")
    kept = sampling.stratified_split(df, ["key"], "label", rare="train")
    assert kept.filter("label = 'b'").first()["split"] == "train"


def test_reference_sizes(spark):
    df = spark.range(100).select(F.col("id").alias("key"), (F.col("id") % 2).cast("string").alias("label"))
    counts = {(r["label"], r["split"]): r["count"] for r in
              sampling.stratified_split(df, ["key"], "label").groupBy("label", "split").count().collect()}
    assert counts == {("0", "train"): 40, ("0", "test"): 10, ("1", "train"): 40, ("1", "test"): 10}
    # 679 rows, class sizes 157/101/216/5/200: 136 test rows
    sizes = [157, 101, 216, 5, 200]
    rows = [(f"{c}-{i}", str(c)) for c, n in enumerate(sizes) for i in range(n)]
    many = spark.createDataFrame(rows, "key string, label string")
    assert sampling.stratified_split(many, ["key"], "label").filter("split = 'test'").count() == 136


def test_folds(spark):
    df = skewed(spark).select("key", "label")
    rows = sampling.stratified_folds(df, ["key"], "label", 7).toPandas()
    sizes = rows.groupby(["label", "fold"]).size().unstack()
    assert sorted(sizes.columns) == list(range(7))
    assert (sizes.max(axis=1) - sizes.min(axis=1)).max() <= 1
    tiny = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "key long, label string")
    assert sorted(r["fold"] for r in sampling.stratified_folds(tiny, ["key"], "label", 5).collect()) == [0, 0, 1]


def test_sample_and_holdout(spark):
    df = skewed(spark)
    assert sampling.seeded_sample(df, ["key"], 0.3).count() == 9000
    assert sampling.seeded_sample(df, ["key"], 0.00001).count() == 0
    split = sampling.stratified_split(df, ["key"], "label")
    other = df.withColumn("label", F.lit("changed"))
    held = sampling.holdout_rows(other, split, ["key"])
    assert held.count() == 6000 and held.select("label").distinct().count() == 1


def test_label_map_and_pin_limits(spark):
    df = skewed(spark)
    mapping = {r["label"]: r["label_id"] for r in label_map(df, "label").collect()}
    assert mapping == {name: i for i, name in enumerate(sorted(mapping))}
    table, pinned = fitted.pin(spark.range(11), 10)
    assert not pinned and table.count() == 11
    table, pinned = fitted.pin(spark.range(10), 10)
    assert pinned and table.count() == 10
