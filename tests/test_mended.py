"""Rows that share keys, lack values or hold separators are treated alike everywhere."""

import pytest
from pyspark.sql import functions as F

from lodestat.functions.hashing import hash_order
from lodestat.operators import evaluation as e
from lodestat.operators.drift import Draw, DriftPlan, alert_level, drift_record, inject_drift
from lodestat.operators.encoding import encode_ordinal, fit_categories
from lodestat.operators.ranking import hash_order_of, hash_thresholds
from lodestat.operators.sampling import seeded_sample, stratified_split
from lodestat.operators.scoring import score
from lodestat.operators.training import CleanStep, boosting, fit_classifier, forest
from lodestat.operators.validation import score_envelope
from lodestat.plans.drift import drift_report
from lodestat.plans.train import train
from lodestat.sources.fingerprint import table_fingerprint
from lodestat.sources.zones import read_csv, write_csv


def test_keys_do_not_run_into_each_other(spark):
    rows = [(None, "a"), ("a", None), ("a|", "b"), ("a", "|b"), ("\\N", "a"), ("a\\", "|b"), ("", "a"), ("a", "")]
    hashes = spark.createDataFrame(rows, "x string, y string").select(hash_order(["x", "y"], 1).alias("h")).collect()
    assert len({r["h"] for r in hashes}) == len(rows)


def test_split_with_null_keys(spark):
    df = spark.range(100).select(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("x"), F.when(F.col("id") % 2 == 1, F.col("id").cast("string")).alias("y"),
        (F.col("id") % 4 < 2).cast("string").alias("label"))
    sides = {r["split"]: r["count"] for r in stratified_split(df, ["x", "y"], "label").groupBy("split").count().collect()}
    assert sides == {"train": 80, "test": 20}


def test_a_key_with_many_rows_ends(spark):
    df = spark.range(300).select(F.when(F.col("id") < 200, 7).otherwise(F.col("id")).alias("key"))
    order = hash_order_of(df, ["key"], 1)
    targets = spark.createDataFrame([(0, 0, 100), (0, 1, 300)], "grp int, slot int, rank long")
    with pytest.raises(Exception, match="key columns that identify a row"):
        hash_thresholds(order, targets, ranked_rows=10).collect()
    whole = hash_thresholds(order, targets.filter("slot = 1"), ranked_rows=10).collect()
    assert len(whole) == 1


def test_sample_refuses_to_part_a_key(spark):
    df = spark.range(100).select((F.col("id") / 50).cast("int").alias("key"))
    with pytest.raises(Exception, match="identify a row"):
        seeded_sample(df, ["key"], 0.3).count()
    assert seeded_sample(df, ["key"], 0.5).count() == 50


def test_missing_predictions_are_wrong(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), ("b", None)], "label string, prediction string")
    row = e.summary_metrics(e.confusion_counts(df)).first()
    assert row["accuracy"] == pytest.approx(1 / 3) and row["n"] == 3
    report = {r["class"]: r["support"] for r in e.class_report(e.confusion_counts(df)).collect()}
    assert report == {"a": 2, "b": 1}
    ordinal = e.ordinal_metrics(spark.createDataFrame([(0, 0.0), (1, None)], "label int, prediction double"), "label", "prediction", 3).first()
    assert ordinal["accuracy"] == 0.5 and ordinal["mae"] == 0.0


def test_shift_has_shares(spark):
    side = lambda values: spark.createDataFrame([(v,) for v in values], "prediction string")
    rows = {r["class"]: r for r in e.prediction_shift(side("aab"), side("abbbbb")).collect()}
    assert rows["a"]["share_baseline"] == pytest.approx(2 / 3) and rows["b"]["share_current"] == pytest.approx(5 / 6)


def test_unknown_stays_unknown(spark):
    row = spark.range(1).select(alert_level(F.lit(None).cast("double")).alias("a"), alert_level(F.lit(1.0)).alias("b")).first()
    assert (row["a"], row["b"]) == ("unknown", "ok")
    metrics = spark.createDataFrame([(0.5, 0.5, 0.5, 0.5)], "acc_baseline double, acc_current double, f1_baseline double, f1_current double")
    indexes = spark.createDataFrame([("x", 0.1), ("y", None)], "column string, psi double")
    assert drift_record(metrics, indexes, False).first()["psi"] == {"x": 0.1, "y": None}
    envelope = score_envelope(spark.createDataFrame([(1, "a"), (1, None)], "request int, prediction string"), "request", "prediction").first()
    assert envelope["total"] == 2 and envelope["predictions"] == '{"a":1}'


def test_digest_knows_borders_and_nulls(spark):
    digest = lambda *row: table_fingerprint(spark.createDataFrame([row], "a string, b string")).first()["digest"]
    assert len({digest("a|b", "c"), digest("a", "b|c"), digest(None, "c"), digest("\\N", "c"), digest("", "c")}) == 5


def test_csv_by_name_with_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([("1", 'two\nlines, "quoted"'), ("2", "plain")], "i string, s string")
    path = write_csv(df.coalesce(1), str(tmp_path / "t"))
    back = read_csv(spark, path, ["s", "i"])
    assert {(r["i"], r["s"]) for r in back.collect()} == {("1", 'two\nlines, "quoted"'), ("2", "plain")}


def test_no_silent_caps(spark):
    wide = spark.range(12_000).select(F.col("id").cast("string").alias("c"))
    assert len(fit_categories(wide, ["c"], None)["c"]) == 12_000
    with pytest.raises(ValueError, match="limit 10000"):
        fit_categories(wide, ["c"])
    with pytest.raises(ValueError, match="limit 100"):
        fit_categories(wide, ["c"], 100)
    with pytest.raises(ValueError, match="39 labels outside"):
        encode_ordinal(spark.range(39).select(F.concat(F.lit("l"), F.col("id")).alias("y")), "y", ["low", "high"])


def test_draw_from_a_wide_column(spark):
    df = spark.range(1000).select("id", F.concat(F.lit("v"), F.col("id")).alias("wide"), F.lit("t").alias("target"))
    out = inject_drift(df, ["id"], DriftPlan("target", [Draw("wide", 0.0, 1.0)], 0.3)).collect()
    assert len(out) == 1000 and all(r["wide"].startswith("v") for r in out)
    assert 200 < sum(r["wide"] != f"v{r['id']}" for r in out) <= 300


def people(spark):
    return spark.range(200).select(
        "id", F.when(F.col("id") % 2 == 0, "male").otherwise("female").alias("sex"), (F.col("id") % 2).cast("string").alias("label"))


def test_scoring_cleans_like_training(spark):
    trained = train(people(spark), ["id"], "label", ["sex"], estimator=forest(numTrees=1, maxDepth=2, featureSubsetStrategy="all"), clean=True, aliases={"sex": ["Sex"]})
    sent = spark.createDataFrame([(1, " Female "), (2, "MALE")], "row int, Sex string")
    rows = {r["row"]: (r["Sex"], r["predicted"]) for r in score(sent, trained.classifier).collect()}
    assert rows == {1: (" Female ", "1"), 2: ("MALE", "0")}


def test_numbers_sent_as_text(spark):
    step = CleanStep([], ["n"])
    assert [r["n"] for r in step.apply(spark.createDataFrame([("1,200 ",), ("$5",), ("x",)], "n string")).collect()] == [1200.0, 5.0, None]


def test_boosting_has_shares(spark):
    fitted = fit_classifier(people(spark), "label", ["sex"], estimator=boosting(maxIter=2, maxDepth=2))
    row = score(people(spark), fitted).first()
    assert sum(row["all_probabilities"].values()) == pytest.approx(1) and row["confidence"] > 0.5


def test_filtered_report_filters(spark):
    df = people(spark).withColumn("sex", F.when(F.col("id") < 60, "none").otherwise(F.col("sex")))
    fitted = train(df, ["id"], "label", ["sex"], estimator=forest(numTrees=1, maxDepth=2, featureSubsetStrategy="all")).classifier
    accuracy = lambda flag: drift_report(fitted, df, df, ["id"], filtered=flag)[0].first()["acc_baseline"]
    assert accuracy(True) == 1.0 and accuracy(False) < 1.0
