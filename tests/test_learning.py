import pytest
from pyspark.sql import functions as F

from lodestat.operators import training as m
from lodestat.operators.runs import latest_model_run
from lodestat.operators.scoring import evaluate, score
from lodestat.operators.validation import OneOf, Required
from lodestat.plans.drift import drift_report
from lodestat.plans.train import refit, search, search_ordinal, train, train_ordinal
from lodestat.sources.models import choose_classifier, load_classifier, save_classifier
from lodestat.streaming.drift import count_windows, monitor
from lodestat.streaming.scoring import score_stream

ORDER = ["average", "good", "vg"]


@pytest.fixture(scope="module")
def rows(spark):
    """The label follows ``time`` most of the time; ``Class_ X`` has a blank in its name."""
    df = spark.range(900).select(
        F.col("id").alias("key"), F.element_at(F.array(*[F.lit(x) for x in ORDER]), (F.col("id") % 3 + 1).cast("int")).alias("time"),
        F.when(F.xxhash64("id") % 2 == 0, "yes").otherwise("no").alias("Class_ X"),
        (F.col("id") % 10).cast("double").alias("hours"))
    noisy = F.when(F.col("key") % 10 == 9, F.lit("good")).otherwise(F.col("time"))
    return df.withColumn("Performance", noisy).cache()


@pytest.fixture(scope="module")
def trained(rows):
    return train(rows, ["key"], "Performance", ["time", "Class_ X"], ["hours"], m.forest(numTrees=5, maxDepth=4), clean=True)


def test_forest_beats_the_majority(trained):
    row = trained.metrics.first()
    assert row["n"] == 180 and row["accuracy"] > 0.8
    assert trained.counts.agg(F.sum("n")).first()[0] == 180
    assert trained.classifier.labels == sorted(ORDER)


def test_scores_are_probabilities(rows, trained):
    scored = score(rows, trained.classifier, ["key"])
    assert scored.count() == 900
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    bad = scored.filter(
        ~F.col("predicted").isin(*ORDER) | ~F.col("confidence").between(0, 1) | (F.abs(total - 1) > 1e-9)
        | (F.size("all_probabilities") != 3) | (F.col("confidence") != F.col("all_probabilities")[F.col("predicted")]))
    assert bad.count() == 0
    with pytest.raises(ValueError, match="hours"):
        score(rows.drop("hours"), trained.classifier)


def test_save_load_and_evaluate(spark, rows, trained, tmp_path):
    path = save_classifier(trained.classifier, str(tmp_path / "model"))
    loaded = load_classifier(spark, path)
    assert (loaded.labels, loaded.label_col, loaded.features) == (
        trained.classifier.labels, "Performance", ["time", "Class_ X", "hours"])
    extra = rows.unionByName(rows.limit(3).withColumn("Performance", F.lit("new"))).unionByName(
        rows.limit(2).withColumn("Performance", F.lit("None")))
    row = evaluate(extra, loaded).first()
    assert (row["n"], row["n_unknown"]) == (900, 3) and row["accuracy"] > 0.8
    assert load_classifier(spark, str(tmp_path / "nothing")) is None


def test_choice_falls_back_to_the_newest_run(spark, trained, tmp_path):
    path = save_classifier(trained.classifier, str(tmp_path / "run"))
    runs = spark.createDataFrame([("a", "r1", 5, True, "/nowhere"), ("a", "r2", 9, True, path)],
                                 "experiment string, run_id string, end_time long, has_model boolean, model_path string")
    assert latest_model_run(runs, ["a"]).first()["run_id"] == "r2"
    assert choose_classifier(spark, str(tmp_path / "none"), runs, priority=["a"]).labels == sorted(ORDER)
    assert choose_classifier(spark, str(tmp_path / "none"), runs, priority=["b"]) is None


def test_ordinal(rows):
    _, metrics = train_ordinal(rows, ["key"], "Performance", ORDER, ["time"], ["hours"], m.ordinal_forest(numTrees=5, maxDepth=4))
    row = metrics.first()
    assert row["mae"] < 0.5 and row["accuracy"] > 0.7 and row["n"] == 180


def test_search_ranks_combinations(rows):
    combos = m.combinations_of({"numTrees": [2, 4], "maxDepth": [1, 4]})
    summary, best = search(rows, ["key"], "Performance", ["time"], ["hours"], combos, folds=3, top=2)
    assert summary.count() == 4 * 5
    assert summary.filter("folds = 3").count() == 20
    ranked = best.orderBy("rank").collect()
    assert len(ranked) == 2 and ranked[0]["mean"] >= ranked[1]["mean"] and ranked[0]["best_model"]


def test_ordinal_search(rows):
    summary, best = search_ordinal(rows, ["key"], "Performance", ORDER, ["time"], [], m.combinations_of(
        {"numTrees": [2], "maxDepth": [1, 4]}), folds=2)
    assert summary.count() == 2 and best.orderBy("rank").first()["mean"] <= 0


def test_refit_scores_the_holdout(rows):
    out = refit(rows, ["key"], "Performance", ["time"], ["hours"], m.combinations_of({"numTrees": [2], "maxDepth": [1, 4]}))
    found = {r["combo_id"]: r for r in out.collect()}
    assert set(found) == {0, 1} and all(r["n"] == 180 for r in found.values())
    assert found[1]["accuracy"] > 0.8


def test_grid_sizes():
    assert m.grid_size(m.FOREST_GRID) == 60
    assert m.grid_size({"a": [1, 2], "b": [1, 2, 3]}, 3) == 18
    assert len(m.combinations_of(m.BOOST_GRID)) == 12


@pytest.mark.parametrize("build", [lambda: m.boosting(maxIter=2, maxDepth=2), lambda: m.support_vectors(components=32, maxIter=5)])
def test_other_learners(rows, build):
    out = train(rows, ["key"], "Performance", ["time"], ["hours"], build())
    assert out.metrics.first()["accuracy"] > 0.6
    scored = score(rows, out.classifier, ["key"])
    assert scored.columns == ["key", "predicted", "confidence", "all_probabilities"] and scored.count() == 900
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    assert scored.filter((F.abs(total - 1) > 1e-9) | ~F.col("confidence").between(0, 1) | ~F.col("predicted").isin(*ORDER)).count() == 0


def test_drift_report(rows, trained):
    changed = rows.withColumn("time", F.when(F.col("key") % 4 == 0, "average").otherwise(F.col("time")))
    record, indexes = drift_report(trained.classifier, rows, changed, ["key"])
    row = record.first()
    assert row["acc_drop"] > 0 and row["alert"] in ("ok", "amber", "red")
    assert set(row["psi"]) == {"time", "Class_ X"}
    assert {r["column"]: r["status"] for r in indexes.collect()}["Class_ X"] == "ok"
    same = drift_report(trained.classifier, rows, rows, ["key"])[0].first()
    assert same["acc_drop"] == 0.0 and same["psi"]["time"] == pytest.approx(0.0, abs=1e-12)


def test_scoring_stream_is_complete_and_repeatable(spark, rows, trained, tmp_path):
    source = str(tmp_path / "in")
    rows.withColumn("time", F.when(F.col("key") % 5 == 0, "bad").otherwise(F.col("time"))).repartition(3).write.parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    rules = [Required("time"), OneOf("time", ORDER)]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for _ in range(2):  # the second run finds nothing new
        score_stream(stream, rules, trained.classifier, out, state, ["key", "time"]).awaitTermination()
        scored, rejected = spark.read.parquet(f"{out}/scored"), spark.read.parquet(f"{out}/quarantine")
        assert (scored.count(), rejected.count()) == (720, 180)
        assert scored.select("key").distinct().count() == 720
    assert rejected.first()["errors"][0]["type"] == "literal_error"


def test_window_stream_counts_every_day_and_drops_late_rows(spark, tmp_path):
    source = str(tmp_path / "in")

    def feed(days):
        spark.createDataFrame([(f"2024-01-{d:02d} 12:00:00", v) for d, v in days], "ts string, v string").select(
            F.col("ts").cast("timestamp").alias("ts"), "v").coalesce(1).write.mode("append").parquet(source)

    feed([(1, "a"), (1, "b"), (2, "a"), (5, "a")])
    stream = spark.readStream.schema("ts timestamp, v string").parquet(source)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    count_windows(stream, "ts", ["v"], out, state).awaitTermination()
    feed([(1, "a"), (5, "b"), (9, "a")])  # the first is too late
    count_windows(stream, "ts", ["v"], out, state).awaitTermination()
    counted = {(str(r["window_start"])[:10], r["value"]): r["n_a"] for r in spark.read.parquet(out).collect()}
    assert counted == {("2024-01-01", "a"): 1, ("2024-01-01", "b"): 1, ("2024-01-02", "a"): 1,
                       ("2024-01-05", "a"): 1, ("2024-01-05", "b"): 1, ("2024-01-09", "a"): 1}  # the last window is still open
    base = spark.createDataFrame([("a",), ("b",)], "v string")
    found = {str(r["window_start"])[:10]: r["psi"] for r in monitor(spark, out, base, ["v"]).collect()}
    assert found["2024-01-01"] == pytest.approx(0.0, abs=1e-12) and found["2024-01-02"] > 1
