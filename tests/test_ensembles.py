import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from lodestat.operators import training as m
from lodestat.operators.boosting import SoftmaxBoosting
from lodestat.operators.calibration import calibrate
from lodestat.operators.kernels import KernelMargins
from lodestat.operators.outofbag import fit_out_of_bag, poisson_limits, tree_weight
from lodestat.operators.sampling import stratified_folds
from lodestat.operators.scoring import score
from lodestat.plans.train import search
from lodestat.sources.models import load_classifier, save_classifier

NAMES = ["low", "mid", "top"]


@pytest.fixture(scope="module")
def rows(spark):
    """The class follows ``a`` and ``x`` for most rows, any class for the others."""
    df = spark.range(1200).select(
        F.col("id").alias("key"), F.concat(F.lit("g"), (F.col("id") % 5).cast("string")).alias("a"),
        (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("x"))
    clear = F.when(F.col("x") > 6, "top").when(F.col("a").isin("g0", "g1"), "low").otherwise("mid")
    noise = F.element_at(F.array(*[F.lit(n) for n in NAMES]), (F.pmod(F.xxhash64("key", F.lit(1)), F.lit(3)) + 1).cast("int"))
    return df.withColumn("y", F.when(F.pmod(F.xxhash64("key", F.lit(2)), F.lit(10)) < 2, noise).otherwise(clear)).cache()


def same_scores(a, b):
    return a.join(b, "key").filter((a["predicted"] != b["predicted"]) | (F.abs(a["confidence"] - b["confidence"]) > 1e-12)).count() == 0


def test_log_loss_falls_every_round(rows):
    booster = m.boosting(maxIter=12, maxDepth=2, stepSize=0.2, track=True)
    fitted = m.fit_classifier(rows, "y", ["a"], ["x"], booster)
    assert len(booster.losses) == 13 and all(b < a for a, b in zip(booster.losses, booster.losses[1:]))
    scored = score(rows, fitted, ["key", "y"])
    assert scored.filter("predicted = y").count() > 0.8 * 1200
    # The last of the losses is that of the probabilities the saved model gives.
    loss = scored.agg(F.avg(-F.log(F.col("all_probabilities")[F.col("y")]))).first()[0]
    assert loss == pytest.approx(booster.losses[-1], rel=1e-9)


def test_margins_written_in_between_change_nothing(rows, monkeypatch):
    from lodestat.operators import boosting

    whole = score(rows, m.fit_classifier(rows, "y", ["a"], ["x"], m.boosting(maxIter=4, maxDepth=2)), ["key"])
    monkeypatch.setattr(boosting, "CARRY", 1)
    assert same_scores(whole, score(rows, m.fit_classifier(rows, "y", ["a"], ["x"], m.boosting(maxIter=4, maxDepth=2)), ["key"]))


def test_boosted_model_is_saved_whole(spark, rows, tmp_path):
    fitted = m.fit_classifier(rows, "y", ["a"], ["x"], m.boosting(maxIter=2, maxDepth=2))
    loaded = load_classifier(spark, save_classifier(fitted, str(tmp_path / "boosted")))
    assert same_scores(score(rows, fitted, ["key"]), score(rows, loaded, ["key"]))


def test_two_classes_and_classes_without_rows(spark):
    two = spark.createDataFrame([(Vectors.dense(float(i)), 2.0 if i >= 10 else 0.0) for i in range(20)], ["features", "label"])
    model = SoftmaxBoosting(maxIter=3, maxDepth=1).fit(two)
    assert [r["prediction"] for r in model.transform(two).orderBy(F.get(vector_to_array("features"), F.lit(0))).collect()] == [0.0] * 10 + [2.0] * 10
    with pytest.raises(ValueError):
        SoftmaxBoosting().fit(two.limit(0))
    with pytest.raises(ValueError):
        SoftmaxBoosting(maxIter=0)


def test_two_classes_share_their_trees(rows, monkeypatch):
    from lodestat.operators import boosting

    two = rows.withColumn("y", F.when(F.col("y") == "top", "top").otherwise("rest"))
    shared = score(two, m.fit_classifier(two, "y", ["a"], ["x"], m.boosting(maxIter=2, maxDepth=2)), ["key"])
    monkeypatch.setattr(boosting, "_source", lambda c, k: (c, 1.0))
    own = score(two, m.fit_classifier(two, "y", ["a"], ["x"], m.boosting(maxIter=2, maxDepth=2)), ["key"])
    assert same_scores(shared, own)


def test_grids_have_the_twelve_combinations():
    assert len(m.combinations_of(m.BOOST_GRID)) == len(m.combinations_of(m.SVC_GRID)) == 12


# ---------------------------------------------------------------- out of bag
def test_weights_are_poisson(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "key")
    counts = dict(rows.groupBy(tree_weight(["key"], 1, 0).alias("w")).count().collect())
    for k in range(4):
        expected = 20_000 * math.exp(-1) / math.factorial(k)
        assert abs(counts[k] - expected) < 5 * math.sqrt(expected)
    assert poisson_limits()[0] == pytest.approx(math.exp(-1)) and poisson_limits()[-1] == pytest.approx(1.0, abs=1e-12)
    apart = rows.filter(tree_weight(["key"], 1, 0) != tree_weight(["key"], 1, 1)).count()
    assert apart > 10_000


def test_out_of_bag_score(spark, rows, tmp_path):
    found = fit_out_of_bag(rows, ["key"], "y", ["a"], ["x"], numTrees=12, maxDepth=4, featureSubsetStrategy="all")
    row = found.metrics.first()
    assert row["n"] + row["n_without"] == 1200 and row["n_without"] < 30
    # Each tree sees nothing of the rows it votes on, so the score is that of folds, not of the training rows.
    summary, _ = search(rows, ["key"], "y", ["a"], ["x"], [{"numTrees": 12, "maxDepth": 4, "featureSubsetStrategy": "all"}], folds=4)
    folds = summary.filter("scorer = 'accuracy'").first()["mean"]
    assert row["accuracy"] == pytest.approx(folds, abs=0.04)
    again = fit_out_of_bag(rows.repartition(7, "x"), ["key"], "y", ["a"], ["x"], numTrees=12, maxDepth=4, featureSubsetStrategy="all")
    assert again.metrics.first()["accuracy"] == row["accuracy"]
    assert found.predictions.exceptAll(again.predictions).count() == 0
    # The forest scores new rows and is saved like any other.
    loaded = load_classifier(spark, save_classifier(found.classifier, str(tmp_path / "bags")))
    assert same_scores(score(rows, found.classifier, ["key"]), score(rows, loaded, ["key"]))


def test_votes_of_a_tree_come_from_rows_it_left_out(rows):
    found = fit_out_of_bag(rows, ["key"], "y", ["a"], numTrees=3, maxDepth=3, seed=5)
    left = rows.select("key", sum(((tree_weight(["key"], 5, t) == 0).cast("int") for t in range(3)), F.lit(0)).alias("n"))
    assert found.predictions.join(left, "key").filter("votes <> n").count() == 0
    assert found.predictions.filter("(votes = 0) <> (prediction IS NULL)").count() == 0


# ---------------------------------------------------------------- kernels
@pytest.fixture(scope="module")
def rings(spark):
    angle, inner = F.col("id") * 2.399963, F.col("id") % 2 == 0
    radius = F.when(inner, 1.0).otherwise(3.0)
    return spark.range(600).select("id", F.cos(angle).alias("c"), F.sin(angle).alias("s"), radius.alias("r")).select(
        F.col("id").alias("key"), (F.col("r") * F.col("c")).alias("x"), (F.col("r") * F.col("s")).alias("z"),
        F.when(F.col("r") == 1, "inner").otherwise("outer").alias("y")).cache()


def hits(rows, estimator):
    return score(rows, m.fit_classifier(rows, "y", [], ["x", "z"], estimator), ["y"]).filter("predicted = y").count()


def test_kernels_separate_rings_and_lines_do_not(rings):
    assert hits(rings, m.support_vectors(kernel="linear", maxIter=20)) < 450
    assert hits(rings, m.support_vectors(kernel="rbf", components=64, maxIter=20)) == 600
    assert hits(rings, m.support_vectors(kernel="poly", degree=2, components=64, gamma=1.0, C=10, maxIter=20)) == 600
    with pytest.raises(ValueError):
        KernelMargins(kernel="other")
    with pytest.raises(ValueError):
        KernelMargins(C=0)


def test_grid_over_cost_kernel_and_gamma(rings):
    combos = m.combinations_of({"C": [1, 10], "kernel": ["rbf", "poly"], "gamma": ["scale"]})
    build = lambda **p: m.support_vectors(components=32, degree=2, maxIter=5, **p)
    summary, best = search(rings, ["key"], "y", [], ["x", "z"], combos, build, folds=2)
    assert summary.filter("scorer = 'accuracy'").count() == 4 and best.orderBy("rank").first()["mean"] > 0.9


# ---------------------------------------------------------------- calibration
def test_calibration_lowers_the_brier_score(spark, rows, tmp_path):
    folded = stratified_folds(rows, ["key"], "y", 3)
    fitted = m.fit_classifier(folded.filter("fold = 1"), "y", ["a"], ["x"], m.support_vectors(components=64, maxIter=20))
    assert score(rows, fitted, ["key"]).columns == ["key", "predicted"]  # margins are no probabilities
    known = calibrate(fitted, folded.filter("fold = 2"))
    fresh = folded.filter("fold = 0")
    scored = score(fresh, known, ["key", "y"])
    names = F.array(*[F.lit(n) for n in known.labels])
    total = F.aggregate(F.map_values("all_probabilities"), F.lit(0.0), lambda a, x: a + x)
    assert scored.filter((F.abs(total - 1) > 1e-9) | F.col("confidence").isNull()).count() == 0

    def brier(shares):
        parts = F.zip_with(shares, names, lambda p, n: F.pow(p - F.when(n == F.col("y"), 1.0).otherwise(0.0), 2))
        return F.avg(F.aggregate(parts, F.lit(0.0), lambda a, x: a + x))

    logistic = F.transform(vector_to_array("rawPrediction"), lambda v: 1 / (1 + F.exp(-2 * v)))
    sums = F.aggregate(logistic, F.lit(0.0), lambda a, x: a + x)
    plain = fitted.predict(fresh).select("y", F.transform(logistic, lambda v: v / sums).alias("p")).agg(brier(F.col("p"))).first()[0]
    assert scored.agg(brier(F.map_values("all_probabilities"))).first()[0] < plain
    loaded = load_classifier(spark, save_classifier(known, str(tmp_path / "calibrated")))
    assert same_scores(score(fresh, known, ["key"]), score(fresh, loaded, ["key"]))


def test_calibration_rises_with_the_margin(rows):
    fitted = m.fit_classifier(rows, "y", ["a"], ["x"], m.boosting(maxIter=2, maxDepth=2))
    out = calibrate(fitted, rows).predict(rows).select(vector_to_array("rawPrediction").alias("m"), *[f"__step{c}" for c in range(3)])
    for c in range(3):
        steps = [r[1] for r in out.select(F.col("m")[c].alias("m"), f"__step{c}").orderBy("m").collect()]
        assert steps == sorted(steps) and len(set(steps)) > 1
    with pytest.raises(ValueError):
        calibrate(fitted, rows.limit(0))
