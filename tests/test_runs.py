import pytest
from pyspark.sql import functions as F

from lodestat.operators import runs as t
from lodestat.sources import runstore


def test_pivot_takes_the_latest_value(spark):
    rows = [("e", "r1", "f1_weighted", 0.1, 5, 0), ("e", "r1", "f1_weighted", 0.2, 4, 1), ("e", "r1", "acc_test", 0.9, 1, 0),
            ("e", "r2", "acc_test", 0.8, 1, 0)]
    df = spark.createDataFrame(rows, "experiment_id string, run_id string, name string, value double, ts long, step long")
    out = {r["run_id"]: r for r in t.runs_pivot(df, ["f1_weighted", "acc_test"]).collect()}
    assert out["r1"]["f1_weighted"] == 0.2 and out["r2"]["f1_weighted"] is None and out["r2"]["acc_test"] == 0.8


def test_names_best_and_ranking(spark):
    runs = spark.createDataFrame(
        [("1", "a", "rf", 0.5, 0.4, 10), ("1", "b", "rf", 0.5, 0.9, 20), ("2", "c", None, 0.7, 0.1, 5), ("1", "d", "svc", None, 0.2, 9)],
        "experiment_id string, run_id string, run_name string, f1_weighted double, test_accuracy double, end_time long")
    experiments = spark.createDataFrame([("1", "grid"), ("2", "x y/z"), ("3", "empty")], "experiment_id string, experiment string")
    named = t.model_names(runs, experiments)
    assert {r["model"] for r in named.collect()} == {"grid - rf", "x y/z - unknown", "grid - svc"}
    best = t.best_run_per_model(named, "f1_weighted")
    assert best.filter("model = 'grid - rf'").first()["run_id"] == "a"
    resolved = t.resolve_metrics(best)
    rows = {r["model"]: r for r in resolved.collect()}
    assert rows["grid - rf"]["test_acc"] == 0.4 and rows["grid - svc"]["test_f1_weighted"] == 0.0
    ranked = t.rank_models(resolved).orderBy("rank").collect()
    assert [(r["rank"], r["model"], r["medal"]) for r in ranked] == [
        (1, "x y/z - unknown", "🥇"), (2, "grid - rf", "🥈"), (3, "grid - svc", "🥉")]
    counts = {r["experiment_id"]: r["n_runs"] for r in t.runs_per_experiment(experiments, runs).collect()}
    assert counts == {"1": 3, "2": 1, "3": 0}
    assert {r["run_id"] for r in t.latest_run(runs).collect()} == {"b", "c"}
    radar = t.radar_rows(t.rank_models(resolved), top=2)
    assert radar.count() == 8
    insight = t.model_insights(resolved).first()
    assert (insight["n_models"], insight["best_model"], insight["stability"]) == (3, "x y/z - unknown", "high")
    assert insight["stands_out"] is True
    assert experiments.select(t.safe_name(F.col("experiment"))).collect()[1][0] == "x_y_z"


def test_top_models(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate([0.5, 0.7, 0.6, 0.8, 0.4])], "combo_id int, mean double")
    rows = t.top_models(df, "mean", n=3).orderBy("rank").collect()
    assert [(r["combo_id"], r["rank"], r["best_model"]) for r in rows] == [(3, 1, True), (1, 2, False), (2, 3, False)]
    tied = spark.createDataFrame([(1, 0.5), (2, 0.5), (3, 0.1)], "combo_id int, s double")
    assert t.flag_best(tied, "s").filter("is_best").count() == 2


def test_model_choice(spark):
    df = spark.createDataFrame(
        [("late", "r1", 50, False), ("first", "r2", 10, True), ("first", "r3", 20, False), ("second", "r4", 90, True)],
        "experiment string, run_id string, end_time long, has_model boolean")
    assert t.latest_model_run(df, ["first", "second"]).first()["run_id"] == "r2"
    assert t.latest_model_run(df, ["late"]).count() == 0


def test_text_run_store(spark, tmp_path):
    run = tmp_path / "77" / "abc"
    for kind in ("metrics", "params", "tags"):
        (run / kind).mkdir(parents=True)
    (tmp_path / "77" / "meta.yaml").write_text("artifact_location: x\nname: my exp\n")
    (run / "meta.yaml").write_text("end_time: 123\nrun_name: rf_1\nstatus: 3\n")
    (run / "metrics" / "test_acc").write_text("1000 0.5 0\n2000 0.75 1\n")
    (run / "metrics" / "f1_weighted").write_text("1000 0.25 0\n")
    (run / "params" / "n_estimators").write_text("20")
    (run / "tags" / "run.name").write_text("rf_1")
    root = str(tmp_path)
    metrics = runstore.read_metrics(spark, root)
    assert t.runs_pivot(metrics, ["test_acc", "f1_weighted"]).collect() == [("77", "abc", 0.75, 0.25)]
    assert runstore.read_runs(spark, root).collect() == [("77", "abc", "rf_1", "3", 123)]
    assert runstore.read_experiments(spark, root).collect() == [("77", "my exp")]
    assert runstore.read_texts(spark, root, "params").collect() == [("77", "abc", "n_estimators", "20")]


def test_records_append(spark, tmp_path):
    path = str(tmp_path / "records")
    metrics = spark.createDataFrame([(0.5, 0.25)], "accuracy double, f1 double")
    for run in ("r1", "r2"):
        runstore.append_records(runstore.metric_records(metrics, "e", run), path)
    back = runstore.read_records(spark, path)
    assert back.count() == 4 and back.filter("run_id = 'r2' and name = 'f1'").first()["value"] == "0.25"


def test_latest_records_and_output_per_experiment(spark, tmp_path):
    rows = [("e 1", "r1", "metric", "f1", "0.1", "2024-01-01 00:00:00"), ("e 1", "r2", "metric", "f1", "0.2", "2024-01-02 00:00:00"),
            ("e/2", "r3", "metric", "f1", "0.3", "2023-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "experiment_id string, run_id string, kind string, name string, value string, ts string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    path = str(tmp_path / "records")
    runstore.append_records(df, path)
    newest = runstore.latest_records(runstore.read_records(spark, path))
    assert {r["run_id"] for r in newest.collect()} == {"r2", "r3"}
    out = runstore.write_by_experiment(df, str(tmp_path / "out"), "experiment_id")
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["experiment_safe=e_1", "experiment_safe=e_2"]
    assert spark.read.parquet(out).count() == 3


def test_grid(spark):
    seed = spark.range(1).select(F.array(F.lit(1), F.lit(2)).alias("a"), F.array(F.lit("x"), F.lit("y"), F.lit("z")).alias("b"))
    grid = t.parameter_grid(seed, {"a": F.col("a"), "b": F.col("b")})
    assert grid.count() == 6 and grid.distinct().count() == 6
    scores = spark.createDataFrame([(1, 0, "f1", 0.5), (1, 1, "f1", 0.7)], "combo_id int, fold int, scorer string, score double")
    row = t.cv_summary(scores).first()
    assert (row["mean"], row["std"]) == pytest.approx((0.6, 0.1))
