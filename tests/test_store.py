import os
import threading

import pytest
from pyspark.sql import functions as F

from lodestat.operators import training as m
from lodestat.operators.validation import OneOf, Required
from lodestat.plans.train import RunLog, search, train
from lodestat.sources import zones
from lodestat.sources.runstore import compact, latest_records, read_metrics, read_records, read_synced, sync_metrics
from lodestat.sources.snapshots import SnapshotTable, VersionConflict
from lodestat.sources.zones import Zones, read_csv, write_csv
from lodestat.streaming.requests import score_requests


# ---------------------------------------------------------------- snapshots
def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_a_table_is_read_and_saved_under_its_own_name(spark, tmp_path):
    place = Zones(str(tmp_path))
    place.save_interim(spark.range(5), "t")
    kept = place.load_interim(spark, "t")
    place.save_interim(place.load_interim(spark, "t").filter("id > 1"), "t")
    assert ids(place.load_interim(spark, "t")) == [2, 3, 4]
    assert ids(kept) == ids(place.load(spark, "interim", "t", version=1)) == [0, 1, 2, 3, 4]
    spark.range(3).write.parquet(str(tmp_path / "processed" / "plain"))
    assert ids(place.load_processed(spark, "plain")) == [0, 1, 2]


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"))
    table.save(spark.range(3))
    broken = spark.range(10).select(F.when(F.col("id") < 9, F.col("id")).otherwise(F.raise_error(F.lit("no")).cast("long")).alias("id"))
    with pytest.raises(Exception, match="no"):
        table.save(broken)
    assert table.versions(spark) == [1] and ids(table.load(spark)) == [0, 1, 2]


def test_writers_do_not_overwrite_each_other(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"))
    table.save(spark.range(1))
    table.save(spark.range(2))
    with pytest.raises(VersionConflict):
        table.save(spark.range(9), after=1)
    assert ids(table.load(spark)) == [0, 1]
    threads = [threading.Thread(target=lambda i=i: table.append(spark.range(100 + i, 101 + i), attempts=20)) for i in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert ids(table.load(spark)) == [0, 1, 100, 101, 102, 103] and table.latest(spark) == 6


def test_append_partitions_and_vacuum(spark, tmp_path):
    table = SnapshotTable(str(tmp_path / "t"))
    for day in ("a", "b"):
        table.append(spark.range(3).withColumn("day", F.lit(day)), ["day"])
    assert table.load(spark).groupBy("day").count().orderBy("day").collect() == [("a", 3), ("b", 3)]
    table.save(table.load(spark).filter("id = 0"))
    assert table.vacuum(spark, keep=1) == 2 and table.versions(spark) == [3] and table.load(spark).count() == 2
    with pytest.raises(FileNotFoundError):
        SnapshotTable(str(tmp_path / "none")).load(spark)


def test_large_csv_files_are_refused_unasked(spark, tmp_path, monkeypatch):
    path = write_csv(spark.range(50).selectExpr("id", "concat('v', id) v").coalesce(1), str(tmp_path / "csv"))
    assert read_csv(spark, path).count() == 50
    monkeypatch.setattr(zones, "MULTILINE_BYTES", 100)
    with pytest.raises(ValueError, match="multiline=False"):
        read_csv(spark, path)
    assert read_csv(spark, path, multiline=False).count() == read_csv(spark, path, multiline=True).count() == 50


# ---------------------------------------------------------------- run store
def log_file(root, experiment, run, name, lines):
    folder = f"{root}/{experiment}/{run}/metrics"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines))


def test_only_new_metric_files_are_read(spark, tmp_path):
    root, store, state = str(tmp_path / "runs"), str(tmp_path / "store"), str(tmp_path / "state")
    log_file(root, "e1", "r1", "accuracy", ["10 0.5 0", "20 0.6 1"])
    log_file(root, "e1", "r2", "accuracy", ["11 0.7 0"])

    def sync():
        sync_metrics(spark, root, store, state).awaitTermination()
        return sorted((r["run_id"], r["name"], r["value"]) for r in read_synced(spark, store).collect())

    def full():
        best = F.max(F.struct("step", "ts", "value")).alias("last")
        rows = read_metrics(spark, root).withColumn("name", F.split_part("name", F.lit("@"), F.lit(1)))
        return sorted((r["run_id"], r["name"], r["last"]["value"]) for r in rows.groupBy("run_id", "name").agg(best).collect())

    assert sync() == full() == [("r1", "accuracy", 0.6), ("r2", "accuracy", 0.7)]
    log_file(root, "e1", "r1", "accuracy@2", ["30 0.9 2"])
    log_file(root, "e2", "r9", "f1", ["5 0.1 0"])
    assert sync() == full() and len(full()) == 3
    read = spark.read.parquet(f"{store}/new")
    assert sorted(r[0] for r in read.groupBy("batch").count().select("count").collect()) == [2, 3]  # the second read took the new files only
    compact(spark, store)
    assert sync() == full()
    log_file(root, "e2", "r9", "f1@b", ["6 0.2 0"])
    assert sync() == full()
    compact(spark, store)
    assert sync() == full() == [("r1", "accuracy", 0.9), ("r2", "accuracy", 0.7), ("r9", "f1", 0.2)]


# ---------------------------------------------------------------- logged plans
@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(300).select(F.col("id").alias("key"), F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("a"))
    return df.withColumn("y", F.when(F.col("a") == "g0", "no").otherwise("yes")).cache()


def test_train_and_search_log_their_runs(spark, rows, tmp_path):
    path = str(tmp_path / "records")
    out = train(rows, ["key"], "y", ["a"], estimator=m.forest(numTrees=2, maxDepth=2), log=RunLog(path, "exp", "run-1", {"owner": "tests"}))
    records = {(r["kind"], r["name"]): r["value"] for r in read_records(spark, path).collect()}
    assert float(records["metric", "accuracy"]) == out.metrics.first()["accuracy"]
    assert (records["param", "numTrees"], records["param", "maxDepth"], records["param", "target"], records["param", "categorical"]) == ("2", "2", "y", "a")
    assert records["param", "estimator"] == "RandomForestClassifier" and records["tag", "owner"] == "tests"
    _, best = search(rows, ["key"], "y", ["a"], [], m.combinations_of({"numTrees": [1, 2]}), folds=2, top=2, log=RunLog(path, "grid", "s"))
    logged = read_records(spark, path).filter("experiment_id = 'grid'")
    assert {r["run_id"] for r in logged.select("run_id").distinct().collect()} == {"s-1", "s-2"}
    first = {(r["kind"], r["name"]): r["value"] for r in logged.filter("run_id = 's-1'").collect()}
    top = best.filter("rank = 1").first()
    assert float(first["metric", "cv_f1_weighted_mean"]) == top["mean"] and first["tag", "best_model"] == "true" and first["param", "folds"] == "2"
    assert latest_records(read_records(spark, path)).select("experiment_id").distinct().count() == 2


# ---------------------------------------------------------------- requests on the stream
def test_requests_are_judged_whole(spark, rows, tmp_path):
    model = m.fit_classifier(rows, "y", ["a"], [], m.forest(numTrees=2, maxDepth=2))
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "req string, ts timestamp, key long, a string"

    def feed(data):
        spark.createDataFrame(data, "req string, t string, key long, a string").select(
            "req", F.to_timestamp("t").alias("ts"), "key", "a").coalesce(1).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        score_requests(stream, [Required("a"), OneOf("a", ["g0", "g1", "g2"])], model, out, state, ["key"], "req", "ts", limit=3).awaitTermination()
        return [spark.read.parquet(f"{out}/{x}") for x in ("scored", "quarantine", "envelopes")]

    feed([("r1", "2024-01-01 10:00:00", 1, "g0"), ("r1", "2024-01-01 10:00:30", 2, "g1"), ("r1", "2024-01-01 10:00:40", 3, "bad"),
          ("r2", "2024-01-01 10:00:00", 10, "g0"), ("r2", "2024-01-01 10:00:01", 11, "g0"), ("r2", "2024-01-01 10:00:02", 12, "g0"),
          ("r2", "2024-01-01 10:00:03", 13, "g0"), ("r2", "2024-01-01 12:00:00", 14, "g2")])
    feed([("end", "2024-01-02 00:00:00", 99, "g0")])
    feed([("r1", "2024-01-01 10:00:50", 4, "g0"), ("end2", "2024-01-03 00:00:00", 100, "g0")])  # the first is too late
    for _ in range(2):  # the second run finds nothing new
        scored, rejected, envelopes = run()
        keys = sorted(r["key"] for r in scored.collect())
        assert keys[:3] == [1, 2, 14] and 4 not in keys
        errors = {r["key"]: r["errors"][0]["type"] for r in rejected.collect()}
        assert errors == {3: "literal_error", 10: "too_long", 11: "too_long", 12: "too_long", 13: "too_long"}
        lines = {(r["request"], r["total"]): r["predictions"] for r in envelopes.collect()}
        assert lines["r1", 2] == '{"no":1,"yes":1}' and lines["r2", 1] == '{"yes":1}'
        assert envelopes.groupBy("request", "timestamp").count().filter("count > 1").count() == 0
