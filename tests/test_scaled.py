"""Steps whose memory or time must not grow faster than their input."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from lodestat.operators import kernels


def test_mapped_vectors_are_handed_back_in_parts(spark, monkeypatch):
    """However long the mapped vectors, a task makes a bounded number of numbers at once."""
    whole = kernels.RbfMap(inputCol="x", outputCol="r", width=2, components=4096).mapper()

    def mapper(self):
        def mapped(x):
            if len(x) * 4096 > 1 << 20:
                raise ValueError(f"{len(x)} rows at once")
            return whole(x)
        return mapped

    monkeypatch.setattr(kernels.RbfMap, "mapper", mapper)
    df = spark.range(0, 700, 1, 1).select("id", array_to_vector(F.array(F.col("id") / 100, F.lit(1.0))).alias("x"))
    out = kernels.RbfMap(inputCol="x", outputCol="r", width=2, components=4096).transform(df)
    found = out.select("id", F.slice(vector_to_array("r"), 1, 3).alias("r")).orderBy("id").collect()
    assert [r["id"] for r in found] == list(range(700))
    expected = whole(np.column_stack([np.arange(700) / 100, np.ones(700)]))[:, :3]
    assert np.array([r["r"] for r in found]) == pytest.approx(expected, abs=1e-9)


def test_full_rows_are_multiplied_as_matrices_in_many_tasks(spark, monkeypatch):
    """Rows with a value for every place give the components of the same rows given by places, and leave their one file."""
    from lodestat.operators import encoding, wide

    df = spark.range(0, 400, 1, 1).select(F.transform(F.sequence(F.lit(0), F.lit(299)), lambda i: F.sin(F.col("id") * (i % 3 + 1)) * (i % 7)).alias("v"))
    by_place = df.select(F.sequence(F.lit(0), F.lit(299)).alias("at"), F.col("v").alias("x"))
    seen = []
    whole = wide.Sketch.fit
    monkeypatch.setattr(wide.Sketch, "fit", lambda self: seen.append(self.rows) or whole(self))
    found = encoding.fit_components(df, F.col("v"), [f"v{i}" for i in range(300)], 3)
    assert seen[0].filter("at IS NOT NULL").count() == 0
    assert seen[0].select(F.input_file_name()).distinct().count() > 1
    mixed = seen[0].limit(0).unionByName(df.select(F.lit(None).cast("array<int>").alias("at"), F.col("v").alias("x")).limit(150)).unionByName(by_place.offset(150))
    for rows in (by_place, mixed):
        mean, directions, shares = whole(wide.Sketch(rows, 300, 3))
        assert mean.tolist() == pytest.approx(found.means, abs=1e-9) and shares.tolist() == pytest.approx(found.explained, abs=1e-9)
        assert np.abs(directions.T - np.array(found.loadings)).max() < 1e-6


def test_a_tree_weight_hashes_a_row_once(spark):
    """Not once for each of the limits it is compared with."""
    from lodestat.operators.outofbag import poisson_limits, tree_weight

    df = spark.range(2000).select("id", tree_weight(["id"], 5, 3).alias("w"))
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("md5(") == 1 and "md5(" not in text.split("lambdafunction(")[1]
    from hashlib import md5

    limits = poisson_limits()
    expected = [sum(x <= int(md5(f"{i}|5|3".encode()).hexdigest()[:12], 16) / 2**48 for x in limits) for i in range(2000)]
    assert [r["w"] for r in df.orderBy("id").collect()] == expected


def test_out_of_bag_weights_are_written_for_all_passes(spark, monkeypatch):
    from lodestat.operators import outofbag

    written = []
    keep = outofbag.materialize
    monkeypatch.setattr(outofbag, "materialize", lambda df, name: written.append(df.columns) or keep(df, name))
    df = spark.range(300).select(F.col("id").alias("key"), F.concat(F.lit("g"), F.col("id") % 3).alias("a"), F.concat(F.lit("y"), F.col("id") % 2).alias("y"))
    found = outofbag.fit_out_of_bag(df, ["key"], "y", ["a"], numTrees=3, maxDepth=2, seed=7)
    assert [c for c in written[1] if c.startswith("__w")] == ["__w0", "__w1", "__w2"]
    without = sum(F.when(outofbag.tree_weight(["key"], 7, t) == 0, 1).otherwise(0) for t in range(3))
    expected = {r["key"]: r["n"] for r in df.select("key", without.alias("n")).collect()}
    assert {r["key"]: r["votes"] for r in found.predictions.collect()} == expected


def test_search_asks_a_forest_for_its_prediction_only(spark, monkeypatch):
    from pyspark.ml.classification import RandomForestClassificationModel as Forest

    from lodestat.operators import training as m

    seen = []
    whole = Forest.transform
    monkeypatch.setattr(Forest, "transform", lambda self, df: seen.append(whole(self, df)) or seen[-1])
    rows = spark.range(120).select(
        array_to_vector(F.array((F.col("id") % 2).cast("double"))).alias("features"), (F.col("id") % 2).cast("double").alias("label"), (F.col("id") % 3).cast("int").alias("fold"))
    found = m.grid_search(rows, m.forest, m.combinations_of({"numTrees": [2], "maxDepth": [2]}), 3)
    assert [r["accuracy"] for r in found.collect()] == [1.0] * 6
    assert len(seen) == 3 and all({"probability", "rawPrediction"}.isdisjoint(df.columns) and "prediction" in df.columns for df in seen)


def test_requests_are_read_in_batches_of_one_size(spark, monkeypatch, tmp_path):
    """The stream's batches don't grow with the table, and requests that cross them keep their size and all their rows."""
    import datetime as dt
    import random

    from lodestat.bindings import learning
    from lodestat.streaming import replay

    draw = random.Random(5)
    start = dt.datetime(2024, 1, 1)
    times = [start + dt.timedelta(minutes=draw.randrange(3000)) for _ in range(300)]
    times += [start + dt.timedelta(minutes=9 * n) for n in range(250)] + [start + dt.timedelta(hours=30)] * 100 + [None] * 5
    users = [draw.randrange(12) for _ in range(300)] + [77] * 250 + [draw.randrange(100, 130) for _ in range(100)] + [3] * 5
    data = [*zip(times, users, strict=True)]
    data += [(t, None) for t in times[:20]] + data[:30]  # rows without an id, rows that come twice
    last = data.pop(0)
    draw.shuffle(data)
    data.insert(0, last)
    spark.createDataFrame([(n, t, u) for n, (t, u) in enumerate(data)], "event_id long, ts timestamp_ntz, user_id long").coalesce(1).write.parquet(
        f"{tmp_path}/events.parquet")

    sizes, by_user = {}, {}
    for t, u in data:
        if t is not None and u is not None:
            by_user.setdefault(u, []).append(t)
    for sent in by_user.values():
        sent.sort()
        first = 0
        for n in range(1, len(sent) + 1):
            if n == len(sent) or sent[n] - sent[n - 1] > dt.timedelta(minutes=10):
                sizes[n - first] = sizes.get(n - first, 0) + n - first
                first = n

    monkeypatch.setattr(replay, "FILE_ROWS", 50)
    monkeypatch.setattr(learning, "BATCH_FILES", 2)
    monkeypatch.setattr(learning, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    found = learning.stream_requests(spark, str(tmp_path)).collect()
    assert {r["n"]: r["n_rows"] for r in found} == sizes and max(sizes) >= 250
    assert all(r["n_rejected"] == (r["n_rows"] if r["n"] > 1 else 0) for r in found)
    files = spark.read.parquet(f"{tmp_path}/requests", recursiveFileLookup=True).groupBy(F.input_file_name().alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min("ts").alias("low"), F.max("ts").alias("high")).orderBy("file").collect()
    assert sum(r["n"] for r in files) == len(data) + 1
    assert len(files) >= 10 and max(r["n"] for r in files) <= 100
    files = [r for r in files if r["low"]]
    assert all(a["high"] <= b["low"] for a, b in zip(files, files[1:], strict=False))
    assert spark.read.parquet(f"{tmp_path}/sized").select("batch").distinct().count() >= 5


def test_empty_table_is_streamed(spark, tmp_path):
    """A table without rows, or with one time only, makes its files as any other."""
    from lodestat.streaming import replay

    df = spark.range(30).selectExpr("id", "timestamp '2024-01-01' AS ts")
    assert replay.write_in_order(df.limit(0), "ts", ["id"], f"{tmp_path}/none") == 0
    assert replay.write_in_order(df, "ts", ["id"], f"{tmp_path}/one") == 1
    assert spark.read.parquet(f"{tmp_path}/one/000000").count() == 30
