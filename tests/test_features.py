import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import encoding as f

ROWS = [(1, 1.0, "A", "X", "t"), (2, 3.0, "B", "X", "u"), (3, 2.0, "A", "Y", "t"), (4, 8.0, "C", "Y", "u"), (5, 1.0, "B", "X", "t")]
SCHEMA = "n long, x double, c string, `d e` string, target string"


def df(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_scaling_uses_the_population_deviation(spark):
    out = f.fit_scaler(df(spark), ["x"]).transform(df(spark)).orderBy("n").toPandas()["x"].to_numpy()
    x = np.array([r[1] for r in ROWS])
    assert out == pytest.approx((x - x.mean()) / x.std())
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert [r[0] for r in f.fit_scaler(flat, ["x"]).transform(flat).collect()] == [0.0, 0.0]


def test_one_hot_names_and_unseen_values(spark):
    categories = f.fit_categories(df(spark), ["c", "d e"])
    new = spark.createDataFrame([(1, 1.0, "Z", None, "t")], SCHEMA)
    out = new.select(*f.one_hot_select(new, categories))
    assert out.columns == ["c_A", "c_B", "c_C", "d e_X", "d e_Y"]
    assert tuple(out.first()) == (0.0,) * 5


def test_too_many_categories(spark):
    with pytest.raises(ValueError, match="too many categories"):
        f.fit_categories(spark.range(50).select(F.col("id").cast("string").alias("c")), ["c"], limit=20)


def test_vector_has_one_slot_per_known_category(spark):
    model = f.feature_model(df(spark), ["c", "d e"], ["x"])
    new = spark.createDataFrame([(1, 1.5, "B", "Y", "t"), (2, 2.5, "Z", None, "t")], SCHEMA)
    rows = [r["features"].toArray().tolist() for r in model.transform(new).orderBy("n").collect()]
    assert rows == [[1.5, 0, 1, 0, 0, 1], [2.5, 0, 0, 0, 0, 0]]


def test_columns_without_values_take_no_slots(spark):
    frame = spark.createDataFrame([(1.0, "a", None), (2.0, "b", None)], "x double, c string, e string")
    model = f.feature_model(frame, ["c", "e"], ["x"])
    assert [r["features"].size for r in model.transform(frame).collect()] == [3, 3]


def test_components_match_a_direct_decomposition(spark):
    rng = np.random.default_rng(0)
    data = rng.normal(size=(200, 4)) @ np.diag([5, 2, 1, 0.1]) + 3
    frame = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(data)], "i int, v array<double>")
    parts = f.fit_components(frame, F.col("v"), list("abcd"), 3)
    got = frame.orderBy("i").select(*parts.columns(F.col("v"))).toPandas().to_numpy()
    centred = data - data.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    for k in range(3):
        w = vt[k] * np.sign(vt[k][np.argmax(np.abs(vt[k]))])
        assert got[:, k] == pytest.approx(centred @ w, abs=1e-8)
    assert parts.explained == pytest.approx((s**2 / (s**2).sum())[:3])


def test_feature_tables(spark):
    out = f.preprocess_advanced(df(spark), ["x"], ["c"], 2)
    assert out.columns == ["x", "c_A", "c_B", "c_C", "PC1", "PC2"]
    assert out.agg(F.avg("x")).first()[0] == pytest.approx(0.0)
    assert f.preprocess_advanced(df(spark), ["x"], ["c"], 0).columns == ["x", "c_A", "c_B", "c_C"]
    assert f.preprocess_advanced(df(spark), ["x"], [], 9).columns == ["x", "PC1"]
    same = df(spark)
    assert f.preprocess_advanced(same, [], []) is same
    kept = f.preprocess_for_training(df(spark), ["x"], ["c"])
    assert kept.columns == ["x", "c_A", "c_B", "c_C", "n", "d e", "target"]
    assert sorted(r["x"] for r in kept.collect()) == [1.0, 1.0, 2.0, 3.0, 8.0]


def test_labels(spark):
    mapping = f.label_map(df(spark), "c")
    coded = f.encode_labels(df(spark), "c", mapping)
    assert [r["label_id"] for r in coded.orderBy("n").collect()] == [0, 1, 0, 2, 1]
    back = f.decode_labels(coded.select("n", "label_id"), "label_id", mapping)
    assert [r["label"] for r in back.orderBy("n").collect()] == ["A", "B", "A", "C", "B"]


def test_ordinal(spark):
    good = spark.createDataFrame([(1, " VG "), (2, "average")], "n long, p string")
    order = ["average", "good", "vg", "excellent"]
    assert [r["id"] for r in f.encode_ordinal(good, "p", order, "id").orderBy("n").collect()] == [2, 0]
    bad = spark.createDataFrame([("zzz",), ("good",), ("bad",)], "p string")
    with pytest.raises(ValueError, match=r"\['bad', 'zzz'\]"):
        f.encode_ordinal(bad, "p", order, "id")
