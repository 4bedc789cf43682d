import numpy as np
import pytest
from helpers import skewed
from pyspark.sql import functions as F

from lodestat.operators import profiling as p
from lodestat.plans.profile import profile


def table(spark):
    rows = [(i, float(i * i % 37), ["a", "b", None][i % 3], "x" if i else None, i % 2) for i in range(60)]
    return spark.createDataFrame(rows, "id long, v double, cat string, only string, target int")


def test_target_guess(spark):
    assert p.guess_target(table(spark)) == "target"
    df = spark.range(20).select(F.col("id").alias("many"), (F.col("id") % 3).alias("few"), F.lit(1).alias("one"))
    assert p.guess_target(df) == "few"
    assert p.guess_target(df.select("many", "one")) is None


def test_summary(spark):
    df = table(spark).unionByName(table(spark).filter("id < 2"))
    row = p.table_summary(df).first()
    frame = df.toPandas()
    assert (row["rows"], row["cols"], row["duplicates"]) == (62, 5, int(frame.duplicated().sum()))
    assert (row["n_numeric"], row["n_categorical"]) == (1, 4)
    assert row["null_percent_mean"] == pytest.approx(round(frame.isna().mean().mean() * 100, 2))
    assert row["cardinality_mean"] == pytest.approx(round(frame.nunique().mean(), 2))


def test_duplicates_keep_fields_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, ""), ("", None), ("a", "bc")], "a string, b string")
    assert p.duplicate_rows(df).first()[0] == 1
    zero = spark.createDataFrame([(0.0, 1), (-0.0, 1), (float("nan"), 2), (None, 2)], "x double, y int")
    assert p.duplicate_rows(zero).first()[0] == 2


def test_nulls_and_note(spark):
    rows = {r["column"]: r["n_null"] for r in p.null_profile(table(spark)).collect()}
    assert rows == {"id": 0, "v": 0, "cat": 20, "only": 1, "target": 0}
    note = p.missing_note(p.null_profile(table(spark))).first()[0]
    assert note == "Columnas con mayor porcentaje de nulos: cat (33.3%), only (1.7%), id (0.0%)."
    full = p.missing_note(p.null_profile(table(spark).select("id"))).first()[0]
    assert full == "No se detectaron valores nulos."


def test_cardinality_of_skewed_text(spark):
    df = skewed(spark).withColumn("long", F.repeat("text", 40))
    rows = {r["column"]: r["n_distinct"] for r in p.cardinality(df).collect()}
    assert rows["text"] == rows["long"] == 20_001 and rows["key"] == 30_000
    near = {r["column"]: r["n_distinct"] for r in p.cardinality(df, approximate=True).collect()}
    assert near["text"] == pytest.approx(20_001, rel=0.15)


def test_target_tables(spark):
    rows = {r["class"]: (r["n"], r["percent"]) for r in p.target_distribution(table(spark), "cat").collect()}
    assert rows == {"a": (20, 33.33), "b": (20, 33.33), None: (20, 33.33)}
    assert p.target_balance(table(spark), "only").first()["balanced"] is False
    assert p.target_balance(table(spark), "cat").first()["balanced"] is True


def test_categories(spark):
    counts = p.category_counts(table(spark))
    assert {r["column"] for r in counts.collect()} == {"cat", "only", "target", "v"} - (
        {"v"} if table(spark).select("v").distinct().count() > 20 else set())
    notes = {r["column"]: r for r in p.category_notes(counts).collect()}
    assert (notes["cat"]["n_values"], notes["cat"]["first_values"], notes["cat"]["top_value"]) == (3, "a, b, nan", "a")
    assert notes["only"]["top_percent"] == 98.3


def test_numbers_against_numpy(spark):
    df = skewed(spark)
    x = df.toPandas()["x"]
    note = p.numeric_notes(df, ["x"]).first()
    assert (note["mean"], note["sd"], note["skew"]) == pytest.approx((x.mean(), x.std(ddof=0), x.skew()))
    box = p.box_stats(df, ["x"]).first()
    q1, q2, q3 = np.quantile(x, [0.25, 0.5, 0.75])
    assert (box["q1"], box["median"], box["q3"]) == pytest.approx((q1, q2, q3))
    inside = x[(x >= q1 - 1.5 * (q3 - q1)) & (x <= q3 + 1.5 * (q3 - q1))]
    assert (box["whisker_low"], box["whisker_high"]) == (inside.min(), inside.max())
    assert box["n_outliers"] == len(x) - len(inside)
    hist = p.histogram(df, ["x"]).toPandas()
    expected, _ = np.histogram(x, bins=30)
    assert hist["n"].sum() == len(x)
    assert hist.set_index("bin")["n"].reindex(range(30), fill_value=0).tolist() == pytest.approx(expected.tolist(), abs=1)


def test_constant_and_empty_numbers(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, None), (1.0, None)], "a double, b double")
    rows = {r["column"]: r for r in p.numeric_notes(df, ["a", "b"]).collect()}
    assert rows["a"]["shape"] == "symmetric" and rows["b"]["shape"] == "empty"
    assert {(r["column"], r["bin"], r["n"]) for r in p.histogram(df, ["a", "b"]).collect()} == {("a", 0, 3)}
    assert p.box_stats(df, ["a", "b"]).filter("column = 'b'").first()["median"] is None


def test_correlation(spark):
    df = spark.range(100).select(
        F.col("id").alias("a"), (F.col("id") * -2).alias("b"), (F.col("id") % 7).alias("c"),
        F.when(F.col("id") % 2 == 0, F.col("id") % 5).alias("d"))
    frame = df.toPandas()
    for r in p.correlation(df).collect():
        assert r["r"] == pytest.approx(frame[r["column_a"]].corr(frame[r["column_b"]]))
    assert tuple(p.top_correlation(p.correlation(df)).first())[:2] == ("a", "b")
    assert p.correlation(df.select("a")).count() == 0
    assert p.correlation_matrix(df).count() == 16


def test_correlation_of_large_offsets_constants_and_single_rows(spark):
    df = spark.range(200).select(
        (F.lit(1e9) + F.col("id") / 7).alias("a"), (F.lit(1e9) + F.pmod(F.xxhash64("id"), F.lit(97)) / 3).alias("b"),
        F.lit(0.1).alias("flat"))
    frame = df.toPandas()
    found = {(r["column_a"], r["column_b"]): r["r"] for r in p.correlation(df).collect()}
    assert found[("a", "b")] == pytest.approx(frame["a"].corr(frame["b"]), abs=1e-9)
    assert found[("a", "flat")] is None
    assert p.correlation(df.limit(1)).first()["r"] is None


def test_variance_and_columns(spark):
    df = spark.range(50).select(F.col("id").alias("PC1"), (F.col("id") * 3).alias("wide"), F.col("id").alias("mid"),
                                F.lit(1).alias("mixed_type_col_2"))
    assert p.correlation_columns(df) == ["wide", "mid"]
    assert p.correlation_columns(df, 1) == ["wide"]
    assert [r["column"] for r in p.top_variance(df, k=2).collect()] == ["wide", "PC1"]
    assert p.component_columns(["pca_2", "PC1", "x"]) == {1: "PC1", 2: "pca_2"}


def test_maps_and_sizes(spark):
    folded = p.null_map(table(spark), ["id"], 4)
    assert folded.filter("column = 'cat'").agg(F.sum("n_null")).first()[0] == 20
    cells = p.null_cells(table(spark), ["id"]).agg(F.sum("cat"), F.sum("only")).first()
    assert tuple(cells) == (20, 1)
    rows = {r["metric"]: r["value"] for r in p.size_comparison(table(spark), table(spark).limit(3)).collect()}
    assert rows == {"rows_modified": 60, "cols_modified": 5, "rows_original": 3, "cols_original": 5}


def test_note(spark):
    note = p.profile_note(table(spark)).first()[0]
    assert note.startswith("El dataset contiene 60 filas y 5 columnas (1 numéricas, 4 categóricas). Target estimado: target. "
                           "7.0% nulos promedio; columnas con >10% nulos: cat. Duplicados: 0.")


def test_profile_variants(spark):
    base = profile(table(spark))
    assert {"summary", "nulls", "target", "histogram", "box", "correlation"} <= set(base)
    clean = profile(table(spark), "clean")
    assert clean["nulls"].agg(F.sum("n_null")).first()[0] == 0
    with pytest.raises(ValueError):
        profile(table(spark), "other")
    with pytest.raises(FileNotFoundError):
        profile(None, "preprocessed")
    parts = spark.range(30).select(F.col("id").alias("PC1"), (F.col("id") % 7).alias("PC2"), F.col("id").alias("f"))
    pre = profile(parts, "preprocessed")
    assert pre["scatter_1"].count() == 30
