import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestat.operators import encoding, imputing, profiling, ranking, wide
from lodestat.operators.ranking import exact_quantiles


def frame(spark, x, gaps=None):
    """The columns of ``x``; ``gaps`` marks missing cells."""
    import pandas as pd

    table = pd.DataFrame({f"c{i}": x[:, i] for i in range(x.shape[1])})
    if gaps is not None:
        table = table.mask(pd.DataFrame(gaps, columns=table.columns))
    return spark.createDataFrame(table).repartition(5)


# ---------------------------------------------------------------- correlation
def expected_r(x):
    out = {}
    for i in range(x.shape[1]):
        for j in range(i + 1, x.shape[1]):
            both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
            a, b = x[both, i], x[both, j]
            out[i, j] = np.corrcoef(a, b)[0, 1] if both.sum() > 1 and np.ptp(a) > 0 and np.ptp(b) > 0 else None
    return out


@pytest.mark.parametrize("block", [128, 7])
def test_blocks_equal_pairwise_correlation(spark, monkeypatch, block):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 45)) * 10.0 ** rng.integers(-3, 5, 45) + 1e4
    x[:, 1] = x[:, 0] * 3 + rng.normal(size=300) * 1e-2
    x[:, 2], x[:, 3] = 7.0, np.nan
    gaps = rng.random(x.shape) < 0.1
    gaps[:, :2] = False
    x[gaps] = np.nan
    monkeypatch.setattr(wide, "BLOCK", block)
    monkeypatch.setattr(wide, "PASS_BYTES", 5 * 8 * block * block * 3)  # several passes
    found = {(r["i"], r["j"]): r["r"] for r in profiling.correlation(frame(spark, x)).collect()}
    for pair, r in expected_r(x).items():
        assert found.pop(pair) == (None if r is None else pytest.approx(r, abs=1e-9)), pair
    assert not found


def test_both_ways_of_correlation_agree(spark, monkeypatch):
    rng = np.random.default_rng(2)
    df = frame(spark, rng.normal(size=(200, 8)), rng.random((200, 8)) < 0.2)
    paired = {(r["column_a"], r["column_b"]): r["r"] for r in profiling.correlation(df).collect()}
    monkeypatch.setattr(profiling, "PAIRED_COLUMNS", 2)
    blocked = {(r["column_a"], r["column_b"]): r["r"] for r in profiling.correlation(df).collect()}
    assert blocked == {k: pytest.approx(v, abs=1e-9) for k, v in paired.items()}


def test_a_thousand_columns_in_a_plan_of_a_few_steps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 1000))
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").select(*[F.col("v")[i].alias(f"c{i}") for i in range(1000)])
    found = profiling.correlation(df)
    assert found.filter("i >= j").count() == 0
    r = np.full((1000, 1000), np.nan)
    rows = found.select("i", "j", "r").toPandas()
    r[rows["i"], rows["j"]] = rows["r"]
    upper = np.triu_indices(1000, 1)
    assert len(rows) == 499_500 and np.allclose(r[upper], np.corrcoef(x.T)[upper], atol=1e-9)


# ---------------------------------------------------------------- components
def exact(x, k):
    centred = x - x.mean(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred)
    best = vectors[:, ::-1][:, :k]
    sign = np.where(best[np.abs(best).argmax(axis=0), range(k)] < 0, -1, 1)
    return best * sign, values[::-1][:k] / values.sum()


@pytest.mark.parametrize("width", [64, 1000])
def test_search_equals_the_whole_decomposition(spark, monkeypatch, width):
    rng = np.random.default_rng(width)
    x = rng.normal(size=(400, 6)) * [9, 6, 4, 2, 1, 1] @ rng.normal(size=(6, width)) + rng.normal(size=(400, width)) * 0.3 + rng.normal(size=width) * 5
    df = spark.createDataFrame([(row.tolist(),) for row in x], "v array<double>").repartition(4)
    monkeypatch.setattr(encoding, "DENSE_WIDTH", 8)
    found = encoding.fit_components(df, F.col("v"), [f"c{i}" for i in range(width)], 3)
    loadings, shares = exact(x, 3)
    assert np.allclose(np.array(found.loadings).T, loadings, atol=1e-7) and np.allclose(found.explained, shares, atol=1e-9)
    assert np.allclose(found.means, x.mean(axis=0))
    again = encoding.fit_components(df.repartition(3), F.col("v"), [f"c{i}" for i in range(width)], 3)
    assert np.allclose(again.loadings, found.loadings, atol=1e-7)


def test_sparse_rows_equal_dense_ones(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.normal()), None if i % 11 == 0 else f"a{rng.integers(0, 9) ** 2 // 9}", f"b{rng.integers(0, 4)}") for i in range(500)]
    df = spark.createDataFrame(rows, "key long, x double, a string, b string")
    dense = encoding.preprocess_advanced(df, ["x"], ["a", "b"], 3, keep=["key"]).orderBy("key").toPandas()
    monkeypatch.setattr(encoding, "DENSE_WIDTH", 2)
    sparse = encoding.preprocess_advanced(df, ["x"], ["a", "b"], 3, keep=["key"]).orderBy("key").toPandas()
    assert list(dense.columns) == list(sparse.columns)
    for c in ("PC1", "PC2", "PC3"):
        assert np.allclose(dense[c], sparse[c], atol=1e-6)


def test_vectors_of_another_length_are_refused(spark, monkeypatch):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), ([0.0, 1.0],)], "v array<double>")
    with pytest.raises(ValueError, match="another length"):
        encoding.fit_components(df, F.col("v"), ["a", "b"], 1)
    monkeypatch.setattr(encoding, "DENSE_WIDTH", 1)
    with pytest.raises(Exception, match="was expected"):
        encoding.fit_components(df, F.col("v"), ["a", "b"], 1)


# ---------------------------------------------------------------- quantiles
def test_keys_have_the_order_of_the_numbers():
    values = np.array([-np.inf, -1e300, -1.5, -1.0, -5e-324, 0.0, 5e-324, 1.0, 1.0000000000000002, 2.0, 1e300, np.inf])
    keys = ranking.order_keys(values)
    assert (np.diff(keys.astype(object)) > 0).all()
    assert [ranking._value_of(int(k)) for k in keys] == values.tolist()


@pytest.mark.parametrize("finish", [0, 1, 40])
def test_quantiles_by_digits(spark, finish):
    rng = np.random.default_rng(7)
    a = np.concatenate([rng.normal(size=500), np.full(400, 2.5), -(10.0 ** rng.uniform(-300, 300, 200)), [0.0, -0.0, 1e-310]])
    b = rng.integers(-3, 4, len(a)).astype(float)
    df = spark.createDataFrame([(float(x), float(y), None) for x, y in zip(a, b)], "a double, b double, c double").repartition(6)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = exact_quantiles(df, ["a", "b", "c"], ps, finish_rows=finish)
    for name, x in (("a", a), ("b", b)):
        for p in ps:
            assert found[name][p] == pytest.approx(np.quantile(x, p), rel=1e-12)
    assert set(found["c"].values()) == {None}


def test_the_source_is_read_twice_at_most(spark, tmp_path):
    spark.range(3000).selectExpr("cast(id * id % 1009 as double) x").write.parquet(str(tmp_path / "t"))
    reads = spark.sparkContext.accumulator(0)
    df = spark.read.parquet(str(tmp_path / "t")).coalesce(1)

    def noted(batches):
        reads.add(1)
        yield from batches

    found = exact_quantiles(df.mapInArrow(noted, df.schema), ["x"], [0.25, 0.5], finish_rows=1)
    assert reads.value == 2
    assert found["x"][0.5] == np.quantile([i * i % 1009 for i in range(3000)], 0.5)


# ---------------------------------------------------------------- modes
@pytest.mark.parametrize("buckets", [1 << 16, 3])
def test_modes_of_free_text(spark, monkeypatch, buckets):
    monkeypatch.setattr(imputing, "MODE_BUCKETS", buckets)
    long = "a long free text that is kept by its digest only, as it has more than sixty-four letters "
    rows = [(f"unique {i}", long + str(i % 97), float(i % 5) if i % 7 else None, i % 2 == 0) for i in range(600)]
    rows += [("none", long + "tie", 9.0, True)] * 8 + [("other", long + "a tie", 10.0, False)] * 8
    df = spark.createDataFrame(rows, "t string, l string, x double, f boolean").repartition(4)
    counts = {c: df.filter(F.col(c).isNotNull()).groupBy(c).count().collect() for c in df.columns}
    found = imputing.fit_modes(df, df.columns)
    for c, rows_of in counts.items():
        top = max(n for _, n in rows_of)
        best = min(v for v, n in rows_of if n == top)
        assert found[c] == (best if isinstance(best, str) else spark.createDataFrame([(best,)], f"v {dict(df.dtypes)[c]}").selectExpr("cast(v as string)").first()[0])


def test_all_values_tie(spark):
    df = spark.createDataFrame([(f"t{i}", float(100 - i)) for i in range(50)], "t string, x double")
    assert imputing.fit_modes(df, ["t", "x"]) == {"t": "t0", "x": "51.0"}
    with pytest.raises(ValueError):
        imputing.fit_modes(df.limit(0), ["t"])
