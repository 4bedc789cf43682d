import math

import numpy as np
import pytest

from lodestat.llm import negatives
from lodestat.llm.queries import ORACLES, QUERIES


def brute(rows, every=100, positives=5, negatives_=5, low=80, high=100):
    """Rows (id, label, vector) that take part; every anchor against every row."""
    out = []
    for anchor, label, v in rows:
        if anchor % every:
            continue
        scored = sorted((-sum(math.floor(256 * x) * math.floor(256 * y) for x, y in zip(v, w, strict=True)), i, own)
                        for i, own, w in rows if i != anchor)
        for score, i, _ in [x for x in scored if x[2] == label][:positives]:
            inside = [(s, j) for s, j, own in scored if own != label and low * -score <= 100 * -s <= high * -score]
            out += [(anchor, i, k + 1, j, -score, -s) for k, (s, j) in enumerate(inside[:negatives_])]
    return sorted(out)


def result(df):
    assert [f.simpleString() for f in df.schema] == ["anchor_id:bigint", "positive_id:bigint", "rank:int", "negative_id:bigint",
                                                     "positive_score:bigint", "negative_score:bigint"]
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")


def clustered(n, dim, seed, labels=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim)) / 2
    rows = []
    for i in range(n):
        v = centres[rng.integers(6)] + rng.normal(size=dim) * 0.05
        rows.append((i, int(rng.integers(labels)), [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("dim", [1, 5, 16])
def test_equal_brute_force(spark, dim, monkeypatch):
    monkeypatch.setattr(negatives, "CELL_ROWS", 4)
    monkeypatch.setattr(negatives, "SLICE_ROWS", 50)
    rows = clustered(600, dim, dim)
    rows += [(1000 + i, 1, rows[0][2]) for i in range(200)]  # a hot vector
    rows += [(2000, 9, rows[0][2])]  # an anchor alone with its label
    assert result(negatives.mine(frame(spark, rows))) == brute(rows)


def test_first_round_of_few_rows(spark, monkeypatch):
    """Bounds decide how much the second round reads."""
    monkeypatch.setattr(negatives, "CELL_ROWS", 2)
    rows = clustered(700, 8, 4)
    monkeypatch.setattr(negatives, "min", lambda *_: 3, raising=False)
    monkeypatch.setattr(negatives, "BLOCK_ANCHORS", 3)
    assert result(negatives.mine(frame(spark, rows), every=50)) == brute(rows, every=50)


def test_visits_fall_and_leave_out_no_row_above_the_floor():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 3, size=(200, 6)) for c in (0, 40, -60)]).round()
    left, right = negatives._codebook(x[:, :3], 8), negatives._codebook(x[:, 3:], 8)
    i, j = negatives._nearest(x[:, :3], left), negatives._nearest(x[:, 3:], right)
    shape = (len(left), len(right))
    count, r1, r2 = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape)
    np.add.at(count, (i, j), 1)
    np.maximum.at(r1, (i, j), np.sqrt(((x[:, :3] - left[i]) ** 2).sum(1)))
    np.maximum.at(r2, (i, j), np.sqrt(((x[:, 3:] - right[j]) ** 2).sum(1)))
    index = negatives.Index(6, left, right, count, r1, r2, np.zeros(count.size, np.int64), np.ones(count.size, np.int64), 1)
    cell = i * len(right) + j
    for a in x[::37]:
        scores = x @ a
        for floor in np.quantile(scores, [0.5, 0.9, 0.99]):
            seen, _ = index.visit(a, floor, 0, np.inf)
            assert set(cell[scores >= floor].tolist()) <= set(seen)
        assert len(index.visit(a, np.quantile(scores, 0.99), 0, np.inf)[0]) < (count > 0).sum()
        whole, _ = index.visit(a, -np.inf, 0, np.inf)
        part, skip = index.visit(a, -np.inf, 0, 100)
        rest, _ = index.visit(a, -np.inf, skip, np.inf)
        assert part + rest == whole and len(whole) == (count > 0).sum()


def test_rows_that_take_no_part(spark):
    good = [(0, 1, [1.0, 0.5]), (1, 1, [1.0, 0.25]), (2, 2, [0.9, 0.5]), (3, 2, [0.875, 0.5])]
    bad = [(4, None, [1.0, 1.0]), (5, 1, None), (6, 2, [None, 1.0]), (7, 2, [float("nan"), 1.0]), (8, 2, [float("inf"), 1.0]),
           (9, 2, []), (10, 2, [1.0]), (None, 2, [0.9, 0.5])]
    df = frame(spark, good + bad).selectExpr("*", "1 id", "2 cell", "3 bucket", "4 anchor", "5 n")
    assert result(negatives.mine(df)) == brute(good)
    again = result(negatives.mine(frame(spark, good + good + [(3, 7, [0.5, 0.5])])))
    assert again == brute(good)  # repeated rows count once, the smallest label stays


def test_empty_and_alone(spark):
    empty = frame(spark, [])
    assert result(negatives.mine(empty)) == []
    assert result(negatives.mine(frame(spark, [(0, 1, [1.0])]))) == []
    assert result(negatives.mine(frame(spark, [(0, 1, [1.0]), (1, 1, [-1.0]), (2, 2, [-1.0])]))) == []  # a negative score


def test_large_numbers(spark):
    rows = [(0, 1, [300.0, 1e5]), (1, 1, [300.0, 1e5]), (2, 2, [250.0, 1e5]), (3, 2, [300.0, 9.5e4])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert result(negatives.mine(df)) == brute(rows)
    beyond = [(0, 1, [1e30]), (1, 1, [1e30]), (2, 2, [1e30])]
    df = spark.createDataFrame(beyond, "vec_id long, label int, embedding array<double>")
    assert result(negatives.mine(df)) == [(0, 1, 1, 2, 2**56, 2**56)]


def test_query_equals_sql(spark, sf, db):
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    expected = sorted(db.execute(ORACLES["op13_hard_negatives"]).fetchall())
    assert expected and result(QUERIES["op13_hard_negatives"](spark, sf)) == expected
