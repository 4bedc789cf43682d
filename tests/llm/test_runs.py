import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from lodestat.llm import runs
from lodestat.llm.queries import QUERIES


def brute(words, exponent=4, least=6):
    """(start, length, period) of all runs, from the definition: for every period, the stretches of equal words that far apart."""
    _, codes = np.unique(np.array(words, dtype=object).astype(str) if words else np.empty(0, str), return_inverse=True)
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        same = np.concatenate([[False], codes[:-q] == codes[q:], [False]])
        start, stop = np.flatnonzero(same[1:] & ~same[:-1]), np.flatnonzero(same[:-1] & ~same[1:])
        for i, length in zip(start.tolist(), (stop - start + q).tolist(), strict=True):
            if length >= max(least, exponent * q):
                found.setdefault((i, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapse(words, found):
    gone = set()
    for s, length, q in found:
        gone.update(range(s + q, s + length))
    return [w for i, w in enumerate(words) if i not in gone]


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def contract_order(doc_id, words):
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def random_texts(count, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        words = []
        for _ in range(rng.randint(0, 6)):
            part = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
            words += part * rng.choice([1, 1, 2, 4, 5, 9])
            if rng.random() < 0.3:
                words += ["z"] * rng.randint(1, 40)
        out.append(" ".join(words))
    return out


def result(df):
    return {r["doc_id"]: ([tuple(x) for x in r["runs"]], r["collapsed"], r["n_words"]) for r in df.collect()}


def test_equal_brute_force(spark):
    texts = random_texts(150, 3) + ["a", "a " * 5, "a " * 6, "ab " * 500, "x y " * 300 + "x", "p q r " * 200 + "p q s " * 200, "\x0b\n a\x0bb\x1cc é  é é é é é\x85é",
                                    ("w " * 70 + "v ") * 9, " ".join(str(i % 131) for i in range(1310))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = result(runs.periodic_runs(df))
    for i, text in enumerate(texts):
        words = words_of(text)
        expected = brute(words)
        assert found[i] == (expected, " ".join(collapse(words, expected)), len(words)), i


@pytest.mark.parametrize("exponent, least", [(2, 2), (3, 10)])
def test_other_exponents(spark, exponent, least):
    texts = random_texts(60, 5)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = result(runs.periodic_runs(df, exponent=exponent, least=least))
    for i, text in enumerate(texts):
        assert found[i][0] == brute(words_of(text), exponent, least), i
    with pytest.raises(ValueError):
        runs.periodic_runs(df, exponent=1)


def test_extensions_equal_plain_comparison():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 400, 1, 900, 3])
    parts = [rng.integers(1, 3, n) for n in sizes]
    parts[3][200:600] = np.tile(parts[3][200:250], 8)
    parts[1][100:400] = 1
    words = np.concatenate([np.append(p, 0) for p in parts]).astype(np.int32)
    starts = np.cumsum(sizes + 1) - sizes - 1
    common = runs.Extensions(words, np.repeat(np.arange(5), sizes + 1))
    for d in (1, 3):
        i = rng.integers(0, sizes[d] - 1, 3000)
        j = i + 1 + (rng.integers(0, 10**6, 3000) % (sizes[d] - i - 1).clip(1))
        j = np.minimum(j, sizes[d] - 1)
        i, j = i[i != j], j[i != j]
        got = common(starts[d] + i, starts[d] + j)
        own = parts[d].tolist()
        for a, b, c in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
            n = 0
            while b + n < len(own) and own[a + n] == own[b + n]:
                n += 1
            assert n == c


def test_every_difference_is_covered():
    inside = set(runs.COVER.tolist())
    for a in range(runs.MODULUS):
        for b in range(runs.MODULUS):
            s = int(runs.SHIFT[a, b])
            assert {(a + s) % runs.MODULUS, (b + s) % runs.MODULUS} <= inside


def test_portions_give_the_same(spark, monkeypatch):
    texts = random_texts(40, 9) + ["k l m " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = result(runs.periodic_runs(df))
    monkeypatch.setattr(runs, "GRID_POINTS", 8)
    monkeypatch.setattr(runs, "BLOCK_BYTES", 64)
    assert result(runs.periodic_runs(df)) == whole


def test_long_texts():
    """Half a million words: one long run, and one word throughout."""
    for period in (1, 1000, 100_000):
        rng = np.random.default_rng(period)
        words = np.append(np.tile(rng.integers(1, 10**6, period), 500_000 // period), 0).astype(np.int32)
        start, stop, q = runs.find_runs(words, np.array([0]), np.array([len(words) - 1]))
        assert (start.tolist(), stop.tolist(), q.tolist()) == ([0], [len(words) - 1], [period])


def test_edges(edge_docs, no_docs):
    rows = runs.periodic_runs(edge_docs).collect()
    assert len(rows) == 12 and {r["n_words"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    assert len({str(r) for r in rows if r["doc_id"] == 1}) == 1
    assert runs.periodic_runs(no_docs).count() == 0
    assert runs.periodic_runs(edge_docs.selectExpr("cast(doc_id as string) words", "text runs"), "words", "runs").count() == 12


def test_query_equals_brute_force(spark, sf):
    found = {r["doc_id"]: r for r in QUERIES["op11_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    for d in docs:
        words = contract_order(d["doc_id"], words_of(d["text"]))
        expected, row = brute(words), found[d["doc_id"]]
        best = min(expected, key=lambda x: (-x[1], x[0], x[2])) if expected else (None,) * 3
        assert (row["n_runs"], row["start"], row["length"], row["period"]) == (len(expected), *best)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if expected else None)
        assert row["runs_sha256"] == hashlib.sha256("".join(f"{a},{b},{c}\n" for a, b, c in expected).encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(" ".join(collapse(words, expected)).encode()).hexdigest()
