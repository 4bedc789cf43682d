import hashlib
import random
import re

import numpy as np

from lodestat.llm import exchange, passages
from lodestat.llm.queries import ORACLES, QUERIES

W = passages.WINDOW


def brute(docs):
    """(n_words, n_removed, kept) by looking at every window of every document."""
    big, least, out = float("inf"), {}, []
    split = [(big if i is None else i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in docs]
    for i, words in split:
        for p in range(len(words) - W + 1):
            key = tuple(words[p:p + W])
            least[key] = min(least.get(key, big), i)
    for i, words in split:
        gone = [False] * len(words)
        for p in range(len(words) - W + 1):
            if least[tuple(words[p:p + W])] < i:
                gone[p:p + W] = [True] * W
        out.append((len(words), sum(gone), " ".join(w for w, g in zip(words, gone, strict=True) if not g)))
    return out


def run(df):
    return sorted((str(r["row"]["doc_id"]), r["n_words"], r["n_removed"], r["kept"]) for r in passages.cut_passages(df).collect())


def expected(docs):
    return sorted((str(i), *b) for (i, _), b in zip(docs, brute(docs), strict=True))


def sample(seed, count=60):
    rng = random.Random(seed)
    shared = [[f"w{rng.randint(0, 40)}" for _ in range(rng.randint(30, 140))] for _ in range(10)]
    docs = []
    for i in range(count):
        words = []
        for _ in range(rng.randint(0, 5)):
            part = rng.choice(shared)
            a = rng.randrange(len(part))
            words += part[a:] if rng.random() < 0.6 else [f"x{rng.randint(0, 9)}" for _ in range(rng.randint(0, 90))]
        docs.append((i, " ".join(words)))
    return docs


EXTREMES = [
    (100, "a " * 300), (101, "a " * 120), (102, "a " * 49), (103, "a " * 50), (104, "b " + "a " * 51 + "c"), (105, "a b " * 100), (106, None), (107, ""),
    (108, "b a " * 60), (109, "a b c " * 40 + "q " * 70), (110, "z " + "a b c " * 30 + "q " * 55), (111, "\x0b".join(["p", "é"] * 40)),
    (112, "x y " + "\n".join(["p", "é"] * 40)), (113, "k " * 60 + "l " * 60), (114, "k " * 55 + "l " * 60), (115, "l " * 60 + "k " * 60)]


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_equal_brute_force(spark):
    docs = sample(1) + EXTREMES
    assert run(frame(spark, docs)) == expected(docs)


def test_small_blocks_and_pieces_give_the_same(spark, monkeypatch):
    docs = sample(2, 30) + EXTREMES
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 200)
    monkeypatch.setattr(exchange, "DIGIT_BYTES", 100)
    monkeypatch.setattr(exchange, "PIECE_BYTES", 300)
    assert run(frame(spark, docs)) == expected(docs)


def test_ids_that_repeat_or_lack(spark):
    text = " ".join(f"word{i}" for i in range(60))
    docs = [(1, text), (1, text + " again"), (2, "x " + text), (None, text), (None, text)]
    assert run(frame(spark, docs)) == sorted([("1", 60, 0, text), ("1", 61, 0, text + " again"), ("2", 61, 60, "x"), ("None", 60, 60, ""), ("None", 60, 60, "")])


def test_edges(spark, edge_docs, no_docs):
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert run(edge_docs) == expected(docs)
    assert run(no_docs) == []
    carried = passages.cut_passages(edge_docs, keep=["lang", "row", "block", "n_chars"])
    assert carried.select("row.*").columns == ["doc_id", "lang", "row", "block", "n_chars"] and carried.count() == 12


def test_symbols_inside_a_passage_are_those_of_every_copy():
    """A symbol whose context lies in a passage is found at the same place of the passage in any surroundings."""
    rng = np.random.default_rng(3)
    passage = rng.integers(0, 6, 80)
    seen = []
    for _ in range(6):
        before, after = rng.integers(0, 6, rng.integers(0, 30)), rng.integers(0, 6, rng.integers(0, 30))
        words = exchange.mixed(np.concatenate([before, passage, after]).astype(np.uint64))
        n, at = len(words), np.arange(len(words))
        first = passages.Symbols(words, np.zeros(n, np.int64), np.array([0]), np.array([n]), at, at + 1)
        found = []
        for level in passages.levels(first, (1, 2, 3, 4)):
            inside = (level.low >= len(before)) & (level.high <= len(before) + 80)
            found.append(list(zip(level.name[inside].tolist(), (level.low[inside] - len(before)).tolist(), (level.high[inside] - len(before)).tolist(), strict=True)))
        seen.append(found)
    assert all(seen[0][3]) and len(seen[0][0]) > len(seen[0][3]) > 0
    assert all(other == seen[0] for other in seen)


def test_query_equals_sql_and_brute_force(spark, sf, db):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = sorted((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in QUERIES["op12_word_passages"](spark, sf).collect())
    assert found == sorted((i, b[0], b[1], hashlib.sha256(b[2].encode()).hexdigest()) for (i, _), b in zip(docs, brute(docs), strict=True))
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(db.execute(ORACLES["op12_word_passages"]).fetchall()) == found
