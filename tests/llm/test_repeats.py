import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from lodestat.llm import exchange, repeats
from lodestat.llm.queries import QUERIES

DEPTH = 50


def brute(docs):
    """(n_removed, n_spans, kept) by looking at every window of every document."""
    least = {}
    big = float("inf")
    for i, text in docs:
        data, i = (text or "").encode(), big if i is None else i
        for p in range(len(data) - DEPTH + 1):
            w = data[p:p + DEPTH]
            least[w] = min(least.get(w, big), i)
    out = []
    for i, text in docs:
        data, i = (text or "").encode(), big if i is None else i
        gone = bytearray(len(data))
        for p in range(len(data) - DEPTH + 1):
            if least[data[p:p + DEPTH]] < i:
                gone[p:p + DEPTH] = b"\1" * DEPTH
        runs = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((sum(gone), runs, bytes(x for x, g in zip(data, gone, strict=True) if not g)))
    return out


def run(df):
    rows = repeats.cut_repeats(df).collect()
    return sorted((r["row"]["doc_id"], r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]) // 2, bytes(r["kept"])) for r in rows)


def test_equal_brute_force(spark):
    rng = random.Random(2)
    passages = ["".join(rng.choice("abcde é") for _ in range(rng.randint(40, 130))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.6 else "".join(rng.choice("xyz ü") for _ in range(rng.randint(0, 120))) for _ in range(rng.randint(0, 6))]
        docs.append((i, "".join(parts)))
    docs += [(100, "ab" * 200), (101, "ab" * 100), (102, "a" * 49), (103, "a" * 50), (104, "a" * 51), (105, "xab" + "ab" * 30), (106, None), (107, ""),
             (108, "line of words that is repeated with a period of some seventy bytes or so. " * 20), (109, "y" + "line of words that is repeated with a period of some seventy bytes or so. " * 7),
             (110, "zz" + "abcabc" * 60 + "q" * 60 + "abcabc" * 30), (111, "abcabc" * 20 + "r" + "abcabc" * 12 + "q" * 70)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    expected = [(i, len((t or "").encode()), *b) for (i, t), b in zip(docs, brute(docs), strict=True)]
    assert run(df) == sorted(expected)


def test_small_blocks_give_the_same(spark, monkeypatch):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdef ") for _ in range(400))
    docs = [(i, shared[a:a + 150] + str(i) + shared[b:b + 90]) for i, (a, b) in enumerate((rng.randrange(250), rng.randrange(300)) for _ in range(80))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    monkeypatch.setattr(exchange, "BLOCK_BYTES", 64)
    monkeypatch.setattr(exchange, "DIGIT_BYTES", 16)
    assert run(df) == sorted((i, len(t.encode()), *b) for (i, t), b in zip(docs, brute(docs), strict=True))
    monkeypatch.setattr(exchange, "PIECE_BYTES", 100)
    monkeypatch.setattr(repeats, "SLICE_BYTES", 37)
    assert run(df) == sorted((i, len(t.encode()), *b) for (i, t), b in zip(docs, brute(docs), strict=True))


def test_ids_that_repeat_or_lack(spark):
    text = "a passage of more than fifty bytes that several documents hold, word by word"
    docs = [(1, text), (1, text + " again"), (2, "x " + text), (None, text), (None, text)]
    out = repeats.cut_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    left = sorted((str(r["row"]["doc_id"]), len(r["kept"])) for r in out)
    assert left == [("1", len(text)), ("1", len(text) + 6), ("2", 2), ("None", 0), ("None", 0)]


def test_edges(edge_docs, no_docs):
    out = repeats.cut_repeats(edge_docs).collect()
    assert len(out) == 12
    by_id = {r["row"]["doc_id"]: r for r in out}
    assert len(by_id[7]["kept"]) == 0 and by_id[6]["spans"] is not None and by_id[3]["n_bytes"] == 0
    cut = repeats.cut_texts(edge_docs)
    assert cut.columns == edge_docs.columns and [f.dataType for f in cut.schema] == [f.dataType for f in edge_docs.schema]
    assert {r["doc_id"] for r in cut.collect()} == {1, 3, 4, 5, 6, 8, 9, None}
    assert repeats.cut_repeats(no_docs).count() == 0 and repeats.cut_texts(no_docs).count() == 0


def test_cut_inside_a_character(spark):
    docs = [(1, "x" * 49 + "é"), (2, "x" * 49 + "è tail")]  # the characters share their first byte
    rows = {r["doc_id"]: r for r in repeats.cut_texts(spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "7L n_chars")).collect()}
    assert rows[2]["text"] == " tail" and rows[2]["n_chars"] == 5


def test_query_equals_brute_force(spark, sf):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    found = {r["doc_id"]: (r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op8_repeated_passages"](spark, sf).collect()}
    assert found == {i: (b[0], b[1], hashlib.sha256(b[2]).hexdigest()) for (i, _), b in zip(docs, brute(docs), strict=True)}


def test_equal_rows_are_spread_over_the_blocks(spark):
    """A repeated row, and copies without an id, fill no single block; each is cut alike and none is lost."""
    text = " ".join(f"word{i * i % 97}x{i}" for i in range(60))
    rows = [(1, text[:300])] + [(2, text)] * 500 + [(None, text)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    rows = docs.select(F.col("doc_id").alias("id"), "text", F.monotonically_increasing_id().alias("number"))
    numbers = rows.select("id", exchange.block_of(F.lit(0), 64).alias("block")).groupBy("id").agg({"block": "approx_count_distinct"})
    assert all(r[1] > 40 for r in numbers.where("id = 2 OR id IS NULL").collect()) and numbers.count() == 3
    cut = repeats.cut_repeats(docs).groupBy("row.doc_id", "kept").count().collect()
    assert {(r["doc_id"], bytes(r["kept"]), r["count"]) for r in cut} == {
        (1, text[:300].encode(), 1), (2, text[300:].encode(), 500), (None, b"", 500)}


def test_a_phrase_in_unlike_surroundings_is_dealt_out():
    """Stretches go by their own hash: a head with a stretch of its own in every document fills no digit."""
    phrase = "the very same phrase of about forty letters"
    rows = [f"{i * 7919:020d}{phrase}{i * 104729:020d}" for i in range(400)]
    table = pa.table({"number": np.arange(400), "id": np.arange(400), "text": [r.encode() for r in rows],
                      "piece": np.zeros(400, np.int32), "block": np.zeros(400, np.int32)})
    block = repeats.Block(table)
    found = block.stretches()
    _, _, keys, hung = repeats._shared(block, np.ones(len(found[0]), bool), found)
    hot = np.bincount(hung.of).max()
    assert hot == 400  # one head has a stretch in every document
    sent = [b - a for _, a, b in keys.slices(64)]
    assert len(sent) == 64 and max(sent) < 4 * sum(sent) / 64


def test_a_long_text_needs_little_memory():
    """Tens of bytes for each of a slice, about twenty for each of a block."""
    import tracemalloc

    rng = np.random.default_rng(0)
    text = rng.integers(97, 123, 4 << 20, dtype=np.uint8).tobytes()
    table = pa.table({"number": [0], "id": [1], "text": [text], "piece": np.zeros(1, np.int32), "block": np.zeros(1, np.int32)})
    tracemalloc.start()
    block = repeats.Block(table)
    first, last, _ = block.stretches()
    block.spans(first, last + repeats.DEPTH)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 * len(text)


def test_a_text_of_tens_of_megabytes(spark):
    line = " ".join(str(i * i % 999_983) for i in range(2_000_000))[: 12 << 20]
    docs = spark.createDataFrame([(1, "x" * 60 + line[5 << 20: (5 << 20) + 1000]), (2, line)], "doc_id long, text string")
    rows = {r["row"]["doc_id"]: r for r in repeats.cut_repeats(docs).collect()}
    kept = bytes(rows[2]["kept"])
    assert rows[2]["n_bytes"] == len(line) and len(kept) <= len(line) - 1000
    spans = rows[2]["spans"]
    inside = [(a, b) for a, b in zip(spans[::2], spans[1::2]) if a <= 5 << 20 < b]
    assert inside and inside[0][1] >= (5 << 20) + 1000
