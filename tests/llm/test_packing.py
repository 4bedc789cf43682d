import random
import zlib

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lodestat.llm import packing
from lodestat.llm.queries import QUERIES, tokenizer_path


def test_patterns_place_every_piece_once():
    random.seed(1)
    for _ in range(200):
        size = random.choice([8, 64, 2048])
        histogram = {}
        for _ in range(random.randint(1, 40)):
            histogram[random.randint(1, size)] = random.choice([1, 2, 3, random.randint(1, 5000)])
        placed = {}
        for count, made in packing.pack_histogram(histogram, size):
            assert count > 0 and sum(n * k for n, k in made) <= size
            for length, copies in made:
                placed[length] = placed.get(length, 0) + count * copies
        assert placed == histogram


def test_patterns_are_few_and_full():
    random.seed(2)
    histogram = {n: random.randint(1, 10_000) for n in range(1, 2049)}
    patterns = packing.pack_histogram(histogram)
    tokens, packs = sum(n * k for n, k in histogram.items()), sum(c for c, _ in patterns)
    assert tokens / (packs * 2048) > 0.99 and len(patterns) < 3 * 2048
    assert len(packing.pack_histogram({n: k * 1000 for n, k in histogram.items()})) < 3 * 2048  # not a matter of the counts


def test_padding():
    assert [packing.padding(n) for n in (1, 2, 3, 1024, 1500, 2048)] == [0, 0, 2045, 0, 548, 0]


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer_path())


def expected(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids + [1]


def check(plain, docs, rows):
    """Every document's pieces in order are its ids, and every sequence is filled without gaps."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, text in docs:
        ids = expected(plain, text)
        pieces = sorted(by_doc[i], key=lambda r: r["start"])
        at = 0
        for r in pieces:
            assert r["start"] == at and r["doc_tokens"] == len(ids) and 0 < r["length"] <= 2048
            part = ids[at:at + r["length"]]
            data = b"".join(x.to_bytes(4, "little") for x in part)
            assert r["ids_crc32"] == zlib.crc32(data)
            if "ids" in r.__fields__:
                assert list(packing.read_ids(bytes(r["ids"]))) == part
            at += r["length"]
        assert at == len(ids)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    return by_sequence


def test_round_trip(spark, plain):
    odd = "don't Σ\x1cx ÀB½İx <|endoftext|>a, b<|startoftext|> é ­-  z ŉ ß№42 日本 \U0001f600"
    docs = list(enumerate([None, "", "  a\n b  ", odd, "word " * 5000, "x" * 3000, "It's We'LL 3.14 a_b"]))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    check(plain, docs, packing.pack_documents(df, tokenizer_path()).collect())


def test_query_round_trip(spark, sf, plain):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    sequences = check(plain, docs, QUERIES["op6_packed_sequences"](spark, sf).collect())
    filled = [sum(n for _, n in s) for s in sequences.values()]
    assert sum(map(packing.padding, filled)) < 0.05 * sum(filled)


def test_hot_length_is_ranked_in_parts(spark):
    pieces = spark.range(20_000).select(F.col("id").alias("piece"), F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 50 + 1).cast("long").alias("length"))
    ranks = packing.ranked(pieces, ["piece"]).groupBy("length").agg(F.count("*").alias("n"), F.countDistinct("rank").alias("d"), F.max("rank").alias("m")).collect()
    assert all(r["n"] == r["d"] == r["m"] + 1 for r in ranks)


def test_edges(edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs, tokenizer_path()).collect()
    assert sum(r["start"] == 0 for r in rows) == 12 and all(r["sequence_id"] is not None for r in rows)
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == len(rows)
    assert packing.pack_documents(no_docs, tokenizer_path()).count() == 0


def test_the_shortest_pack_comes_first():
    patterns = packing.pack_histogram({70: 1, 60: 1, 20: 1}, 100)
    assert sorted(made for _, made in patterns) == [[(60, 1), (20, 1)], [(70, 1)]]
