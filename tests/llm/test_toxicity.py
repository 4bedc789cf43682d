import random

from lodestat.llm import toxicity
from lodestat.llm.queries import QUERIES

BAD = ["frobnitz", "quxwad", "zorble", "mugwort"]


def corpus(seed, n, toxic):
    rng = random.Random(0)
    words = ["".join(rng.choice(["an", "er", "th", "in", "on", "sh"]) for _ in range(rng.randint(1, 4))) for _ in range(800)]
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 150))]
        if toxic:
            for _ in range(rng.randint(3, 6)):
                text.insert(rng.randrange(len(text)), rng.choice(BAD))
        texts.append(" ".join(text))
    return texts


def test_held_out_accuracy():
    model = toxicity.fit(corpus(1, 150, True), corpus(2, 400, False))
    score = model.scorer()
    assert sum(score(t) >= 0.5 for t in corpus(3, 100, True)) >= 95
    assert sum(score(t) >= 0.5 for t in corpus(4, 300, False)) <= 6


def test_distance_is_the_difference_of_compressed_sizes():
    model = toxicity.fit(corpus(1, 150, True), corpus(2, 400, False))
    distance = toxicity.Distance(model.toxic, model.ordinary)
    assert min(distance(w) for w in BAD) >= 3 and distance("then") <= 2
    found = distance.evidence("then frobnitz and QUXWAD")
    assert found[0] == 4 and found[1] >= 2


def test_late_words_count():
    """Whole texts are scored, not their begin."""
    score = toxicity.fit(corpus(1, 150, True), corpus(2, 400, False)).scorer()
    filler = " ".join(corpus(5, 30, False))
    assert score(filler + " " + " ".join(BAD * 40)) > score(filler)


def test_one_label_only(spark, edge_docs):
    assert toxicity.fit([], ["a b"]) is None and toxicity.fit(["a"], []) is None
    out = toxicity.score(edge_docs, None).collect()
    assert len(out) == 12 and all(r["score"] == 0 and r["predicted"] == 0 for r in out)
    assert toxicity.without_toxic(edge_docs, None).count() == 12


def test_edges(spark, edge_docs, no_docs):
    model = toxicity.fit(corpus(1, 60, True), corpus(2, 100, False))
    out = toxicity.score(edge_docs, model).collect()
    assert len(out) == 12 and all(0 <= r["score"] <= 1 for r in out)
    kept = toxicity.without_toxic(edge_docs, model)
    assert kept.schema == edge_docs.schema and {1, 3, 4} <= {r["doc_id"] for r in kept.collect()}
    assert toxicity.score(no_docs, model).count() == 0 and toxicity.without_toxic(no_docs, model).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None), (1, 1)], "doc_id long, toxic int")
    toxic, ordinary = toxicity.training_texts(edge_docs, labels)
    assert len(toxic) == 1 and len(ordinary) == 1


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op9_toxic_documents"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = out.where("held_out").join(labels, "doc_id").collect()
    right = sum(r["predicted"] == r["toxic"] for r in rows)
    caught = sum(r["predicted"] for r in rows if r["toxic"]) / max(1, sum(r["toxic"] for r in rows))
    assert right / len(rows) > 0.94 and caught > 0.7


def test_rows_that_repeat_an_id_stay_on_the_executors(spark, monkeypatch):
    docs = spark.createDataFrame([(i if i < 20 else 7, f"text {i:04d}") for i in range(600)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, toxic int")
    fetched, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    toxic, ordinary = toxicity.training_texts(docs, labels)
    assert max(map(len, fetched)) <= 20
    assert toxic == [f"text {i:04d}" for i in range(1, 20, 2)] and ordinary == [f"text {i:04d}" for i in range(0, 20, 2)]


def test_an_id_labelled_both_ways_teaches_nothing(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(4)], "doc_id long, text string")
    labels = [(0, 1), (1, 0), (2, 1), (2, 0), (3, 1), (3, 1)]
    for order in (labels, labels[::-1]):
        found = toxicity.training_texts(docs, spark.createDataFrame(order, "doc_id long, toxic int"))
        assert found == (["text 0", "text 3"], ["text 1"])
