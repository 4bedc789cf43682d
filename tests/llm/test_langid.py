import random

import numpy as np

from lodestat.llm import langid
from lodestat.llm.common import passages
from lodestat.llm.queries import QUERIES

PARTS = {"aa": ["the", "ing", "ou", "er"], "bb": ["ich", "ung", "der", "ß"], "cc": ["que", "é", "eau", "tre"]}


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for lang, parts in PARTS.items():
        for _ in range(n):
            rows.append((lang, " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 80)))))
    return rows


def small():
    return langid.train(corpus(1, 30), updates=60)


def test_gradients_by_differences():
    network = langid.Network(["a", "b", "c"], hidden=4)
    for unit in (network.ahead, network.back):
        unit.input, unit.state = unit.input.astype(float), unit.state.astype(float)
    network.out, network.bias = network.out.astype(float), network.bias.astype(float)
    rng = np.random.default_rng(0)
    data, label = rng.integers(97, 110, (6, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    _, gradients = network.gradients(data, label)
    for w, g in zip(network.weights(), gradients, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = w[at], 1e-3
        w[at] = kept + step
        up = network.gradients(data, label)[0]
        w[at] = kept - step
        down = network.gradients(data, label)[0]
        w[at] = kept
        assert abs((up - down) / (2 * step) - g[at]) < 2e-3


def test_learns_and_pools_whole_texts():
    network = small()
    rows = corpus(2, 30)
    names, scores = network.predict([t for _, t in rows])
    assert np.mean([a == b for a, (b, _) in zip(names, rows, strict=True)]) > 0.95 and 0 < scores.min() <= scores.max() <= 1
    first, last = corpus(3, 1)[0][1], corpus(3, 1)[1][1]
    assert network.predict([first + " " + " ".join([last] * 60)])[0] == ["bb"]  # the larger part decides, not the begin


def test_lanes_do_not_matter(monkeypatch):
    network = small()
    texts = [t for _, t in corpus(4, 20)] + [" ".join(t for _, t in corpus(5, 4))]
    names, scores = network.predict(texts)
    monkeypatch.setattr(langid, "LANES", 3)
    assert network.predict(texts)[0] == names and np.allclose(network.predict(texts)[1], scores, atol=2e-5)
    monkeypatch.setattr(langid, "LANE", 1024)
    longer = network.predict(texts)
    assert np.mean([a == b for a, b in zip(names, longer[0], strict=True)]) > 0.97 and np.abs(longer[1] - scores).max() < 0.05


def test_any_text_among_any_neighbours_is_read_as_alone():
    network = small()
    rng = random.Random(7)
    for words in (1, 5, 20, 50, 300):
        for lang, parts in PARTS.items():
            text = " ".join("".join(rng.choice(parts) for _ in range(2)) for _ in range(words))
            alone = network.predict([text])
            for other in PARTS.values():
                near = " ".join("".join(rng.choice(other) for _ in range(2)) for _ in range(rng.randint(1, 200)))
                names, scores = network.predict([near, text, near, None, text])
                assert names[1] == names[4] == alone[0][0] and np.allclose([scores[1], scores[4]], alone[1][0], atol=1.1e-5)


def test_training_reads_all_over_a_long_text(spark):
    text = "".join(f"{i:03d}-" for i in range(100))
    (row,) = spark.createDataFrame([(text,)], "text string").select(passages("text", 16, 4).alias("t")).collect()
    found = row["t"].split(" ")
    assert len(found) == 16 and found[0] == "000-" and found[-1] == "099-" and all(f in text for f in found)
    (row,) = spark.createDataFrame([("short",)], "text string").select(passages("text", 16, 4).alias("t")).collect()
    assert row["t"] == "short"


def test_unknown():
    names, scores = small().predict([None, "", "123 #!", " \n", "\U0001f600"])
    assert names == ["und"] * 5 and not scores.any()
    assert langid.train([]).predict(["text"])[0] == ["und"]


def test_edges(spark, edge_docs, no_docs):
    network = langid.train(langid.training_rows(edge_docs), updates=5)
    assert network.languages == ["en", "fr"]
    out = langid.identify(edge_docs, network).collect()
    assert len(out) == 12 and {r["lang_pred"] for r in out if r["doc_id"] in (3, 4, 5, 9)} == {"und"}
    assert langid.identify(no_docs, network).count() == 0 and langid.training_rows(no_docs) == []


def test_training_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(langid, "PER_LANGUAGE", 5)
    df = spark.range(300).selectExpr("id doc_id", "concat('text ', id) text", "if(id % 3 = 0, 'a', 'b') lang")
    rows = langid.training_rows(df)
    assert sorted(lang for lang, _ in rows) == ["a"] * 5 + ["b"] * 5


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op5_languages"](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95


def test_rows_without_an_id_do_not_fill_the_sample(spark, monkeypatch):
    rows = [(None, "the same text", "en")] * 3000 + [(None, f"without id {i}", "en") for i in range(1500)] + [(i, f"number {i}", "en") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fetched, collect = [], type(docs).collect
    monkeypatch.setattr(type(docs), "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    texts = [t for _, t in langid.training_rows(docs)]
    assert len(texts) == len(set(texts)) == langid.PER_LANGUAGE and max(map(len, fetched)) <= langid.PER_LANGUAGE
    assert 0.3 < sum(t.startswith("number") for t in texts) / len(texts) < 0.7
