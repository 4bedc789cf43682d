import re

from lodestat.llm import licenses


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in licenses.PHRASES:
        p = phrase.split()
        found = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_places_equal_brute_force(spark):
    texts = [None, "", "...", "cc by nc cc by nc cc by nc", "Under THE mit-license, under the MIT License", "xcc by nc", "cc by ncx é cc by nc",
             "  apache license version 2", "apache license version 20", "a under the mit license b apache  license, version 2.0 cc by-nc 4", "É cc by nc"]
    out = {r["doc_id"]: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in licenses.scan(frame(spark, texts)).collect()}
    assert out == {i: base(t) for i, t in enumerate(texts)}


def test_method_finds_changed_notices(spark):
    permission = dict(licenses.TEMPLATES[1:2])["mit"]
    words = permission.split()
    inserted = " ".join([*words[:14], "without", "any", *words[14:]])
    texts = [permission, inserted, "before " * 30 + permission.upper() + " after" * 30, "permission is hereby granted", "plain words only here"]
    out = {r["doc_id"]: r for r in licenses.scan(frame(spark, texts)).collect()}
    assert [out[i]["labels"] for i in range(5)] == ["mit", "mit", "mit", "", ""]
    assert out[0]["score"] == 1.0 and 0.6 <= out[1]["score"] < 1 and out[3]["score"] == 0
    assert out[0]["base_labels"] == ""


def test_spans_merge_neighbouring_diagonals(spark):
    words = licenses.TEMPLATES[1][1].split()
    text = " ".join(["x"] * 5 + words[:12] + ["extra"] + words[12:])
    rows = frame(spark, [text]).selectExpr("doc_id key", "split(lower(regexp_replace(text, '[^A-Za-z ]', '')), ' ') words")
    spans = licenses.license_spans(rows, licenses.TEMPLATES[1:2]).collect()
    assert len(spans) == 1 and spans[0]["first"] == 5 and spans[0]["last"] == 5 + len(words)


def test_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, "released under the mit license"), (1, "nothing"), (1, "nothing")], "doc_id long, text string")
    assert sorted(r["labels"] for r in licenses.scan(df).collect()) == ["", "", "mit"]


def test_edges(edge_docs, no_docs):
    out = licenses.scan(edge_docs)
    assert out.count() == 12 and out.where("labels is null or score is null or n_words is null").count() == 0
    assert licenses.scan(no_docs).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
