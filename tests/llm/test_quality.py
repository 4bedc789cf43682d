import random
import re

from lodestat.llm import quality


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + d for p in places for d in range(3))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_statistics_equal_brute_force(spark):
    random.seed(3)
    texts = [None, "", " \n ", "a b c a b c", "a a a a a", "x\ny\nx\n\n \nx", "é ü  ü é\tü ü é", "a|b #c"]
    texts += [" ".join(random.choice("abcde") for _ in range(random.randint(1, 400))) for _ in range(20)]
    texts += ["\n".join(random.choice(["a b", "c", "", "d e f"]) for _ in range(30)) for _ in range(5)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "'h' source")
    found = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in quality.text_statistics(df).collect()}
    assert found == {i: brute(t) for i, t in enumerate(texts)}


def test_colliding_hash_bits_do_not_count(spark):
    text = " ".join(f"w{i}" for i in range(60_000))  # many windows, none twice
    df = spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")
    assert quality.text_statistics(df).first()["n_repeat_words"] == 0


def test_host_verdicts_are_shrunk(spark):
    rows = [(f"good{h}", False) for h in range(20) for _ in range(50)] + [("bad", True)] * 200 + [("tiny", True)]
    df = spark.createDataFrame(rows, "host string, short boolean")
    hosts = {r["host"]: r for r in quality.host_verdicts(df, ("short",)).collect()}
    assert not hosts["bad"]["host_kept"] and hosts["good3"]["host_kept"]
    assert hosts["bad"]["rate_short"] < 1 and 0 < hosts["good3"]["rate_short"]
    assert hosts["tiny"]["rate_short"] < hosts["bad"]["rate_short"]


def test_host_verdict_reaches_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, good if i % 50 == 0 else "too short", "bad") for i in range(100)] + [(i, good, f"h{i % 9}") for i in range(100, 400)]
    out = {r["doc_id"]: r for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert len(out) == 400
    assert not out[0]["kept"] and not out[0]["base_failed"] and out[1]["base_failed"] and out[150]["kept"]


def test_edges(edge_docs, no_docs):
    out = quality.judge(edge_docs).collect()
    assert len(out) == 12 and all(r["kept"] is not None for r in out)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[3]["n_words"] == 0 and by_id[3]["base_failed"] and by_id[6]["n_words"] == 30_000
    assert quality.judge(no_docs).count() == 0


def test_plan_has_no_python(edge_docs):
    plan = quality.judge(edge_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
