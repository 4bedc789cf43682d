import numpy as np

from lodestat.llm import decontaminate
from lodestat.llm.queries import QUERIES

QUESTION = "A farmer sells 12 apples to Maria on Monday and then sells 7 apples to Peter. After that Maria gives 12 apples back. How many kg did the farmer sell if an apple weighs 2 kg in total?"
CHANGED = "A farmer sells 31 apples to Sofia on Friday and then sells 9 apples to Ahmed. After that Sofia gives 31 apples back. How many lbs did the farmer sell if an apple weighs 5 lbs in total?"
BROKEN = "A farmer sells 31 apples to Sofia on Friday and then sells 9 apples to Ahmed. After that Klaus gives 44 apples back. How many lbs did the farmer sell if an apple weighs 5 lbs in total?"


def tables(spark, texts, items=(QUESTION,)):
    return (spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
            spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))


def test_placeholders():
    lexicon = decontaminate.Lexicon()
    a, slots = decontaminate.canonical(QUESTION, lexicon)
    b, others = decontaminate.canonical(CHANGED, lexicon)
    assert (a[:25] == b[:25]).all() and (slots != others).any()
    code, value = decontaminate.canonical("it costs 5 kg, 5kg or km. The Rhine", lexicon)
    assert (value != 0).tolist() == [False, False, True, True, True, False, False, False, True]
    assert len(decontaminate.canonical(None, lexicon)[0]) == len(decontaminate.canonical(" | ## ", lexicon)[0]) == 0


def test_reparameterised_question_is_caught(spark):
    docs, items = tables(spark, ["intro words here " + CHANGED + " more words", "verbatim: " + QUESTION, "nothing of the kind at all in this text", None, ""])
    out = {r["doc_id"]: r for r in decontaminate.leaks(docs, items).collect()}
    assert set(out) == {0, 1} and out[0]["changed"] > 0 and out[1]["changed"] == 0


def test_inconsistent_slots_are_not_one_occurrence(spark):
    docs, items = tables(spark, [BROKEN])
    assert decontaminate.leaks(docs, items).count() == 0


def test_case_and_signs_do_not_hide_a_leak(spark):
    text = "the quick question asks which of these many planets has no moon and why that is so"
    docs, items = tables(spark, [text.upper(), " ".join(w + "***" for w in text.split()), text.replace(" ", "\n"), text.replace(" ", " | ")], [text])
    assert {r["doc_id"] for r in decontaminate.leaks(docs, items).collect()} == {0, 1, 2, 3}


def test_large_benchmarks_take_the_join(spark, monkeypatch):
    docs, items = tables(spark, [CHANGED, QUESTION, "x"])
    small = sorted(map(tuple, decontaminate.leaks(docs, items).collect()))
    monkeypatch.setattr(decontaminate, "SMALL", 0)
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == small and len(small) == 2


def test_window_hashes_equal_brute_force():
    rng = np.random.default_rng(3)
    code = rng.integers(0, 3, 200).astype(np.uint64) + np.uint64(5)
    at, hashes = decontaminate.window_hashes(code, np.zeros(200, np.uint64))
    seen = {}
    for p, h in zip(at.tolist(), hashes.tolist(), strict=True):
        assert seen.setdefault(tuple(code[p:p + 8].tolist()), h) == h
    assert len(set(seen.values())) == len(seen) and len(at) == 193


def test_query_equals_brute_force(spark, sf):
    """Without numbers or names inside sentences, a leak is a shared run of words."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()
    lexicon = decontaminate.Lexicon()
    grams = {}
    sizes = {}
    for item in items:
        code, value = decontaminate.canonical(item["text"], lexicon)
        at, _ = decontaminate.window_hashes(code, value)
        sizes[item["item_id"]] = len(at)
        for p in at.tolist():
            grams.setdefault(tuple(code[p:p + 8].tolist()), set()).add((item["item_id"], p))
    expected = set()
    for d in docs:
        code, value = decontaminate.canonical(d["text"], lexicon)
        found = {}
        for p in decontaminate.window_hashes(code, value)[0].tolist():
            for item, at in grams.get(tuple(code[p:p + 8].tolist()), ()):
                found.setdefault(item, set()).add(at)
        expected |= {(d["doc_id"], i, len(x)) for i, x in found.items() if len(x) >= 12 or len(x) / sizes[i] >= 0.4}
    assert {(r["doc_id"], r["item_id"], r["matched"]) for r in QUERIES["op1_benchmark_leaks"](spark, sf).collect()} == expected


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven twelve thirteen fourteen", "x"), (2, None, "y"), (3, "", "z"), (4, "short one", "z")],
                                  "item_id long, text string, hash string")
    assert {r["doc_id"] for r in decontaminate.leaks(edge_docs, items).collect()} == {1, 2}
    kept = decontaminate.remove_leaks(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == 9
    assert decontaminate.leaks(no_docs, items).count() == 0 and decontaminate.leaks(edge_docs, items.where("1 = 0")).count() == 0


def test_items_without_a_window_are_found_whole(spark):
    dense, short = "Compute 12 + 7 * 3 - 4 / 2 and 9 * 8", "What is 12 plus 7?"
    texts = ["so: " + dense, "Compute 5 + 6 * 1 - 2 / 3 and 4 * 7 now", "He asked. What is 3 plus 9? Nobody knew.", "compute 12 or not and so on", "all of 1 2 3 4 9", "as 1 2 3 5 4 9"]
    docs, items = tables(spark, texts, [dense, short, "1 2 3 4 9"])
    found = {(r["doc_id"], r["item_id"]): r["changed"] for r in decontaminate.leaks(docs, items).collect()}
    assert {k: v > 0 for k, v in found.items()} == {(0, 0): False, (1, 0): True, (2, 1): True, (4, 2): False}


def test_names_that_begin_sentences_may_be_changed(spark):
    item = "Alice has 3 apples in her small basket. Bob gives her many more apples today. Alice eats some of them with her friend. How many apples are left there now?"
    renamed = item.replace("Alice", "Carol").replace("Bob", "Dave")
    mixed = "today " + renamed.replace("How", "how")  # one beginning renamed, another in lower case
    broken = renamed.replace("Carol eats", "Erwin eats")
    docs, items = tables(spark, [item, renamed, mixed, item.upper(), broken], [item])
    found = {r["doc_id"]: (r["coverage"], r["changed"]) for r in decontaminate.leaks(docs, items).collect()}
    assert set(found) == {0, 1, 2, 3} and found[0] == (1.0, 0) and found[1][0] > 0.8 and found[1][1] == 2 and found[3][1] == 0


def test_items_of_a_few_words_leak_into_nothing(spark):
    texts = ["Nobody said yes to it", "and that is all, he said", "Yes", "12", "a b c d"]
    docs, items = tables(spark, texts, ["Yes", "That is all", "12", "a b c d", "", QUESTION])
    assert decontaminate.leaks(docs, items).count() == 0 and decontaminate.remove_leaks(docs, items).count() == 5
    assert {(r["item_id"], r["words"]) for r in decontaminate.short_items(items).collect()} == {(0, 1), (1, 3), (2, 1), (3, 4), (4, 0)}


def test_groups_of_texts_give_the_same(spark, monkeypatch):
    texts = [CHANGED, "x", None, QUESTION, "", "What is 3 plus 9?", CHANGED + " " + QUESTION, "2 kg", "Kg"]
    docs, items = tables(spark, texts, [QUESTION, "What is 12 plus 7?"])
    whole = sorted(map(tuple, decontaminate.leaks(docs.coalesce(1), items).collect()))
    monkeypatch.setattr(decontaminate, "GROUP_WORDS", 1)
    monkeypatch.setattr(decontaminate, "MARKED", 3)
    assert sorted(map(tuple, decontaminate.leaks(docs, items).collect())) == whole and len(whole) == 4


def test_usual_words_are_described_as_by_the_patterns(monkeypatch):
    words = ["word", "Word.", "'Name'", "ÉTÉ,", "x", "X!", "km", "(Km)", "end?\"", "été:", "_a_", "don't", "ab1", "#tag", "a-b", "Straße;", "\u0301a", "Don\u2019t", "a\u2019"]
    quick = [decontaminate.Lexicon.describe(w) for w in words]
    monkeypatch.setattr(decontaminate, "_SIGNS", "\x00")
    slow = [decontaminate.Lexicon.describe(w if not w.isalpha() else "\x00" + w) for w in words]
    assert [q[:3] + q[4:] for q in quick] == [q[:3] + q[4:] for q in slow]
    assert [q[3] for q, w in zip(quick, words, strict=True)] == [s[3] for s in slow]
