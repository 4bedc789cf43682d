"""Quality rules with host verdicts.

Text statistics are counted per document with array functions, without a shuffle.
Rule failures are then aggregated by host, every host's failure rate is shrunk
towards the corpus rate by a beta prior fitted to the hosts themselves, and the
host verdicts are joined back to the documents.

Rows in, rows out: a null text counts as empty (no words, so the base rule fails),
a null host is a host of its own, repeated rows are judged each by itself, an empty
table gives an empty result, and further columns of the input are ignored.  A very
long text is counted whole, as arrays of its words in its row; a rate equal to the limit keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import SPACES, rows_with
from lodestat.session import materialize

#: A document fails with fewer words than this, or with more than this percentage of words in repeated windows.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
#: A document also counts against its host with more symbols, or repeated lines, than these per hundred words.
MAX_SYMBOLS_PERCENT = 100
MAX_DUP_LINES_PERCENT = 20
#: A host is rejected when the shrunk rate of a rule's failures is above this.
MAX_HOST_RATE = 0.5
#: The rules whose failures are aggregated by host.
RULES = ("short", "repeated", "symbols", "dup_lines")
#: Weight of the prior, in documents, when the hosts differ no more than chance alone makes them differ.
CHANCE_WEIGHT = 1e6


def _repeated_words(words: str) -> list[dict[str, Column]]:
    """Steps that end in ``n_repeat_words``: the words in 3-word windows found twice or more.

    Each window becomes one long: leading bits of its hash, then its position.  Sorting
    the longs puts equal windows side by side.  Windows with a neighbour of the same hash
    bits are then compared as texts, so that a collision never counts.
    """
    n = f"size({words})"
    return [
        {"bits": F.expr(f"length(bin({n}))")},
        {"keys": F.expr(
            f"CASE WHEN {n} > 3 THEN sort_array(transform(slice({words}, 1, {n} - 2), (x, i) -> "
            f"shiftleft(xxhash64(x, get({words}, i + 1), get({words}, i + 2)), bits) | i)) "
            f"ELSE cast(array() AS array<bigint>) END")},
        {"found": F.expr(
            "transform(filter(keys, (x, i) -> coalesce(shiftright(x, bits) = shiftright(get(keys, i - 1), bits), false) "
            "OR coalesce(shiftright(x, bits) = shiftright(get(keys, i + 1), bits), false)), "
            "x -> cast(x & (shiftleft(1L, bits) - 1) AS int))")},
        {"named": F.expr(
            f"sort_array(transform(found, p -> struct(concat_ws(' ', get({words}, p), get({words}, p + 1), "
            f"get({words}, p + 2)) AS w, p AS p)))")},
        {"places": F.expr(
            "sort_array(transform(filter(named, (x, i) -> coalesce(x.w = get(named, i - 1).w, false) "
            "OR coalesce(x.w = get(named, i + 1).w, false)), x -> x.p))")},
        {"n_repeat_words": F.expr(
            "aggregate(places, struct(0L AS total, -3 AS last), "
            "(a, p) -> struct(a.total + least(3, p - a.last) AS total, p AS last), a -> a.total)")},
    ]


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``host`` and the counts of its whole text."""
    rows = rows_with(docs, doc_id=id_col, host=host_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select(
        "doc_id", "host",
        F.array_remove(F.split("text", SPACES), "").alias("words"),
        F.filter(F.split("text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
        (F.octet_length("text") - F.octet_length(F.regexp_replace("text", r"[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
    )
    for step in _repeated_words("words"):
        rows = rows.withColumns(step)
    return rows.select(
        "doc_id", "host",
        F.size("words").cast("long").alias("n_words"),
        F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
    )


def rule_failures(stats: DataFrame) -> DataFrame:
    """The statistics with one boolean per rule."""
    return stats.withColumns({
        "short": F.col("n_words") < MIN_WORDS,
        "repeated": F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT,
        "symbols": F.col("n_symbols") * 100 > F.col("n_words") * MAX_SYMBOLS_PERCENT,
        "dup_lines": F.col("n_dup_lines") * 100 > F.col("n_words") * MAX_DUP_LINES_PERCENT,
    })


def host_verdicts(failures: DataFrame, rules: tuple[str, ...] = RULES, max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: documents, shrunk failure rate of each rule, and ``host_kept``.

    The beta prior of a rule has the corpus rate as its mean; its weight comes from the
    variance of the hosts' rates beyond binomial chance (method of moments).  Small hosts
    therefore move to the corpus rate, large ones keep their own.
    """
    hosts = failures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(r).cast("long")).alias(f"k_{r}") for r in rules])
    totals = [F.sum("n").alias("docs"), F.count(F.lit(1)).alias("hosts")]
    for r in rules:
        totals += [F.sum(f"k_{r}").alias(f"all_{r}"), F.sum(F.col(f"k_{r}") * F.col(f"k_{r}") / F.col("n")).alias(f"sq_{r}")]
    judged = hosts.crossJoin(F.broadcast(hosts.agg(*totals)))  # one row of totals
    rates = {}
    for r in rules:
        mean = F.col(f"all_{r}") / F.col("docs")
        chance = mean * (1 - mean)
        excess = F.col(f"sq_{r}") / F.col("docs") - mean * mean - chance * F.col("hosts") / F.col("docs")
        weight = F.when(excess * CHANCE_WEIGHT > chance, F.greatest(chance / excess - 1, F.lit(0.0))).otherwise(F.lit(CHANCE_WEIGHT))
        rates[f"rate_{r}"] = (F.col(f"k_{r}") + mean * weight) / (F.col("n") + weight)
    judged = judged.withColumns(rates)
    kept = F.lit(True)
    for r in rules:
        kept = kept & (F.col(f"rate_{r}") <= max_rate)
    return judged.select("host", "n", *rates, kept.alias("host_kept"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Statistics, base verdict and final verdict of every document.

    The statistics are written once; the aggregate by host and the join back read that
    narrow table, so texts are scanned once and never shuffled.
    """
    stats = materialize(rule_failures(text_statistics(docs, id_col, text_col, host_col)), "quality")
    hosts = host_verdicts(stats).select(F.col("host").alias("of"), "host_kept")
    return stats.join(hosts, F.col("host").eqNullSafe(F.col("of")), "left").select(
        *stats.columns, "host_kept",
        (F.col("short") | F.col("repeated")).alias("base_failed"),
        (~(F.col("short") | F.col("repeated")) & F.col("host_kept")).alias("kept"),
    )
