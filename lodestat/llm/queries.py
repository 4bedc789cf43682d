"""The operators bound to the given tables, and their SQL where SQL can express it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.llm import decontaminate, extract, hostrank, langid, licenses, negatives, oracles, packing, passages, quality, repeats, runs, simhash, toxicity
from lodestat.llm.common import table


def remainder(column: str, by: int) -> Column:
    """crc32 of the value as text, modulo ``by``."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(by))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "coverage", "first_word", "changed")


def quality_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hostrank.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    network = langid.train(langid.training_rows(docs.where(~held_out)))
    return langid.identify(docs, network).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def main_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = repeats.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select(
        "row.doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(*toxicity.training_texts(docs, labels.where(remainder("doc_id", 5) != 0)))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


def repeated_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """The order of a document's words in the query: of every tenth id, a tail repeats its beginning."""
    if doc_id is None:
        return None
    g, turn = divmod(zlib.crc32(str(doc_id).encode()), 10)
    if turn:
        return None
    begin = g % n
    places = np.arange(n)
    places[begin:] = begin + (places[begin:] - begin) % (1 + (n - begin) // (3 + g % 8))
    return places


def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, sf_dir, "documents"), reorder=repeated_tail)
    by_length = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    found = found.withColumn("longest", F.array_max(by_length))
    length, start, period = F.col("longest.length"), -F.col("longest.start"), -F.col("longest.period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * longest.length DIV -longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def word_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = passages.cut_passages(table(spark, sf_dir, "documents"))
    return cut.select("row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_leaks": benchmark_leaks,
    "op2_quality_hosts": quality_hosts,
    "op3_url_verdicts": url_verdicts,
    "op4_license_scan": license_scan,
    "op5_languages": languages,
    "op6_packed_sequences": packed_sequences,
    "op7_main_texts": main_texts,
    "op8_repeated_passages": repeated_passages,
    "op9_toxic_documents": toxic_documents,
    "op10_simhash_components": simhash_components,
    "op11_periodic_runs": periodic_runs,
    "op12_word_passages": word_passages,
    "op13_hard_negatives": hard_negatives,
}

#: The others train models, hash bytes or tokenise, which SQL cannot express; tests hold them against brute force.
ORACLES: dict[str, str] = {
    "op2_quality_hosts": oracles.quality_sql(),
    "op3_url_verdicts": oracles.url_sql(),
    "op4_license_scan": oracles.license_sql(),
    "op12_word_passages": oracles.PASSAGES_SQL,
    "op13_hard_negatives": oracles.NEGATIVES_SQL,
}
