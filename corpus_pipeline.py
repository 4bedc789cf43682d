"""A training-text pipeline of five stages over the ``documents`` table.

A stage takes all rows that the stage before it kept.  Null and empty texts pass the
filters: they are not toxic, hold no benchmark item, and as texts without words they are
one group of near-duplicates.  Rows without an id are never near-duplicates of others.  An
empty table stays empty.  Further columns of the table are carried through to the last
filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestat.llm import decontaminate, packing, repeats, simhash, toxicity
from lodestat.llm.common import table
from lodestat.llm.queries import remainder, tokenizer_path
from lodestat.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go; labels teach as in the toxicity query."""
    labels = table(spark, sf_dir, "labels").where(remainder("doc_id", 5) != 0)
    return toxicity.without_toxic(docs, toxicity.fit(*toxicity.training_texts(docs, labels)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return simhash.keep_one(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document of smaller id has too are cut out of the texts."""
    return repeats.cut_texts(docs)


def drop_leaked_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, in pieces with their places in sequences."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_leaked_benchmarks),
    ("packing", pack_sequences),
]

#: Trained models, hashed bytes and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
