"""Shared pieces of the training-text operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows_with(docs: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under names of our own, so that other columns of ``docs`` never clash."""
    return docs.select(*[F.col(f"`{source}`").alias(name) for name, source in columns.items()])


def total_bytes(df: DataFrame, column: str) -> int:
    """Bytes of a text or binary column; one column is scanned and one number returned."""
    return df.agg(F.sum(F.octet_length(column))).first()[0] or 0


def give_back() -> None:
    """Return memory that Arrow and the C library keep for later: a worker outlives its task, and idle memory counts like used."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library
    if trim is not None:
        trim(0)


def power_of_two(n: int) -> int:
    return 1 << max(0, n - 1).bit_length()


def in_blocks(batches: Iterator[pa.RecordBatch], size: Callable[[pa.RecordBatch], int], limit: int) -> Iterator[pa.Table]:
    """Tables of about ``limit`` bytes: small Arrow batches together, large ones in slices."""
    held, weight = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = size(batch)
        rows = max(1, batch.num_rows * limit // max(1, whole))
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            weight += whole * held[-1].num_rows // batch.num_rows
            if weight >= limit:
                yield pa.Table.from_batches(held)
                held, weight = [], 0
    if held:
        yield pa.Table.from_batches(held)


def spread(*columns: str | Column, over: int) -> Column:
    """A bucket from 0 to ``over`` - 1 that depends on the given values only."""
    return F.pmod(F.xxhash64(*columns), F.lit(over)).cast("int")


def passages(text: str, many: int, chars: int) -> Column:
    """The text, or of a longer one ``many`` passages of ``chars`` characters from all over it, the first and the last included."""
    size = F.length(text)
    at = F.transform(F.sequence(F.lit(0), F.lit(many - 1)), lambda i: F.substring(
        text, 1 + F.floor(i * (size - chars) / (many - 1)).cast("int"), F.lit(chars)))
    return F.when(size <= many * chars, F.col(text)).otherwise(F.array_join(at, " "))
