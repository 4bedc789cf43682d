"""Deterministic pseudo-random order from key columns.

The order depends only on the key and the seed, so it is the same for any
partitioning, any cluster size and after any task retry.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.numbers import is_floating, present


def hash_order(key_cols: Sequence[str], seed: int | str) -> Column:
    parts = [_key_text(F.col(f"`{c}`")) for c in key_cols]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def _key_text(key: Column) -> Column:
    """As ``field_text``; whole numbers hold nothing to escape, which the optimizer sees from their type."""
    text = key.cast("string")
    return F.when(F.typeof(key).isin("tinyint", "smallint", "int", "bigint"), F.coalesce(text, F.lit("\\N"))).otherwise(field_text(text))


def field_text(value: Column) -> Column:
    r"""A text that can be joined with ``|``: backslashes and bars are escaped, NULL is ``\N``.

    No two rows of such fields have the same joined text, NULLs and borders included.
    """
    escaped = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(escaped, F.lit("\\N"))


def hash_choice(hashed: Column, n: int) -> Column:
    """0-based pseudo-random choice among ``n`` values."""
    return F.pmod(F.conv(F.substring(hashed, 17, 12), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def row_digest(schema: T.StructType, columns: Sequence[str] | None = None) -> Column:
    """256-bit digest of a row; equal rows (NULL equals NULL) share it.

    Wide rows then shuffle as one short key.  Each field carries its length, so
    two different rows never serialise to the same text.
    """
    parts = []
    for field in schema.fields:
        if columns is not None and field.name not in columns:
            continue
        value = present(field.name, field.dataType)
        if is_floating(field.dataType):
            value = value + F.lit(0.0)  # -0.0 and 0.0 are the same value
        text = F.to_json(F.struct(value)) if isinstance(
            field.dataType, (T.ArrayType, T.MapType, T.StructType)
        ) else value.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))
