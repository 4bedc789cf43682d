"""Text cleaning expressions.

All patterns are evaluated on the JVM inside the projection; there is no Python
in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Symbols removed before a numeric parse.
NUMERIC_SYMBOLS = ",%$"
# Texts that mean "missing" before typing.
TYPING_NULLS = ("", "nan", "None")
# Texts that mean "missing" when rows are filtered (lower case).
FILTER_NULLS = ("none", "nan", "")
# Tokens a CSV reader treats as missing.
CSV_NULLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Every character that text trimming treats as blank.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

INTEGER_LITERAL = r"^[+-]?[0-9]+$"
NUMBER_LITERAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
INFINITE_LITERAL = r"(?i)^[+-]?inf(inity)?$"


def strip(col: Column) -> Column:
    return F.btrim(col, F.lit(BLANKS))


def collapse_blanks(col: Column) -> Column:
    """Every run of blanks as one space; the pattern then has a single character."""
    return F.regexp_replace(F.translate(col, BLANKS, " " * len(BLANKS)), " {2,}", " ")


def strip_symbols(col: Column) -> Column:
    """Remove thousands separators, percent and currency signs, then trim."""
    return strip(F.translate(col, NUMERIC_SYMBOLS, ""))


def null_if_token(col: Column, tokens: tuple[str, ...] = TYPING_NULLS) -> Column:
    return F.when(~col.isin(*tokens), col)


def clean_numeric_text(col: Column) -> Column:
    return null_if_token(strip_symbols(col))


def is_number_text(col: Column) -> Column:
    """Whether a whole-text numeric parse accepts the value (stricter than a cast)."""
    return col.rlike(NUMBER_LITERAL) | col.rlike(INFINITE_LITERAL)


def is_integer_text(col: Column) -> Column:
    # The pattern comes first: a failing cast costs an exception per value.
    return F.when(col.rlike(INTEGER_LITERAL), col.try_cast("bigint").isNotNull()).otherwise(F.lit(False))


def number_from_text(col: Column) -> Column:
    """Parse a text accepted by :func:`is_number_text` to double, infinities included."""
    return col.try_cast("double")


def normalize_category(col: Column, null_token: str | None = None) -> Column:
    """Trim, collapse inner blanks to one space, lower-case.

    ``null_token`` is the text that replaces NULL: ``"none"`` after typing,
    ``"nan"`` on raw input, or ``None`` to keep NULL.
    """
    cleaned = F.lower(collapse_blanks(strip(col)))
    return cleaned if null_token is None else F.coalesce(cleaned, F.lit(null_token))


def is_missing_target(col: Column) -> Column:
    """NULL or a missing token in any case; surrounding blanks are not trimmed."""
    return F.coalesce(F.lower(col.cast("string")).isin(*FILTER_NULLS), F.lit(True))


def is_missing_feature(col: Column) -> Column:
    return F.coalesce(F.lower(strip(col)).isin(*FILTER_NULLS), F.lit(True))
