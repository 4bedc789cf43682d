"""Record validation: declarative rules, error records, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.text import strip
from lodestat.operators.fitted import join_fitted, quoted

# Error types and message texts of a rejected record.
TYPE_MISSING = "missing"
TYPE_ENUM = "literal_error"
TYPE_SHORT = "string_too_short"
TYPE_LONG = "string_too_long"
TYPE_BLANK = "value_error"
MSG_MISSING = "Campo requerido '{field}' no proporcionado"
MSG_ENUM = "Valor inválido para '{field}'. Valores permitidos: {expected}"
MSG_SHORT = "'{field}' debe tener al menos {limit} caracteres"
MSG_LONG = "'{field}' no debe exceder {limit} caracteres"
MSG_BLANK = "Error en '{field}': Value error, La ocupación no puede estar vacía"

# Rows allowed in one scoring request.
REQUEST_MIN, REQUEST_MAX = 1, 100

ERROR_TYPE = "array<struct<field:string,message:string,type:string,input:string>>"


def expected_text(allowed: Sequence[str]) -> str:
    """``'a', 'b' or 'c'``."""
    shown = [f"'{a}'" for a in allowed]
    return shown[0] if len(shown) == 1 else ", ".join(shown[:-1]) + " or " + shown[-1]


@dataclass(frozen=True)
class Required:
    field: str

    def errors(self) -> list[Column]:
        return [_error(quoted(self.field).isNull(), self.field, MSG_MISSING.format(field=self.field), TYPE_MISSING)]


@dataclass(frozen=True)
class OneOf:
    field: str
    allowed: Sequence[str]

    def broken(self) -> Column:
        return quoted(self.field).isNotNull() & ~quoted(self.field).isin(*self.allowed)

    def errors(self) -> list[Column]:
        message = MSG_ENUM.format(field=self.field, expected=expected_text(self.allowed))
        return [_error(self.broken(), self.field, message, TYPE_ENUM)]


@dataclass(frozen=True)
class Text:
    """Length bounds on the text as sent, then a blank test; valid output is trimmed."""

    field: str
    shortest: int = 2
    longest: int = 50
    blank_message: str = MSG_BLANK

    def errors(self) -> list[Column]:
        col = quoted(self.field)
        size = F.char_length(col)
        short = size < self.shortest
        long = size > self.longest
        blank = ~short & ~long & (strip(col) == "")
        return [
            _error(short, self.field, MSG_SHORT.format(field=self.field, limit=self.shortest), TYPE_SHORT),
            _error(long, self.field, MSG_LONG.format(field=self.field, limit=self.longest), TYPE_LONG),
            _error(blank, self.field, self.blank_message.format(field=self.field), TYPE_BLANK),
        ]


Rule = Required | OneOf | Text


def _error(broken: Column, field: str, message: str, kind: str) -> Column:
    return F.when(broken, F.struct(
        F.lit(field).alias("field"), F.lit(message).alias("message"), F.lit(kind).alias("type"),
        quoted(field).cast("string").alias("input"),
    ))


def with_errors(df: DataFrame, rules: Sequence[Rule], out: str = "errors") -> DataFrame:
    """Add the array of broken rules, empty for a valid record."""
    checks = [e for rule in rules for e in rule.errors()]
    return df.withColumn(out, F.array_compact(F.array(*checks)).cast(ERROR_TYPE))


def trim_texts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    trimmed = {r.field for r in rules if isinstance(r, Text)}
    return df.select(*[strip(quoted(c)).alias(c) if c in trimmed else quoted(c) for c in df.columns])


def split_valid(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """``(valid, quarantine)``: valid rows with trimmed texts, the rest with their errors."""
    checked = with_errors(df, rules)
    valid = trim_texts(checked.filter(F.size("errors") == 0).drop("errors"), rules)
    return valid, checked.filter(F.size("errors") > 0)


def require_columns(df: DataFrame, expected: Sequence[str]) -> None:
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def column_report(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Whether each expected column is there, and how many rows have a value in it (NULL when it is not)."""
    there = [c for c in expected if c in df.columns]
    counts = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(there)], F.count(F.lit(1)).alias("all"))
    cells = [F.struct(F.lit(c).alias("column"), F.lit(c in there).alias("present"),
                      (F.col(f"n{there.index(c)}") if c in there else F.lit(None).cast("bigint")).alias("n")) for c in expected]
    return counts.select(F.inline(F.array(*cells)))


def batch_limits(
    df: DataFrame, request: str, shortest: int = REQUEST_MIN, longest: int = REQUEST_MAX,
    requests: DataFrame | None = None,
) -> DataFrame:
    """Rows per request and whether the size is allowed.

    ``requests`` lists requests that may have sent no rows at all.
    """
    sizes = df.groupBy(quoted(request).alias("request")).agg(F.count(F.lit(1)).alias("n"))
    if requests is not None:
        known = requests.select(quoted(request).alias("request")).distinct()
        sizes = known.join(sizes, "request", "left").select("request", F.coalesce("n", F.lit(0)).alias("n"))
    return sizes.withColumn("accepted", F.col("n").between(shortest, longest))


def score_envelope(df: DataFrame, request: str, prediction: str, stamp: Column | None = None) -> DataFrame:
    """One line per request: number of predictions, count per class, job time.

    The per-class counts are aggregated before anything is put in a map, so the
    envelope stays small however many rows one request has.
    """
    per_class = df.groupBy(quoted(request).alias("request"), quoted(prediction).alias("class")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return per_class.groupBy("request").agg(
        F.sum("n").alias("total"),
        # A missing class has no name in the map; it still counts in the total.
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(
            F.when(F.col("class").isNotNull(), F.struct("class", "n")))))).alias("predictions"),
    ).withColumn("timestamp", stamp if stamp is not None else F.current_timestamp())


def reject_oversized(df: DataFrame, request: str, longest: int = REQUEST_MAX) -> DataFrame:
    """Rows of the requests whose size is allowed."""
    allowed = batch_limits(df, request, longest=longest).filter("accepted").select(F.col("request").alias("__r"))
    return join_fitted(df, allowed, quoted(request) == F.col("__r"), "left_semi")
