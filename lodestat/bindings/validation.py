"""Record validation, request limits and envelopes."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import PREDICTIONS, predictions, query, table, with_ctes
from lodestat.operators import validation as v

KINDS = ["click", "purchase", "view"]
RULES = [v.Required("kind"), v.OneOf("kind", KINDS), v.Required("note"), v.Text("note", 2, 12)]


RECORD_COLUMNS = [
    "event_id", "user_id",
    "CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS kind",
    """CASE WHEN event_id % 23 = 0 THEN '    ' WHEN event_id % 29 = 0 THEN 'x'
            WHEN event_id % 31 = 0 THEN NULL ELSE concat('  ', props) END AS note""",
]


def records(spark, sf):
    """Events as submitted records: some without a kind, some with a bad note."""
    return table(spark, sf, "events").selectExpr(*RECORD_COLUMNS)


RECORDS = """records AS (SELECT event_id, user_id, CASE WHEN event_id % 19 = 0 THEN NULL ELSE event_type END AS kind,
  CASE WHEN event_id % 23 = 0 THEN '    ' WHEN event_id % 29 = 0 THEN 'x' WHEN event_id % 31 = 0 THEN NULL
       ELSE '  ' || props END AS note FROM events)"""
_MISSING = "SELECT event_id, '{f}' AS field, 'Campo requerido ''{f}'' no proporcionado' AS message, 'missing' AS type, NULL::VARCHAR AS input FROM records WHERE {f} IS NULL"
_ENUM = """SELECT event_id, 'kind' AS field,
  'Valor inválido para ''kind''. Valores permitidos: ''click'', ''purchase'' or ''view''' AS message,
  'literal_error' AS type, kind AS input FROM records WHERE kind NOT IN ('click', 'purchase', 'view')"""
_TEXT = """SELECT event_id, 'note' AS field, '''note'' debe tener al menos 2 caracteres' AS message,
  'string_too_short' AS type, note AS input FROM records WHERE length(note) < 2
UNION ALL SELECT event_id, 'note', '''note'' no debe exceder 12 caracteres', 'string_too_long', note FROM records
  WHERE length(note) > 12
UNION ALL SELECT event_id, 'note', 'Error en ''note'': Value error, La ocupación no puede estar vacía', 'value_error', note
  FROM records WHERE length(note) BETWEEN 2 AND 12 AND trim(note) = ''"""
ERRORS = RECORDS + f""", errors AS ({_MISSING.format(f='kind')} UNION ALL {_ENUM} UNION ALL {_MISSING.format(f='note')}
  UNION ALL {_TEXT})"""


def _errors(spark, sf, rules):
    checked = v.with_errors(records(spark, sf), rules)
    return checked.select("event_id", F.inline("errors"))


@query("validate_enum", with_ctes(RECORDS) + _ENUM)
def validate_enum(spark, sf):
    return _errors(spark, sf, [v.OneOf("kind", KINDS)])


@query("validate_text", with_ctes(RECORDS) + _TEXT)
def validate_text(spark, sf):
    return _errors(spark, sf, [v.Text("note", 2, 12)])


@query("validate_required", with_ctes(RECORDS) + _MISSING.format(f="kind"))
def validate_required(spark, sf):
    return _errors(spark, sf, [v.Required("kind")])


@query("validation_errors", with_ctes(ERRORS) + "SELECT * FROM errors")
def validation_errors(spark, sf):
    return _errors(spark, sf, RULES)


@query("quarantine", with_ctes(ERRORS) + """SELECT event_id, kind, CASE WHEN n IS NULL THEN trim(note) ELSE note END AS note,
  coalesce(n, 0) AS n_errors FROM records LEFT JOIN (SELECT event_id, count(*) AS n FROM errors GROUP BY 1) USING (event_id)""")
def quarantine(spark, sf):
    valid, rejected = v.split_valid(records(spark, sf), RULES)
    return valid.select("event_id", "kind", "note", F.lit(0).cast("bigint").alias("n_errors")).unionByName(
        rejected.select("event_id", "kind", "note", F.size("errors").cast("bigint").alias("n_errors")))


@query("batch_limit", """SELECT conv_id AS request, count(*) AS n, count(*) BETWEEN 2 AND 6 AS accepted
  FROM conversations GROUP BY 1 UNION ALL
  SELECT user_id + 1000000, count(*), count(*) BETWEEN 2 AND 6 FROM events GROUP BY 1""")
def batch_limit(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id").unionAll(
        table(spark, sf, "events").select(F.col("user_id") + 1000000))
    return v.batch_limits(rows, "conv_id", 2, 6)


@query("reject_oversized", """SELECT event_id FROM events WHERE user_id IN (
  SELECT user_id FROM events GROUP BY 1 HAVING count(*) <= 65)""")
def reject_oversized(spark, sf):
    return v.reject_oversized(table(spark, sf, "events"), "user_id", 65).select("event_id")


@query("score_envelope", with_ctes(PREDICTIONS) + """, per AS (
  SELECT o_orderkey % 97 AS request, prediction, count(*) AS n FROM predictions GROUP BY ALL)
SELECT request, sum(n)::BIGINT AS total,
  '{' || string_agg('"' || prediction || '":' || n::VARCHAR, ',' ORDER BY prediction) || '}' AS predictions,
  (SELECT strftime(max(o_orderdate), '%Y-%m-%d') FROM predictions) AS timestamp FROM per GROUP BY request""")
def score_envelope(spark, sf):
    df = predictions(spark, sf).withColumn("request", F.col("o_orderkey") % 97)
    stamp = df.agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd")).scalar()
    return v.score_envelope(df, "request", "prediction", stamp)


@query("required_columns", """SELECT 'o_orderkey' AS "column", true AS present, count(o_orderkey) AS n FROM orders
UNION ALL SELECT 'lang', false, NULL UNION ALL SELECT 'o_orderstatus', true, count(o_orderstatus) FROM orders""")
def required_columns(spark, sf):
    """The expected columns of a table; a scoring call refuses a table that lacks one."""
    df = table(spark, sf, "orders")
    expected = ["o_orderkey", "lang", "o_orderstatus"]
    try:
        v.require_columns(df, expected)
    except ValueError:
        return v.column_report(df, expected)
    raise AssertionError("a missing column went unnoticed")
