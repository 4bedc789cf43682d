"""Typing, cleaning, filters and column selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import (
    DIRTY, DOCS, ORDERS_FEAT, SQL_NUMBER, TEXTS, dirty_orders, docs_labeled, orders_feat, query, r6, sql_clean,
    sql_normal, sql_strip, sql_symbols, table, union_all, with_ctes,
)
from lodestat.functions import text
from lodestat.operators import cleaning as c
from lodestat.operators import imputing, typing
from lodestat.plans.clean import make_clean


@query("strip_symbols", with_ctes(DIRTY) + f"""SELECT o_orderkey, {sql_symbols('price_text')} AS price,
  {sql_symbols('percent_text')} AS percent FROM dirty""")
def strip_symbols(spark, sf):
    return dirty_orders(spark, sf).select(
        "o_orderkey", text.strip_symbols(F.col("price_text")).alias("price"),
        text.strip_symbols(F.col("percent_text")).alias("percent"))


@query("null_tokens", with_ctes(DIRTY) + f"""SELECT o_orderkey, {sql_clean('price_text')} AS price,
  {sql_clean('priority_text')} AS priority FROM dirty""")
def null_tokens(spark, sf):
    return dirty_orders(spark, sf).select(
        "o_orderkey", text.clean_numeric_text(F.col("price_text")).alias("price"),
        text.clean_numeric_text(F.col("priority_text")).alias("priority"))


def _decision(name: str) -> str:
    v = sql_clean(name)
    return f"""SELECT '{name}' AS "column", CASE
  WHEN bool_and(v IS NULL OR regexp_matches(v, '^[+-]?[0-9]+$')) THEN 'bigint'
  WHEN bool_and(v IS NULL OR regexp_matches(v, {SQL_NUMBER})) THEN 'double' ELSE 'string' END AS decided
  FROM (SELECT {v} AS v FROM dirty)"""


@query("coerce_numeric", with_ctes(DIRTY) + union_all([_decision(t) for t in TEXTS]))
def coerce_numeric(spark, sf):
    df = dirty_orders(spark, sf)
    typed = typing.coerce_numeric(df, TEXTS)
    return spark.createDataFrame([(n, t) for n, t in typed.dtypes if n in TEXTS], "column string, decided string")


_TYPED = f"""SELECT o_orderkey, ({sql_clean('price_text')})::DOUBLE AS price_text,
  ({sql_clean('percent_text')})::BIGINT AS percent_text, ({sql_clean('code_text')})::BIGINT AS code_text,
  {sql_clean('note_text')} AS note_text, {sql_clean('priority_text')} AS priority_text"""


@query("basic_typing", with_ctes(DIRTY) + _TYPED + ", mixed_type_col::BIGINT AS mixed_type_col FROM dirty")
def basic_typing(spark, sf):
    return typing.basic_typing(dirty_orders(spark, sf))


_LINE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("split_num_cat", union_all([
    f"""SELECT '{x}' AS "column", CASE WHEN count(DISTINCT {x}) <= 30 THEN 'categorical' ELSE 'numeric' END AS role
    FROM lineitem""" for x in _LINE] + [
    f"SELECT '{x}', 'categorical' FROM lineitem HAVING count(*) > 0"
    for x in ("l_returnflag", "l_linestatus", "l_shipdate")]))
def split_num_cat(spark, sf):
    df = table(spark, sf, "lineitem")
    return typing.roles_table(df, typing.split_num_cat(df))


@query("normalize_categories", f"""SELECT doc_id, md5({sql_normal('text')}) AS text_md5,
  {sql_normal("'  ' || upper(lang) || '  ' || source")} AS tag FROM documents""")
def normalize_categories(spark, sf):
    tag = F.concat(F.lit("  "), F.upper("lang"), F.lit("  "), F.col("source"))
    return table(spark, sf, "documents").select(
        "doc_id", F.md5(text.normalize_category(F.col("text"))).alias("text_md5"),
        text.normalize_category(tag).alias("tag"))


@query("clean_categoricals", with_ctes(DIRTY) + f"""SELECT o_orderkey, price_text, percent_text, code_text,
  coalesce({sql_normal('note_text')}, 'nan') AS note_text, coalesce({sql_normal('priority_text')}, 'nan') AS priority_text,
  mixed_type_col FROM dirty""")
def clean_categoricals(spark, sf):
    return c.clean_categoricals(dirty_orders(spark, sf), ["note_text", "priority_text", "o_orderkey"], "nan")


@query("make_clean", with_ctes(DIRTY, f"typed AS ({_TYPED} FROM dirty)") + f"""SELECT o_orderkey, price_text, percent_text,
  code_text, coalesce({sql_normal('note_text')}, 'none') AS note_text,
  coalesce({sql_normal('priority_text')}, 'none') AS priority_text FROM typed""")
def clean_table(spark, sf):
    return make_clean(dirty_orders(spark, sf), "none")


@query("impute_median", with_ctes(DOCS) + """SELECT doc_id,
  coalesce(quality::DOUBLE, (SELECT median(quality) FROM docs)) AS quality,
  coalesce(nullif(n_chars, n_chars // 7 * 7)::DOUBLE, (SELECT median(nullif(n_chars, n_chars // 7 * 7)) FROM docs)) AS n_chars
  FROM docs""")
def impute_median(spark, sf):
    df = docs_labeled(spark, sf).select(
        "doc_id", "quality", F.expr("nullif(n_chars, n_chars div 7 * 7)").alias("n_chars"))
    return imputing.Imputer(imputing.fit_medians(df, ["quality", "n_chars"])).transform(df)


_MODE = "(SELECT {c} FROM {t} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


@query("impute_mode", with_ctes(DOCS, """gaps AS (SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN lang END AS lang,
  CASE WHEN doc_id % 5 <> 0 THEN source END AS source, toxic FROM docs)""") +
    f"""SELECT doc_id, coalesce(lang, {_MODE.format(c='lang', t='gaps')}) AS lang,
  coalesce(source, {_MODE.format(c='source', t='gaps')}) AS source,
  coalesce(toxic, {_MODE.format(c='toxic', t='gaps')}) AS toxic FROM gaps""")
def impute_mode(spark, sf):
    df = docs_labeled(spark, sf).select(
        "doc_id", F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("lang"),
        F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"), "toxic")
    return imputing.Imputer(modes=imputing.fit_modes(df, ["lang", "source", "toxic"])).transform(df)


@query("minimal_preprocess", with_ctes(DOCS, """gaps AS (SELECT doc_id, CASE WHEN doc_id % 6 <> 0 THEN lang END AS lang,
  source, CASE WHEN doc_id % 4 <> 0 THEN n_chars END AS n_chars, quality, toxic FROM docs)""") +
    f"""SELECT doc_id::DOUBLE AS doc_id, coalesce(lang, {_MODE.format(c='lang', t='gaps')}) AS lang, source,
  coalesce(n_chars::DOUBLE, (SELECT median(n_chars) FROM gaps)) AS n_chars,
  coalesce(quality, {_MODE.format(c='quality', t='gaps')}) AS quality,
  coalesce(toxic, {_MODE.format(c='toxic', t='gaps')}) AS toxic FROM gaps""")
def minimal_preprocess(spark, sf):
    df = docs_labeled(spark, sf).select(
        "doc_id", F.when(F.col("doc_id") % 6 != 0, F.col("lang")).alias("lang"), "source",
        F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("n_chars"), "quality", "toxic")
    return imputing.minimal_preprocess(df)[0]


# Rows with missing targets and features: tokens in several spellings.
def gappy_orders(spark, sf):
    return orders_feat(spark, sf).selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderkey % 17 = 0 THEN 'None' WHEN o_orderkey % 19 = 0 THEN NULL
                WHEN o_orderkey % 23 = 0 THEN ' none ' ELSE o_orderpriority END AS target""",
        "CASE WHEN o_orderkey % 11 = 0 THEN ' NONE ' WHEN o_orderkey % 29 = 0 THEN '' ELSE c_mktsegment END AS segment",
        "CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'NaN' ELSE o_orderstatus END AS status",
        "o_totalprice",
    )


GAPPY = ORDERS_FEAT + """, gappy AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 17 = 0 THEN 'None' WHEN o_orderkey % 19 = 0 THEN NULL
         WHEN o_orderkey % 23 = 0 THEN ' none ' ELSE o_orderpriority END AS target,
    CASE WHEN o_orderkey % 11 = 0 THEN ' NONE ' WHEN o_orderkey % 29 = 0 THEN '' ELSE c_mktsegment END AS segment,
    CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN 'NaN' ELSE o_orderstatus END AS status,
    o_totalprice FROM orders_feat)"""
_GOOD_TARGET = "target IS NOT NULL AND lower(target) NOT IN ('none', 'nan', '')"


def _good(col: str) -> str:
    return f"({col} IS NOT NULL AND lower({sql_strip(col)}) NOT IN ('none', 'nan', ''))"


@query("drop_missing_target", with_ctes(GAPPY) + f"SELECT * FROM gappy WHERE {_GOOD_TARGET}")
def drop_missing_target(spark, sf):
    return c.drop_missing_target(gappy_orders(spark, sf), "target")


@query("drop_invalid_features", with_ctes(GAPPY) + f"""SELECT * FROM gappy
  WHERE {_good('segment')} AND {_good('status')}""")
def drop_invalid_features(spark, sf):
    return c.drop_invalid_features(gappy_orders(spark, sf), "target")


@query("cleaning_audit", with_ctes(GAPPY, f"""marked AS (SELECT coalesce({_GOOD_TARGET}, false) AS t,
  {_good('segment')} AS a, {_good('status')} AS b FROM gappy)""") + """
SELECT 'rows_in' AS rule, NULL::VARCHAR AS "column", count(*) AS n FROM marked
UNION ALL SELECT 'missing_target', 'target', count(*) FILTER (NOT t) FROM marked
UNION ALL SELECT 'invalid_value', 'segment', count(*) FILTER (t AND NOT a) FROM marked
UNION ALL SELECT 'invalid_value', 'status', count(*) FILTER (t AND NOT b) FROM marked
UNION ALL SELECT 'invalid_features', NULL, count(*) FILTER (t AND NOT (a AND b)) FROM marked
UNION ALL SELECT 'rows_out', NULL, count(*) FILTER (t AND a AND b) FROM marked""")
def cleaning_audit(spark, sf):
    return c.cleaning_audit(gappy_orders(spark, sf), "target")


@query("class_shift", with_ctes(GAPPY) + f"""SELECT target AS class, count(*) AS n_before,
  count(*) FILTER (coalesce({_GOOD_TARGET}, false) AND {_good('segment')} AND {_good('status')}) AS n_after
  FROM gappy GROUP BY target""")
def class_shift(spark, sf):
    return c.class_shift(gappy_orders(spark, sf), "target")


@query("filter_label", with_ctes(GAPPY) + "SELECT * FROM gappy WHERE target IS DISTINCT FROM 'None'")
def filter_label(spark, sf):
    return c.drop_label(gappy_orders(spark, sf), "target", "None")


@query("select_features", with_ctes(ORDERS_FEAT) + "SELECT o_orderkey, r_name, c_mktsegment FROM orders_feat")
def select_features(spark, sf):
    return c.select_features(orders_feat(spark, sf), ["r_name", "not_there", "c_mktsegment"], ["o_orderkey"])


@query("alias_columns", """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE c_name END
  AS "Class_ X_Percentage" FROM customer""")
def alias_columns(spark, sf):
    df = table(spark, sf, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).alias("Class_ X_Percentage"),
        F.col("c_name").alias("Class_X_Percentage"))
    return c.resolve_aliases(df, {"Class_ X_Percentage": ["Class_X_Percentage"]})


@query("drop_column", "SELECT o_orderkey, o_orderstatus FROM orders")
def drop_column(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.col("o_custkey").alias("mixed_type_col"))
    return c.drop_if_present(df, c.JUNK_COLUMN, "never_there")


@query("exact_quantiles", """SELECT round(quantile_cont(l_extendedprice, 0.1), 6) AS p10,
  round(quantile_cont(l_extendedprice, 0.5), 6) AS p50, round(quantile_cont(l_extendedprice, 0.99), 6) AS p99,
  round(quantile_cont(l_quantity, 0.5), 6) AS q50 FROM lineitem""")
def exact_quantiles(spark, sf):
    from lodestat.operators.ranking import exact_quantiles as quantiles

    found = quantiles(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], [0.1, 0.5, 0.99])
    price = found["l_extendedprice"]
    row = [(price[0.1], price[0.5], price[0.99], found["l_quantity"][0.5])]
    df = spark.createDataFrame(row, "p10 double, p50 double, p99 double, q50 double")
    return df.select(*[r6(x).alias(x) for x in df.columns])


@query("quantiles_by_digits", """SELECT round(quantile_cont(l_extendedprice, 0.1), 6) AS p10, round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
  round(quantile_cont(l_extendedprice, 0.99), 6) AS p99, round(quantile_cont(-l_discount, 0.25), 6) AS d25 FROM lineitem""")
def quantiles_by_digits(spark, sf):
    """The digits of the keys are decided pass by pass until a thousand rows are left."""
    from lodestat.operators.ranking import exact_quantiles as quantiles

    df = table(spark, sf, "lineitem").select("l_extendedprice", (-F.col("l_discount")).alias("d"))
    found = quantiles(df, ["l_extendedprice", "d"], [0.1, 0.25, 0.5, 0.99], finish_rows=1000)
    price = found["l_extendedprice"]
    out = spark.createDataFrame([(price[0.1], price[0.5], price[0.99], found["d"][0.25])], "p10 double, p50 double, p99 double, d25 double")
    return out.select(*[r6(x).alias(x) for x in out.columns])


@query("modes_of_text", """WITH t AS (SELECT md5(text) AS text, source, n_chars FROM documents),
long AS (SELECT 'text' AS "column", text AS value, text AS shown, count(*) AS n FROM t WHERE text IS NOT NULL GROUP BY ALL
  UNION ALL SELECT 'source', source, source, count(*) FROM t WHERE source IS NOT NULL GROUP BY ALL)
SELECT "column", max(n) AS n FROM long GROUP BY 1""")
def modes_of_text(spark, sf):
    """How often the mode of whole texts, and of a short column, occurs."""
    df = table(spark, sf, "documents").select("text", "source")
    modes = imputing.fit_modes(df, ["text", "source"])
    parts = [df.filter(F.col(c) == F.lit(modes[c])).agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column"), "n") for c in modes]
    return parts[0].unionByName(parts[1])
