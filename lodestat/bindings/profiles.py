"""Profile tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from lodestat.bindings.registry import DOCS, ORDERS_FEAT, docs_labeled, orders_feat, query, r6, table, union_all, with_ctes
from lodestat.operators import profiling as p

LINE_NUMBERS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@query("guess_target", with_ctes(DOCS) + """SELECT CASE WHEN count(DISTINCT lang) BETWEEN 2 AND 10 THEN 'lang'
  WHEN count(DISTINCT source) BETWEEN 2 AND 10 THEN 'source' WHEN count(DISTINCT quality) BETWEEN 2 AND 10 THEN 'quality'
  END AS target FROM docs""")
def guess_target(spark, sf):
    return spark.createDataFrame([(p.guess_target(docs_labeled(spark, sf)),)], "target string")


_ORDER = {"o_orderkey": 8, "o_custkey": 8, "o_orderstatus": None, "o_totalprice": 8, "o_orderdate": 8, "o_orderpriority": None}
_BYTES = " + ".join(f"strlen({c})" if w is None else str(w) for c, w in _ORDER.items())
_CARD = " + ".join(f"count(DISTINCT {c})" for c in _ORDER)


_SUMMARY = f"""SELECT count(*) AS rows, 6 AS cols,
  (CASE WHEN count(DISTINCT o_orderkey) > 30 THEN 1 ELSE 0 END + CASE WHEN count(DISTINCT o_custkey) > 30 THEN 1 ELSE 0 END
   + CASE WHEN count(DISTINCT o_totalprice) > 30 THEN 1 ELSE 0 END)::INT AS n_numeric,
  6 - (CASE WHEN count(DISTINCT o_orderkey) > 30 THEN 1 ELSE 0 END + CASE WHEN count(DISTINCT o_custkey) > 30 THEN 1 ELSE 0 END
   + CASE WHEN count(DISTINCT o_totalprice) > 30 THEN 1 ELSE 0 END)::INT AS n_categorical,
  0.0::DOUBLE AS null_percent_mean,
  (SELECT coalesce(sum(n - 1), 0)::BIGINT FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey, o_custkey,
    o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)) AS duplicates,
  round_even(sum({_BYTES})::DOUBLE / 1e6, 2) AS size_mb, round_even(({_CARD})::DOUBLE / 6, 2) AS cardinality_mean FROM orders"""


@query("table_summary", _SUMMARY)
def table_summary(spark, sf):
    return p.table_summary(table(spark, sf, "orders"))


@query("profile_note", f"""SELECT 'El dataset contiene ' || rows::VARCHAR || ' filas y 6 columnas (' || n_numeric::VARCHAR
  || ' numéricas, ' || n_categorical::VARCHAR || ' categóricas). Target estimado: o_orderstatus. '
  || '0.0% nulos promedio; sin columnas con >10% nulos. Duplicados: ' || duplicates::VARCHAR || '. Memoria estimada: '
  || regexp_replace(printf('%.2f', size_mb), '0$', '') || ' MB. Cardinalidad media por columna: '
  || regexp_replace(printf('%.2f', cardinality_mean), '0$', '') || '.' AS note FROM ({_SUMMARY})""")
def profile_note(spark, sf):
    return p.profile_note(table(spark, sf, "orders"))


@query("duplicate_rows", """SELECT (count(*) - (SELECT count(*) FROM (
  SELECT DISTINCT l_suppkey, l_linenumber, l_quantity, l_returnflag, l_linestatus FROM lineitem)))::BIGINT AS duplicates
  FROM lineitem""")
def duplicate_rows(spark, sf):
    return p.duplicate_rows(table(spark, sf, "lineitem").select(
        "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus"))


@query("duplicate_texts", """SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents)))::BIGINT
  AS duplicates FROM documents""")
def duplicate_texts(spark, sf):
    return p.duplicate_rows(table(spark, sf, "documents").select("text", "lang"))


@query("null_profile", with_ctes(DOCS) + union_all([
    f"""SELECT {i} AS position, '{c}' AS "column", count(*) - count({c}) AS n_null,
    round((count(*) - count({c})) * 100.0::DOUBLE / count(*), 6) AS null_percent FROM docs"""
    for i, c in enumerate(DOC_COLUMNS)]))
def null_profile(spark, sf):
    return p.null_profile(docs_labeled(spark, sf)).withColumn("null_percent", r6("null_percent"))


@query("missing_note", with_ctes(DOCS) + """SELECT 'Columnas con mayor porcentaje de nulos: quality (' || printf('%.1f',
  (count(*) - count(quality)) * 100.0 / count(*)) || '%), toxic (' || printf('%.1f',
  (count(*) - count(toxic)) * 100.0 / count(*)) || '%), doc_id (0.0%).' AS note FROM docs""")
def missing_note(spark, sf):
    return p.missing_note(p.null_profile(docs_labeled(spark, sf)))


@query("cardinality", union_all([
    f"""SELECT {i} AS position, '{c}' AS "column", count(DISTINCT {c}) AS n_distinct FROM documents"""
    for i, c in enumerate(["doc_id", "text", "lang", "source", "n_chars"])]))
def cardinality(spark, sf):
    return p.cardinality(table(spark, sf, "documents"))


@query("target_distribution", with_ctes(DOCS) + """SELECT quality AS class, count(*) AS n,
  round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM docs), 2) AS percent FROM docs GROUP BY 1""")
def target_distribution(spark, sf):
    return p.target_distribution(docs_labeled(spark, sf), "quality")


@query("target_balance", with_ctes(DOCS) + """SELECT round(max(n)::DOUBLE / sum(n), 6) AS top_share,
  max(n)::DOUBLE / sum(n) < 0.6 AS balanced FROM (SELECT quality, count(*) AS n FROM docs GROUP BY 1)""")
def target_balance(spark, sf):
    return p.target_balance(docs_labeled(spark, sf), "quality").withColumn("top_share", r6("top_share"))


_SMALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_linenumber", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
_COUNTS = "counted AS (" + union_all([
    f"""SELECT '{c}' AS "column", {c}::VARCHAR AS value, count(*) AS n FROM lineitem GROUP BY {c}
    HAVING (SELECT count(DISTINCT {c}) FROM lineitem) BETWEEN 2 AND 20""" for c in _SMALL]) + ")"


@query("category_counts", with_ctes(_COUNTS) + "SELECT * FROM counted")
def category_counts(spark, sf):
    return p.category_counts(table(spark, sf, "lineitem"))


_NOTE_COLUMNS = ["lang", "source", "quality", "toxic"]
_NOTES = DOCS + ", counted AS (" + union_all([
    f"""SELECT '{c}' AS "column", {c}::VARCHAR AS value, count(*) AS n FROM docs GROUP BY {c}
    HAVING (SELECT count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) FROM docs) BETWEEN 2 AND 20"""
    for c in _NOTE_COLUMNS]) + """), ordered AS (
  SELECT "column", coalesce(value, 'nan') AS v, n, sum(n) OVER (PARTITION BY "column") AS total,
    row_number() OVER (PARTITION BY "column" ORDER BY n DESC, coalesce(value, 'nan')) AS rn FROM counted)"""


@query("category_note", with_ctes(_NOTES) + """SELECT "column", count(*) AS n_values,
  string_agg(v, ', ' ORDER BY rn) FILTER (rn <= 15) || CASE WHEN count(*) > 15 THEN ', ...' ELSE '' END AS first_values,
  max(v) FILTER (rn = 1) AS top_value,
  round_even(max(n * 100.0::DOUBLE / total) FILTER (rn = 1), 1) AS top_percent FROM ordered GROUP BY 1""")
def category_note(spark, sf):
    df = docs_labeled(spark, sf)
    return p.category_notes(p.category_counts(df, _NOTE_COLUMNS))


def _hist(c: str) -> str:
    return f"""SELECT '{c}' AS "column", least(floor(({c} - lo) / ((hi - lo) / 30)), 29)::INT AS bin, count(*) AS n
  FROM lineitem, (SELECT min({c}) AS lo, max({c}) AS hi FROM lineitem) GROUP BY 2"""


@query("histogram", union_all([_hist(c) for c in MEASURES]))
def histogram(spark, sf):
    return p.histogram(table(spark, sf, "lineitem"), MEASURES).select("column", "bin", "n")


def _box(c: str) -> str:
    return f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q2, 6) AS median, round(q3, 6) AS q3,
  (SELECT round(min({c}), 6) FROM lineitem WHERE {c} >= q1 - 1.5 * (q3 - q1)) AS whisker_low,
  (SELECT round(max({c}), 6) FROM lineitem WHERE {c} <= q3 + 1.5 * (q3 - q1)) AS whisker_high,
  (SELECT count(*) FROM lineitem WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers
  FROM (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3 FROM lineitem)"""


@query("box_stats", union_all([_box(c) for c in MEASURES]))
def box_stats(spark, sf):
    out = p.box_stats(table(spark, sf, "lineitem"), MEASURES)
    numbers = ["q1", "median", "q3", "whisker_low", "whisker_high"]
    return out.select("column", *[r6(c).alias(c) for c in numbers], "n_outliers")


def _note(c: str, source: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS sd,
  round(skewness({c}), 6) AS skew, CASE WHEN abs(skewness({c})) < 0.3 THEN 'symmetric' WHEN skewness({c}) > 0 THEN 'right'
  ELSE 'left' END AS shape FROM {source}"""


@query("numeric_note", union_all([_note(c, "lineitem") for c in MEASURES]))
def numeric_note(spark, sf):
    out = p.numeric_notes(table(spark, sf, "lineitem"), MEASURES)
    return out.select("column", "n", *[r6(c).alias(c) for c in ("mean", "sd", "skew")], "shape")


_PAIRS = union_all([
    f"SELECT {i} AS i, {j} AS j, '{LINE_NUMBERS[i]}' AS column_a, '{LINE_NUMBERS[j]}' AS column_b, "
    f"round(corr({LINE_NUMBERS[i]}, {LINE_NUMBERS[j]}), 6) AS r FROM lineitem"
    for i, j in combinations(range(len(LINE_NUMBERS)), 2)])


@query("correlation", _PAIRS)
def correlation(spark, sf):
    return p.correlation(table(spark, sf, "lineitem")).withColumn("r", r6("r"))


@query("top_correlation", f"""SELECT column_a, column_b, abs(r) AS abs_r FROM ({_PAIRS}) ORDER BY abs(r) DESC, i, j LIMIT 1""")
def top_correlation(spark, sf):
    return p.top_correlation(p.correlation(table(spark, sf, "lineitem"))).withColumn("abs_r", r6("abs_r"))


@query("correlation_nulls", with_ctes(DOCS) + """SELECT 'n_chars' AS column_a, 'quality' AS column_b,
  round(corr(n_chars, quality), 6) AS r FROM docs""")
def correlation_nulls(spark, sf):
    return p.correlation(docs_labeled(spark, sf), ["n_chars", "quality"]).select("column_a", "column_b", r6("r").alias("r"))


@query("null_map", with_ctes(DOCS) + """, keyed AS (
  SELECT *, (('0x' || substr(md5(doc_id::VARCHAR), 1, 8))::BIGINT % 16)::INT AS bucket FROM docs)
""" + union_all([f"""SELECT bucket, '{c}' AS "column", count(*) - count({c}) AS n_null, count(*) AS n FROM keyed GROUP BY 1"""
                 for c in DOC_COLUMNS if c != "doc_id"]))
def null_map(spark, sf):
    return p.null_map(docs_labeled(spark, sf), ["doc_id"], 16)


@query("null_cells", with_ctes(DOCS) + "SELECT doc_id, " + ", ".join(
    f"({c} IS NULL)::INT AS {c}" for c in DOC_COLUMNS if c != "doc_id") + " FROM docs")
def null_cells(spark, sf):
    return p.null_cells(docs_labeled(spark, sf), ["doc_id"])


@query("meta_compare", """SELECT 'rows_modified' AS metric, count(*) AS value FROM documents UNION ALL
  SELECT 'cols_modified', CAST(5 AS BIGINT) UNION ALL SELECT 'rows_original', count(*) FROM pages UNION ALL
  SELECT 'cols_original', CAST(3 AS BIGINT)""")
def meta_compare(spark, sf):
    return p.size_comparison(table(spark, sf, "documents"), table(spark, sf, "pages"))


_VARS = union_all([f"""SELECT {i} AS position, '{c}' AS "column", var_samp({c}) AS variance FROM lineitem"""
                   for i, c in enumerate(LINE_NUMBERS)])


@query("top_variance", f"""SELECT position, "column", printf('%.8e', variance) AS variance FROM (
  SELECT * FROM ({_VARS}) ORDER BY variance DESC LIMIT 5)""")
def top_variance(spark, sf):
    out = p.top_variance(table(spark, sf, "lineitem"), LINE_NUMBERS, 5)
    return out.withColumn("variance", F.format_string("%.8e", "variance"))


@query("corr_columns", f"""SELECT "column" FROM ({_VARS}) ORDER BY variance DESC LIMIT 4""")
def corr_columns(spark, sf):
    names = p.correlation_columns(table(spark, sf, "lineitem").withColumn("PC1", F.col("l_tax")), 4)
    return spark.createDataFrame([(c,) for c in names], "column string")


@query("component_scatter", """SELECT l_quantity AS x, l_tax AS y, 'PC1' AS x_name, 'PC2' AS y_name FROM lineitem
UNION ALL SELECT l_quantity, l_discount, 'PC1', 'PC3' FROM lineitem""")
def component_scatter(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("PC1"), F.col("l_tax").alias("PC2"), F.col("l_discount").alias("PC3"))
    first, second = p.component_scatter(df)
    return first.unionByName(second)


@query("profile_clean", with_ctes(ORDERS_FEAT) + """SELECT c_mktsegment AS class, count(*) AS n,
  round_even(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders_feat), 2) AS percent
  FROM (SELECT lower(c_mktsegment) AS c_mktsegment FROM orders_feat) GROUP BY 1""")
def profile_clean(spark, sf):
    from lodestat.plans.profile import prepare_variant

    df = orders_feat(spark, sf).select("c_mktsegment", "o_orderstatus", "o_totalprice")
    return p.target_distribution(prepare_variant(df, "clean"), "c_mktsegment")


@query("correlation_wide", """WITH e AS (SELECT vec_id, embedding, unnest(range(0, 63)) AS i FROM embeddings),
pairs AS (SELECT i::INT AS i, unnest(range(i + 1, 64))::INT AS j, vec_id, embedding FROM e)
SELECT i, j, round(corr(CASE WHEN (vec_id + i) % 7 <> 0 THEN embedding[i + 1]::DOUBLE END,
  CASE WHEN (vec_id + j) % 7 <> 0 THEN embedding[j + 1]::DOUBLE END), 6) AS r FROM pairs GROUP BY i, j""")
def correlation_wide(spark, sf):
    """All pairs of 64 columns with gaps, by blocks of columns."""
    df = table(spark, sf, "embeddings")
    wide = df.select(*[F.when((F.col("vec_id") + i) % 7 != 0, F.get("embedding", F.lit(i)).cast("double")).alias(f"e{i}") for i in range(64)])
    return p.correlation(wide).select("i", "j", r6("r").alias("r"))
