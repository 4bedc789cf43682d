"""Registry of bound queries and shared table views."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def r6(col: Column | str) -> Column:
    return F.round(F.col(col) if isinstance(col, str) else col, 6)


# ---------------------------------------------------------------- views
FEATURES = ["o_orderstatus", "c_mktsegment", "n_name", "r_name"]
NUMERIC = ["o_totalprice", "c_acctbal"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CUT = "1998-01-01"


def orders_feat(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer, nation and region: the training table."""
    return (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("o_orderkey", "o_orderpriority", *FEATURES, *NUMERIC, "o_orderdate")
    )


ORDERS_FEAT = """orders_feat AS (
  SELECT o_orderkey, o_orderpriority, o_orderstatus, c_mktsegment, n_name, r_name, o_totalprice, c_acctbal, o_orderdate
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""


def baseline_current(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    df = orders_feat(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    return df.filter(F.col("o_orderdate") < cut), df.filter(F.col("o_orderdate") >= cut)


def dirty_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as dirty text: symbols, blanks, null tokens, a junk column."""
    return table(spark, sf, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderkey % 7 = 0 THEN 'nan' WHEN o_orderkey % 11 = 0 THEN ''
                WHEN o_orderkey % 13 = 0 THEN NULL
                ELSE concat('$', format_number(cast(o_totalprice AS decimal(18,2)), 2)) END AS price_text""",
        "concat('  ', cast(o_orderkey % 101 AS string), '%', chr(9)) AS percent_text",
        "concat('+', cast(o_custkey AS string)) AS code_text",
        "CASE WHEN o_orderkey % 1000 = 0 THEN '12d' ELSE cast(o_orderkey % 50 AS string) END AS note_text",
        """CASE WHEN o_orderkey % 9 = 0 THEN NULL
                WHEN o_orderkey % 5 = 0 THEN concat('  ', lower(o_orderpriority), chr(9))
                WHEN o_orderkey % 5 = 1 THEN replace(o_orderpriority, ' ', '   ')
                WHEN o_orderkey % 5 = 2 THEN 'None' ELSE o_orderpriority END AS priority_text""",
        "cast(o_orderkey % 3 AS string) AS mixed_type_col",
    )


DIRTY = """dirty AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 7 = 0 THEN 'nan' WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 13 = 0 THEN NULL
         ELSE '$' || format('{:,.2f}', o_totalprice) END AS price_text,
    '  ' || (o_orderkey % 101)::VARCHAR || '%' || chr(9) AS percent_text,
    '+' || o_custkey::VARCHAR AS code_text,
    CASE WHEN o_orderkey % 1000 = 0 THEN '12d' ELSE (o_orderkey % 50)::VARCHAR END AS note_text,
    CASE WHEN o_orderkey % 9 = 0 THEN NULL
         WHEN o_orderkey % 5 = 0 THEN '  ' || lower(o_orderpriority) || chr(9)
         WHEN o_orderkey % 5 = 1 THEN replace(o_orderpriority, ' ', '   ')
         WHEN o_orderkey % 5 = 2 THEN 'None' ELSE o_orderpriority END AS priority_text,
    (o_orderkey % 3)::VARCHAR AS mixed_type_col
  FROM orders)"""

TEXTS = ["price_text", "percent_text", "code_text", "note_text", "priority_text"]


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


def sql_symbols(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '[,%$]', '', 'g')")


def sql_clean(x: str) -> str:
    s = sql_symbols(x)
    return f"CASE WHEN {s} IN ('', 'nan', 'None') THEN NULL ELSE {s} END"


def sql_normal(x: str) -> str:
    return f"lower(regexp_replace({sql_strip(x)}, '\\s+', ' ', 'g'))"


SQL_NUMBER = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"


def docs_labeled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with their labels where they have any."""
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left").select(
        "doc_id", "lang", "source", "n_chars", "quality", "toxic"
    )


DOCS = """docs AS (SELECT doc_id, lang, source, n_chars, quality, toxic
  FROM documents LEFT JOIN labels USING (doc_id))"""


def _hash(seed: str) -> str:
    return f"cast(conv(substring(md5(concat(cast(o_orderkey AS string), '|{seed}')), 1, 8), 16, 10) AS bigint)"


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """A rule-based predictor on the training table: right for six hashes in ten."""
    names = ", ".join(f"'{p}'" for p in PRIORITIES)
    return orders_feat(spark, sf).withColumn("h", F.expr(_hash("p"))).selectExpr(
        "o_orderkey", "o_orderdate", "o_orderpriority AS label",
        f"CASE WHEN h % 10 < 6 THEN o_orderpriority ELSE element_at(array({names}), cast((h div 10) % 5 AS int) + 1) END"
        " AS prediction",
        "cast(substring(o_orderpriority, 1, 1) AS int) - 1 AS code",
        "cast(substring(o_orderpriority, 1, 1) AS int) - 1 + ((h % 200) - 100) / 50.0D AS score",
    )


PREDICTIONS = ORDERS_FEAT + """, hashed AS (
  SELECT *, ('0x' || substr(md5(o_orderkey::VARCHAR || '|p'), 1, 8))::BIGINT AS h FROM orders_feat),
predictions AS (
  SELECT o_orderkey, o_orderdate, o_orderpriority AS label,
    CASE WHEN h % 10 < 6 THEN o_orderpriority
         ELSE ['1-URGENT','2-HIGH','3-MEDIUM','4-NOT SPECIFIED','5-LOW'][((h // 10) % 5) + 1] END AS prediction,
    substr(o_orderpriority, 1, 1)::INT - 1 AS code,
    substr(o_orderpriority, 1, 1)::INT - 1 + ((h % 200) - 100) / 50.0::DOUBLE AS score
  FROM hashed)"""


REPORT_SQL = PREDICTIONS + """, cells AS (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY ALL),
classes AS (
  SELECT class, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS hits FROM (
    SELECT label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM cells
    UNION ALL SELECT prediction, 0, n, 0 FROM cells) GROUP BY class),
report AS (
  SELECT class, coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS precision,
    coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
    coalesce(2 * hits::DOUBLE / nullif(predicted + support, 0), 0) AS f1, support, hits FROM classes)"""


def event_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Events as experiment runs: the event type is the experiment, the user the run."""
    v = F.col("value").cast("decimal(18,2)")
    n = F.count(F.lit(1))
    return table(spark, sf, "events").groupBy(
        F.col("event_type").alias("experiment_id"), F.col("user_id").cast("string").alias("run_id"), "user_id"
    ).agg(
        (F.sum(v).cast("double") / n / 1000).alias("f1_weighted"),
        (F.count_if(F.col("value") < 20).cast("double") / n).alias("acc_test"),
        (F.max(v).cast("double") / 1000).alias("f1_macro"),
        ((F.max(v) - F.min(v)).cast("double") / 10000).alias("cv_f1_weighted_std"),
        F.max("event_id").alias("end_time"),
    ).select(
        "experiment_id", "run_id",
        F.when(F.col("user_id") % 17 != 0, F.concat(F.lit("user "), (F.col("user_id") % 40).cast("string"))).alias(
            "run_name"),
        "f1_weighted", "acc_test", "f1_macro", "cv_f1_weighted_std", "end_time",
        (F.col("user_id") % 3 == 0).alias("has_model"),
    )


EVENT_RUNS = """runs AS (
  SELECT event_type AS experiment_id, user_id::VARCHAR AS run_id,
    CASE WHEN user_id % 17 <> 0 THEN 'user ' || (user_id % 40)::VARCHAR END AS run_name,
    sum(value::DECIMAL(18,2))::DOUBLE / count(*) / 1000 AS f1_weighted,
    count(*) FILTER (value < 20)::DOUBLE / count(*) AS acc_test,
    max(value::DECIMAL(18,2))::DOUBLE / 1000 AS f1_macro,
    (max(value::DECIMAL(18,2)) - min(value::DECIMAL(18,2)))::DOUBLE / 10000 AS cv_f1_weighted_std,
    max(event_id) AS end_time, user_id % 3 = 0 AS has_model
  FROM events GROUP BY event_type, user_id)"""


def event_experiments(spark: SparkSession, sf: str) -> DataFrame:
    """One experiment per event type, and one without runs per region."""
    used = table(spark, sf, "events").select(F.col("event_type").alias("experiment_id")).distinct()
    idle = table(spark, sf, "region").select(F.col("r_name").alias("experiment_id"))
    return used.unionByName(idle).withColumn(
        "experiment", F.concat(F.lit("exp "), F.col("experiment_id"), F.lit("/v1")))


EVENT_EXPERIMENTS = """experiments AS (
  SELECT experiment_id, 'exp ' || experiment_id || '/v1' AS experiment FROM
  (SELECT DISTINCT event_type AS experiment_id FROM events UNION ALL SELECT r_name FROM region))"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def union_all(selects: Sequence[str]) -> str:
    return "\nUNION ALL\n".join(selects)
