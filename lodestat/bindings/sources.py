"""Sources, sinks and dataset records."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import PREDICTIONS, predictions, query, r6, table, with_ctes
from lodestat.operators.evaluation import confusion_counts, summary_metrics
from lodestat.operators.profiling import schema_table
from lodestat.session import scratch_path
from lodestat.sources.fingerprint import column_record, table_fingerprint
from lodestat.sources.runstore import append_records, log_run, metric_records, read_records
from lodestat.sources.snapshots import SnapshotTable
from lodestat.sources.zones import Zones, read_csv, read_if_exists, write_csv

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("scan_csv", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def scan_csv(spark, sf):
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    path = write_csv(table(spark, sf, "orders").select(*names), scratch_path(spark, "orders-csv"))
    text = read_csv(spark, path, names)
    return text.select(
        F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus",
        F.col("o_totalprice").cast("double"), "o_orderpriority",
    )


@query("scan_csv_text", "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents")
def scan_csv_text(spark, sf):
    """Texts with line breaks and quotes, read by column names in another order than the file's."""
    path = write_csv(table(spark, sf, "documents").select("doc_id", "text", "lang"), scratch_path(spark, "texts-csv"))
    back = read_csv(spark, path, ["lang", "text", "doc_id"], null_tokens=())
    return back.select(F.col("doc_id").cast("bigint"), "lang", F.md5("text").alias("text_md5"))


@query("fingerprint_borders", """WITH t AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus || '|' ELSE o_orderstatus END AS a,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE '|' || o_orderpriority END AS b FROM orders),
u AS (SELECT coalesce(replace(replace(a, '\\', '\\\\'), '|', '\\|'), '\\N') AS a, coalesce(replace(replace(b, '\\', '\\\\'), '|', '\\|'), '\\N') AS b FROM t)
SELECT count(*) AS n_rows, count(*) * 2 AS n_elements,
  CAST(sum(('0x' || substr(md5(a || '|' || b), 1, 12))::BIGINT) AS VARCHAR) AS digest FROM u""")
def fingerprint_borders(spark, sf):
    """Fields that hold the separator, and NULLs, do not run into each other."""
    orders = table(spark, sf, "orders")
    a = F.when(F.col("o_orderkey") % 3 == 0, F.concat("o_orderstatus", F.lit("|"))).otherwise(F.col("o_orderstatus"))
    b = F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("|"), "o_orderpriority"))
    return table_fingerprint(orders.select(a.alias("a"), b.alias("b")))


@query("scan_optional", """SELECT 'part' AS name, true AS found, count(*) AS n FROM part
UNION ALL SELECT 'missing', false, CAST(0 AS BIGINT)""")
def scan_optional(spark, sf):
    parts = []
    for name in ("part", "missing"):
        found = read_if_exists(spark, f"{sf}/{name}.parquet")
        source = found if found is not None else spark.range(0)
        parts.append(source.agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("name"), F.lit(found is not None).alias("found"), "n"))
    return parts[0].unionByName(parts[1])


@query("roundtrip_write", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def roundtrip_write(spark, sf):
    zones = Zones(scratch_path(spark, "zones"))
    zones.save_interim(table(spark, sf, "customer"), "customer")
    zones.save_processed(zones.load_interim(spark, "customer"), "customer")
    return zones.load_processed(spark, "customer")


@query("report_rows", with_ctes(PREDICTIONS) + """, cells AS (
  SELECT label, prediction, count(*) AS n FROM predictions GROUP BY ALL),
classes AS (
  SELECT class, sum(s)::DOUBLE AS support, sum(p)::DOUBLE AS predicted, sum(h)::DOUBLE AS hits FROM (
    SELECT label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM cells
    UNION ALL SELECT prediction, 0, n, 0 FROM cells) GROUP BY class),
m AS (
  SELECT sum(hits) / sum(support) AS accuracy,
    sum(support * 2 * hits / (predicted + support)) / sum(support) AS f1_weighted FROM classes)
SELECT 'holdout' AS run_id, 'accuracy' AS name, round(accuracy, 6) AS value FROM m
UNION ALL SELECT 'holdout', 'f1_weighted', round(f1_weighted, 6) FROM m""")
def report_rows(spark, sf):
    metrics = summary_metrics(confusion_counts(predictions(spark, sf))).select("accuracy", "f1_weighted")
    path = scratch_path(spark, "records")
    append_records(metric_records(metrics, "orders", "holdout"), path)
    return read_records(spark, path).select("run_id", "name", r6(F.col("value").cast("double")).alias("value"))


@query("table_fingerprint", """SELECT count(*) AS n_rows, count(*) * 6 AS n_elements,
  CAST(sum(('0x' || substr(md5(concat_ws('|',
    coalesce(o_orderkey::VARCHAR, '\\N'), coalesce(o_custkey::VARCHAR, '\\N'), coalesce(o_orderstatus, '\\N'),
    coalesce(o_totalprice::VARCHAR, '\\N'), coalesce(o_orderdate::VARCHAR, '\\N'), coalesce(o_orderpriority, '\\N')
  )), 1, 12))::BIGINT) AS VARCHAR) AS digest FROM orders""")
def fingerprint(spark, sf):
    return table_fingerprint(table(spark, sf, "orders").select(*ORDER_COLUMNS))


@query("schema_table", """SELECT 0 AS position, 'conv_id' AS "column", 'bigint' AS dtype, count(*) AS n_rows FROM conversations
UNION ALL SELECT 1, 'turn', 'bigint', count(*) FROM conversations
UNION ALL SELECT 2, 'role', 'string', count(*) FROM conversations
UNION ALL SELECT 3, 'text', 'string', count(*) FROM conversations""")
def schema(spark, sf):
    df = table(spark, sf, "conversations")
    return schema_table(df).withColumn("n_rows", df.agg(F.count(F.lit(1))).scalar())


@query("column_record", """SELECT * FROM (
SELECT 'doc_id' AS "column", 'bigint' AS dtype, count(*) = count(doc_id) AS required FROM documents
UNION ALL SELECT 'text', 'string', count(*) = count(text) FROM documents
UNION ALL SELECT 'lang', 'string', count(*) = count(lang) FROM documents
UNION ALL SELECT 'source', 'string', count(*) = count(source) FROM documents
UNION ALL SELECT 'n_chars', 'bigint', count(*) = count(n_chars) FROM documents)""")
def columns(spark, sf):
    return column_record(table(spark, sf, "documents"))


@query("head_rows", "SELECT part.* FROM part ORDER BY p_partkey LIMIT 5")
def head_rows(spark, sf):
    from lodestat.operators.profiling import head

    return head(table(spark, sf, "part"), ["p_partkey"])


@query("snapshot_rewrite", """SELECT 1 AS version, c_custkey, c_mktsegment FROM customer
UNION ALL SELECT 3, c_custkey, lower(c_mktsegment) FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT 3, -s_suppkey, 'supplier' FROM supplier""")
def snapshot_rewrite(spark, sf):
    """A table rewritten from itself, then extended, beside its first version."""
    zones = Zones(scratch_path(spark, "zones"))
    zones.save_interim(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), "customer")
    now = zones.load_interim(spark, "customer")
    zones.save_interim(now.filter(F.col("c_custkey") % 2 == 0).withColumn("c_mktsegment", F.lower("c_mktsegment")), "customer")
    own = SnapshotTable(zones.path("interim", "customer"))
    own.append(table(spark, sf, "supplier").select((-F.col("s_suppkey")).alias("c_custkey"), F.lit("supplier").alias("c_mktsegment")))
    versions = [own.load(spark, v).select(F.lit(v).alias("version"), "c_custkey", "c_mktsegment") for v in (1, 3)]
    return versions[0].unionByName(versions[1])


@query("logged_run", """SELECT 'metric' AS kind, 'n_rows' AS name, count(*)::VARCHAR AS value FROM orders
UNION ALL SELECT 'metric', 'n_keys', count(DISTINCT o_custkey)::VARCHAR FROM orders
UNION ALL SELECT 'param', 'depth', '3' FROM region WHERE r_regionkey = 0 UNION ALL SELECT 'tag', 'owner', r_name FROM region WHERE r_regionkey = 0""")
def logged_run(spark, sf):
    """A run's metrics, parameters and tags, appended together and read back."""
    path = scratch_path(spark, "records")
    metrics = table(spark, sf, "orders").agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("o_custkey").alias("n_keys"))
    owner = table(spark, sf, "region").filter("r_regionkey = 0").first()["r_name"]
    log_run(spark, path, "orders", "run", metrics, {"depth": 3, "unset": None}, {"owner": owner})
    return read_records(spark, path).select("kind", "name", "value")
