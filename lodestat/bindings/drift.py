"""Population stability, degradation and synthetic drift."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import (
    CUT, FEATURES, ORDERS_FEAT, PREDICTIONS, baseline_current, orders_feat, predictions, query, r6, table, union_all,
    with_ctes,
)
from lodestat.operators import drift as d
from lodestat.operators.evaluation import confusion_counts, summary_metrics
from lodestat.session import materialize

CATEGORIES = ["o_orderpriority", *FEATURES]

# Shares per side over non-null values; a category one side lacks gets 1e-6 there.
_CELLS = union_all([
    f"""SELECT '{c}' AS "column", {c}::VARCHAR AS value, o_orderdate >= '{CUT}'::TIMESTAMP AS side FROM orders_feat"""
    for c in CATEGORIES
])
PSI = ORDERS_FEAT + f""", cells AS ({_CELLS}),
counted AS (SELECT "column", value, count(*) FILTER (NOT side) AS n_e, count(*) FILTER (side) AS n_a
  FROM cells WHERE value IS NOT NULL GROUP BY 1, 2),
shares AS (SELECT "column", value, n_e::DOUBLE / sum(n_e) OVER (PARTITION BY "column") AS e,
  n_a::DOUBLE / sum(n_a) OVER (PARTITION BY "column") AS a FROM counted),
filled AS (SELECT "column", CASE WHEN e = 0 THEN 1e-6 ELSE e END AS e, CASE WHEN a = 0 THEN 1e-6 ELSE a END AS a FROM shares),
psi AS (SELECT "column", round(sum((a - e) * ln(a / e)), 6) AS psi FROM filled GROUP BY 1)"""


def psi_table(spark, sf, columns):
    baseline, current = baseline_current(spark, sf)
    return d.psi(baseline, current, columns).withColumn("psi", r6("psi"))


@query("psi", with_ctes(PSI) + """SELECT * FROM psi WHERE "column" = 'c_mktsegment'""")
def psi(spark, sf):
    return psi_table(spark, sf, ["c_mktsegment"])


@query("psi_all", with_ctes(PSI) + "SELECT * FROM psi")
def psi_all(spark, sf):
    return psi_table(spark, sf, CATEGORIES)


@query("psi_status", with_ctes(PSI) + """SELECT "column", psi, CASE WHEN abs(psi) < 0.1 THEN 'ok'
  WHEN abs(psi) < 0.25 THEN 'moderate' ELSE 'high' END AS status FROM psi""")
def psi_status(spark, sf):
    return d.status_table(psi_table(spark, sf, CATEGORIES))


@query("psi_high_cardinality", """WITH cells AS (SELECT l_shipdate >= '1999-01-01'::TIMESTAMP AS side,
  CASE WHEN l_suppkey % 10 = 3 AND NOT side THEN l_suppkey - 1 WHEN l_suppkey % 10 = 4 AND side THEN l_suppkey + 1
    ELSE l_suppkey END AS l_suppkey FROM lineitem),
counted AS (SELECT l_suppkey, count(*) FILTER (NOT side) AS n_e, count(*) FILTER (side) AS n_a FROM cells GROUP BY 1),
shares AS (SELECT n_e::DOUBLE / sum(n_e) OVER () AS e, n_a::DOUBLE / sum(n_a) OVER () AS a FROM counted),
filled AS (SELECT CASE WHEN e = 0 THEN 1e-6 ELSE e END AS e, CASE WHEN a = 0 THEN 1e-6 ELSE a END AS a FROM shares)
SELECT 'supplier' AS "column", round(sum((a - e) * ln(a / e)), 6) AS psi FROM filled""")
def psi_high_cardinality(spark, sf):
    """Suppliers as categories, some of them under another number on one side."""
    df = table(spark, sf, "lineitem").select("l_suppkey", "l_shipdate")
    cut, key = F.lit("1999-01-01").cast("timestamp_ntz"), F.col("l_suppkey")
    side = lambda ending, moved: F.when(key % 10 == ending, key + moved).otherwise(key).cast("string").alias("supplier")
    before = df.filter(F.col("l_shipdate") < cut).select(side(3, -1))
    after = df.filter(F.col("l_shipdate") >= cut).select(side(4, 1))
    return d.psi(before, after, ["supplier"]).withColumn("psi", r6("psi"))


_SIDES = PREDICTIONS + f""", sided AS (SELECT *, o_orderdate >= '{CUT}'::TIMESTAMP AS side FROM predictions),
cells AS (SELECT side, label, prediction, count(*) AS n FROM sided GROUP BY ALL),
classes AS (SELECT side, class, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS hits FROM (
    SELECT side, label AS class, n AS s, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS h FROM cells
    UNION ALL SELECT side, prediction, 0, n, 0 FROM cells) GROUP BY ALL),
sums AS (SELECT side, sum(hits)::DOUBLE / sum(support) AS acc,
  sum(support * coalesce(2 * hits::DOUBLE / nullif(predicted + support, 0), 0)) / sum(support) AS f1 FROM classes GROUP BY side),
pair AS (SELECT max(acc) FILTER (NOT side) AS ab, max(acc) FILTER (side) AS ac, max(f1) FILTER (NOT side) AS fb,
  max(f1) FILTER (side) AS fc FROM sums)"""


def metric_pair(spark, sf):
    """Accuracy and F1 of both periods in one row, from one grouped count."""
    df = predictions(spark, sf).withColumn("side", F.col("o_orderdate") >= F.lit(CUT).cast("timestamp_ntz"))
    sums = summary_metrics(confusion_counts(df, ids=["side"]), ["side"])
    pick = lambda m, s: F.max(F.when(F.col("side") == s, F.col(m)))
    return sums.agg(
        pick("accuracy", False).alias("acc_baseline"), pick("accuracy", True).alias("acc_current"),
        pick("f1_weighted", False).alias("f1_baseline"), pick("f1_weighted", True).alias("f1_current"))


@query("metric_drop", with_ctes(_SIDES) + """SELECT round((ab - ac) / ab * 100, 6) AS acc_drop,
  round((fb - fc) / fb * 100, 6) AS f1_drop FROM pair""")
def metric_drop(spark, sf):
    drop = lambda m: d.metric_drop(F.col(f"{m}_baseline"), F.col(f"{m}_current"))
    return metric_pair(spark, sf).select(r6(drop("acc")).alias("acc_drop"), r6(drop("f1")).alias("f1_drop"))


@query("drift_alert", """WITH rates AS (SELECT event_type, round((a - b) / a * 100, 6) AS drop FROM (
  SELECT event_type, avg(CASE WHEN value < 20 THEN 1.0 ELSE 0.0 END) FILTER (ts < '2024-01-16'::TIMESTAMP) AS a,
    avg(CASE WHEN value < 20 - user_id % 5 THEN 1.0 ELSE 0.0 END) FILTER (ts >= '2024-01-16'::TIMESTAMP) AS b
  FROM events GROUP BY event_type))
SELECT event_type, drop, CASE WHEN drop > 10 THEN 'red' WHEN drop > 5 THEN 'amber' ELSE 'ok' END AS alert FROM rates""")
def drift_alert(spark, sf):
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    hit = lambda limit: F.when(F.col("value") < limit, 1.0).otherwise(0.0)
    rates = table(spark, sf, "events").groupBy("event_type").agg(
        F.avg(F.when(F.col("ts") < cut, hit(F.lit(20)))).alias("a"),
        F.avg(F.when(F.col("ts") >= cut, hit(20 - F.col("user_id") % 5))).alias("b"))
    drop = d.metric_drop(F.col("a"), F.col("b"))
    return rates.select("event_type", r6(drop).alias("drop")).withColumn("alert", d.alert_level(F.col("drop")))


@query("feature_shares", with_ctes(PSI) + """SELECT "column", value, round(e, 6) AS share_baseline,
  round(a, 6) AS share_current FROM shares""")
def feature_shares(spark, sf):
    out = d.feature_shares(*baseline_current(spark, sf), CATEGORIES)
    return out.select("column", "value", r6("share_baseline").alias("share_baseline"),
                      r6("share_current").alias("share_current"))


@query("drift_record", with_ctes(_SIDES, PSI.replace("orders_feat AS (", "feat2 AS (", 1).replace(
    "FROM orders_feat", "FROM feat2").replace("cells", "cells2")) + """SELECT round(ab, 6) AS acc_baseline,
  round(ac, 6) AS acc_current, round(fb, 6) AS f1_baseline, round(fc, 6) AS f1_current,
  round((ab - ac) / ab * 100, 6) AS acc_drop, round((fb - fc) / fb * 100, 6) AS f1_drop,
  CASE WHEN (ab - ac) / ab * 100 > 10 THEN 'red' WHEN (ab - ac) / ab * 100 > 5 THEN 'amber' ELSE 'ok' END AS alert,
  (SELECT count(*) FROM psi) AS n_columns, (SELECT psi FROM psi WHERE "column" = 'n_name') AS psi_n_name,
  false AS filtered FROM pair""")
def drift_record(spark, sf):
    baseline, current = baseline_current(spark, sf)
    record = d.drift_record(metric_pair(spark, sf), d.psi(baseline, current, CATEGORIES), filtered=False)
    numbers = ["acc_baseline", "acc_current", "f1_baseline", "f1_current", "acc_drop", "f1_drop"]
    return record.select(*[r6(c).alias(c) for c in numbers], "alert", F.size("psi").cast("bigint").alias("n_columns"),
                         r6(F.element_at("psi", "n_name")).alias("psi_n_name"), "filtered")


_MODE = "(SELECT {c} FROM orders_feat WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
_PICK = "('0x' || substr(md5(o_orderkey::VARCHAR || '|42|{c}'), 17, 12))::BIGINT % 2"


@query("drift_inject", with_ctes(ORDERS_FEAT, """placed AS (SELECT *,
    row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR || '|42')) AS rn FROM orders_feat)""",
    "k AS (SELECT count(*) * 3 // 10 AS n FROM orders_feat)") + f"""
SELECT o_orderkey, o_orderpriority,
  CASE WHEN rn <= n * 4 // 10 THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN rn > n * 4 // 10 AND rn <= n * 7 // 10
    THEN (SELECT list_sort(list(DISTINCT c_mktsegment)) FROM orders_feat)[{_PICK.format(c='c_mktsegment')} + 1]
    ELSE c_mktsegment END AS c_mktsegment,
  CASE WHEN rn <= n // 2 THEN ['ASIA', 'EUROPE'][{_PICK.format(c='r_name')} + 1] ELSE r_name END AS r_name,
  CASE WHEN rn <= n THEN {_MODE.format(c='n_name')} ELSE n_name END AS n_name,
  CASE WHEN rn <= n THEN {_MODE.format(c='o_totalprice')} ELSE o_totalprice END AS o_totalprice
FROM placed, k""")
def drift_inject(spark, sf):
    plan = d.DriftPlan("o_orderpriority", (
        d.Force("o_orderstatus", "F", 0.0, 0.4),
        d.Draw("c_mktsegment", 0.4, 0.7, smallest=2),
        d.Draw("r_name", 0.0, 0.5, preferred=("ASIA", "EUROPE")),
    ))
    # Several statistics passes follow: the joined table is written once.
    df = materialize(orders_feat(spark, sf).select(
        "o_orderkey", "o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name", "n_name", "o_totalprice"), "feat")
    return d.inject_drift(df, ["o_orderkey"], plan)


DAYS = """base AS (SELECT "column", value, count(*) AS n FROM (
    SELECT 'event_type' AS "column", event_type AS value FROM events WHERE ts < '2024-01-08'::TIMESTAMP
    UNION ALL SELECT 'user_group', (user_id % 12)::VARCHAR FROM events WHERE ts < '2024-01-08'::TIMESTAMP) GROUP BY 1, 2),
days AS (SELECT day, "column", value, count(*) AS n FROM (
    SELECT ts::DATE AS day, 'event_type' AS "column",
      CASE WHEN event_type = 'error' AND day(ts) % 3 = 0 THEN 'outage' ELSE event_type END AS value FROM events
    UNION ALL SELECT ts::DATE, 'user_group', (user_id % 12)::VARCHAR FROM events) GROUP BY 1, 2, 3),
grid AS (SELECT DISTINCT day, d."column", b.value FROM days d JOIN base b USING ("column")
  UNION SELECT day, "column", value FROM days),
shares AS (SELECT g.day, g."column",
    coalesce(b.n::DOUBLE / (SELECT sum(n) FROM base x WHERE x."column" = g."column"), 1e-6) AS e,
    coalesce(d.n::DOUBLE / sum(d.n) OVER (PARTITION BY g.day, g."column"), 1e-6) AS a
  FROM grid g LEFT JOIN base b ON b."column" = g."column" AND b.value = g.value
  LEFT JOIN days d ON d.day = g.day AND d."column" = g."column" AND d.value = g.value)"""


def with_outages(events):
    """Every third day errors go by another name: a category that the baseline lacks, and one that those days lack."""
    renamed = (F.col("event_type") == "error") & (F.dayofmonth("ts") % 3 == 0)
    return events.withColumn("event_type", F.when(renamed, "outage").otherwise(F.col("event_type")))


def event_sides(spark, sf):
    events = table(spark, sf, "events").select(
        "ts", "event_type", (F.col("user_id") % 12).cast("string").alias("user_group"))
    baseline = events.filter(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    return baseline, with_outages(events)


@query("psi_by_day", with_ctes(DAYS) + """SELECT day::VARCHAR AS day, "column", round(sum((a - e) * ln(a / e)), 6) AS psi
  FROM shares GROUP BY 1, 2""")
def psi_by_day(spark, sf):
    baseline, current = event_sides(spark, sf)
    out = d.windowed_psi(baseline, current, "ts", ["event_type", "user_group"])
    return out.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "column", r6("psi").alias("psi"))
