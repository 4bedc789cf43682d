"""Metrics of a rule-based predictor."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import CUT, PREDICTIONS, PRIORITIES, REPORT_SQL, predictions, query, r6, with_ctes
from lodestat.operators import evaluation as e
from lodestat.operators.sampling import stratified_split

def _counts(spark, sf):
    return e.confusion_counts(predictions(spark, sf))


@query("accuracy", with_ctes(PREDICTIONS) + """SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6)
  AS accuracy FROM predictions""")
def accuracy(spark, sf):
    return e.summary_metrics(_counts(spark, sf)).select(r6("accuracy").alias("accuracy"))


@query("classification_report", with_ctes(REPORT_SQL) + """SELECT class, round(precision, 6) AS precision,
  round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report
UNION ALL SELECT 'accuracy', round(sum(hits)::DOUBLE / sum(support), 6), round(sum(hits)::DOUBLE / sum(support), 6),
  round(sum(hits)::DOUBLE / sum(support), 6), sum(support)::BIGINT FROM report
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT
  FROM report
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
  round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT
  FROM report""")
def classification_report(spark, sf):
    rows = e.report_rows(_counts(spark, sf))
    return rows.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("weighted_metrics", with_ctes(REPORT_SQL) + """SELECT
  round(sum(precision * support) / sum(support), 6) AS precision_weighted,
  round(sum(recall * support) / sum(support), 6) AS recall_weighted,
  round(sum(f1 * support) / sum(support), 6) AS f1_weighted FROM report""")
def weighted_metrics(spark, sf):
    names = ["precision_weighted", "recall_weighted", "f1_weighted"]
    return e.summary_metrics(_counts(spark, sf)).select(*[r6(c).alias(c) for c in names])


@query("macro_f1", with_ctes(REPORT_SQL) + """SELECT round(avg(f1), 6) AS f1_macro,
  round(sum(hits)::DOUBLE / sum(support), 6) AS f1_micro FROM report""")
def macro_f1(spark, sf):
    return e.summary_metrics(_counts(spark, sf)).select(r6("f1_macro").alias("f1_macro"), r6("f1_micro").alias("f1_micro"))


@query("confusion_matrix", with_ctes(PREDICTIONS, """names AS (SELECT unnest(
  ['1-URGENT','2-HIGH','4-NOT SPECIFIED','5-LOW','9-NEVER']) AS x)""") + """
SELECT a.x AS label, b.x AS prediction, count(p.label) AS n FROM names a CROSS JOIN names b
LEFT JOIN predictions p ON p.label = a.x AND p.prediction = b.x GROUP BY 1, 2""")
def confusion_matrix(spark, sf):
    labels = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "9-NEVER"]
    return e.confusion_matrix(_counts(spark, sf), labels, ("3-MEDIUM",))


@query("confusion_wide", with_ctes(PREDICTIONS) + "SELECT label, " + ", ".join(
    f"count(*) FILTER (prediction = '{p}') AS \"{p}\"" for p in PRIORITIES) + " FROM predictions GROUP BY label")
def confusion_wide(spark, sf):
    return e.confusion_wide(_counts(spark, sf), PRIORITIES)


@query("mae", with_ctes(PREDICTIONS) + "SELECT round(avg(abs(code - score)), 6) AS mae FROM predictions")
def mae(spark, sf):
    return e.mean_absolute_error(predictions(spark, sf), "code", "score").select(r6("mae").alias("mae"))


@query("ordinal_metrics", with_ctes(PREDICTIONS) + """, rounded AS (
  SELECT code AS label, least(greatest(round_even(score, 0), 0), 4)::INT AS prediction, abs(code - score) AS error
  FROM predictions),
classes AS (SELECT class, sum(s)::BIGINT AS support, sum(p)::BIGINT AS predicted, sum(h)::BIGINT AS hits FROM (
    SELECT label AS class, 1 AS s, 0 AS p, CASE WHEN label = prediction THEN 1 ELSE 0 END AS h FROM rounded
    UNION ALL SELECT prediction, 0, 1, 0 FROM rounded) GROUP BY class),
report AS (SELECT coalesce(hits::DOUBLE / nullif(predicted, 0), 0) AS precision,
    coalesce(hits::DOUBLE / nullif(support, 0), 0) AS recall,
    coalesce(2 * hits::DOUBLE / nullif(predicted + support, 0), 0) AS f1, support, hits FROM classes)
SELECT (SELECT round(avg(error), 6) FROM rounded) AS mae, round(sum(hits)::DOUBLE / sum(support), 6) AS accuracy,
  round(sum(precision * support) / sum(support), 6) AS precision_weighted,
  round(sum(recall * support) / sum(support), 6) AS recall_weighted,
  round(sum(f1 * support) / sum(support), 6) AS f1_weighted, sum(support)::BIGINT AS n FROM report""")
def ordinal_metrics(spark, sf):
    out = e.ordinal_metrics(predictions(spark, sf), "code", "score", 5)
    return out.select(*[r6(c).alias(c) for c in out.columns if c != "n"], "n")


@query("prediction_shift", with_ctes(PREDICTIONS) + f"""SELECT prediction AS class,
  count(*) FILTER (o_orderdate < '{CUT}'::TIMESTAMP) AS n_baseline,
  count(*) FILTER (o_orderdate >= '{CUT}'::TIMESTAMP) AS n_current,
  round(n_baseline / sum(n_baseline) OVER (), 6) AS share_baseline, round(n_current / sum(n_current) OVER (), 6) AS share_current
FROM predictions GROUP BY 1""")
def prediction_shift(spark, sf):
    df = predictions(spark, sf)
    cut = F.lit(CUT).cast("timestamp_ntz")
    shift = e.prediction_shift(df.filter(F.col("o_orderdate") < cut), df.filter(F.col("o_orderdate") >= cut))
    return shift.withColumns({c: r6(c) for c in ("share_baseline", "share_current")})


@query("report_missing_predictions", with_ctes(PREDICTIONS) + """, p AS (
  SELECT label, CASE WHEN o_orderkey % 5 <> 0 THEN prediction END AS prediction FROM predictions WHERE label IS NOT NULL)
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*)::DOUBLE AS n FROM p""")
def report_missing_predictions(spark, sf):
    """A fifth of the rows has no prediction; they count as wrong."""
    df = predictions(spark, sf).withColumn("prediction", F.when(F.col("o_orderkey") % 5 != 0, F.col("prediction")))
    metrics = e.summary_metrics(e.confusion_counts(df))
    return metrics.select(r6("accuracy").alias("accuracy"), F.col("n").cast("double").alias("n"))


@query("overfit_gap", with_ctes(PREDICTIONS) + """, quotas AS (
  SELECT label AS grp, n * n_test // total AS base, n * n_test % total AS rest FROM (
    SELECT label, count(*) AS n, sum(count(*)) OVER ()::BIGINT AS total,
      ceil(sum(count(*)) OVER () * 2 / 10.0)::BIGINT AS n_test FROM predictions GROUP BY label)),
placed AS (SELECT *, row_number() OVER (ORDER BY rest DESC, grp) AS place FROM quotas),
parts AS (SELECT p.*, row_number() OVER (PARTITION BY label ORDER BY md5(o_orderkey::VARCHAR || '|42')) <=
    base + CASE WHEN place <= (SELECT ceil(count(*) * 2 / 10.0)::BIGINT FROM predictions) - (SELECT sum(base) FROM quotas)
      THEN 1 ELSE 0 END AS test
  FROM predictions p JOIN placed ON grp = label),
m AS (SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FILTER (NOT test) AS a,
  avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) FILTER (test) AS b FROM parts)
SELECT round(a, 6) AS acc_train, round(b, 6) AS acc_test, round(a - b, 6) AS gap FROM m""")
def overfit_gap(spark, sf):
    split = stratified_split(predictions(spark, sf), ["o_orderkey"], "label")
    out = e.overfit_gap(split, "split")
    return out.select(*[r6(c).alias(c) for c in out.columns])
