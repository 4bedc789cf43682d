"""Experiment-run analytics over events treated as runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lodestat.bindings.registry import (
    EVENT_EXPERIMENTS, EVENT_RUNS, REPORT_SQL, event_experiments, event_runs, predictions, query, r6, table, union_all,
    with_ctes,
)
from lodestat.operators import runs as t
from lodestat.operators.evaluation import confusion_counts, summary_metrics
from lodestat.session import scratch_path
from lodestat.sources.runstore import write_by_experiment

NAMES = ["click", "error", "purchase", "signup", "view"]
NAMED = EVENT_EXPERIMENTS + ", " + EVENT_RUNS + """, named AS (
  SELECT r.*, e.experiment || ' - ' || coalesce(run_name, 'unknown') AS model
  FROM runs r JOIN experiments e USING (experiment_id))"""
BEST = NAMED + """, best AS (SELECT * FROM named
  QUALIFY row_number() OVER (PARTITION BY model ORDER BY f1_weighted DESC, run_id) = 1)"""
RESOLVED = BEST + """, resolved AS (SELECT model, run_id, acc_test AS test_acc, 0.0::DOUBLE AS train_acc,
  f1_weighted AS test_f1_weighted, f1_macro AS test_f1_macro, 0.0::DOUBLE AS test_f1_micro,
  0.0::DOUBLE AS cv_f1_weighted_mean, cv_f1_weighted_std FROM best)"""
METRICS = ["test_acc", "train_acc", "test_f1_weighted", "test_f1_macro", "test_f1_micro", "cv_f1_weighted_mean",
           "cv_f1_weighted_std"]


def named_runs(spark, sf):
    return t.model_names(event_runs(spark, sf), event_experiments(spark, sf))


def resolved_runs(spark, sf):
    return t.resolve_metrics(t.best_run_per_model(named_runs(spark, sf), "f1_weighted"))


@query("runs_pivot", "SELECT event_type_group AS experiment_id, run_id, " + ", ".join(
    f"round(max_by(value, (event_id % 7, event_id)) FILTER (event_type = '{n}'), 6) AS {n}" for n in NAMES) + """
  FROM (SELECT *, (user_id % 5)::VARCHAR AS event_type_group, user_id::VARCHAR AS run_id FROM events) GROUP BY 1, 2""")
def runs_pivot(spark, sf):
    """Events as logged metrics: the event type is the metric, the last value counts."""
    logged = table(spark, sf, "events").select(
        (F.col("user_id") % 5).cast("string").alias("experiment_id"), F.col("user_id").cast("string").alias("run_id"),
        F.col("event_type").alias("name"), "value", F.col("event_id").alias("ts"), (F.col("event_id") % 7).alias("step"))
    out = t.runs_pivot(logged, NAMES)
    return out.select("experiment_id", "run_id", *[r6(n).alias(n) for n in NAMES])


@query("runs_per_experiment", with_ctes(EVENT_EXPERIMENTS, EVENT_RUNS) + """SELECT e.experiment_id, experiment,
  count(r.run_id) AS n_runs FROM experiments e LEFT JOIN runs r ON r.experiment_id = e.experiment_id GROUP BY 1, 2""")
def runs_per_experiment(spark, sf):
    return t.runs_per_experiment(event_experiments(spark, sf), event_runs(spark, sf))


@query("run_names", with_ctes(NAMED) + "SELECT experiment_id, run_id, model FROM named")
def run_names(spark, sf):
    return named_runs(spark, sf).select("experiment_id", "run_id", "model")


@query("best_run_per_model", with_ctes(BEST) + "SELECT model, run_id, round(f1_weighted, 6) AS f1_weighted FROM best")
def best_run_per_model(spark, sf):
    out = t.best_run_per_model(named_runs(spark, sf), "f1_weighted")
    return out.select("model", "run_id", r6("f1_weighted").alias("f1_weighted"))


@query("metric_aliases", with_ctes(RESOLVED) + "SELECT model, run_id, " + ", ".join(
    f"round({m}, 6) AS {m}" for m in METRICS) + " FROM resolved")
def metric_aliases(spark, sf):
    return resolved_runs(spark, sf).select("model", "run_id", *[r6(m).alias(m) for m in METRICS])


@query("model_ranking", with_ctes(RESOLVED) + """SELECT model, round(test_f1_weighted, 6) AS test_f1_weighted, rank,
  CASE rank WHEN 1 THEN '🥇' WHEN 2 THEN '🥈' WHEN 3 THEN '🥉' ELSE '' END AS medal
  FROM (SELECT *, row_number() OVER (ORDER BY test_f1_weighted DESC, model) AS rank FROM resolved)""")
def model_ranking(spark, sf):
    return t.rank_models(resolved_runs(spark, sf)).select(
        "model", r6("test_f1_weighted").alias("test_f1_weighted"), "rank", "medal")


@query("experiment_rankings", with_ctes(EVENT_RUNS, EVENT_EXPERIMENTS) + """SELECT
  translate(experiment, ' /\\', '___') AS experiment_safe, model, run_id,
  row_number() OVER (PARTITION BY experiment ORDER BY f1_weighted DESC, model) AS rank FROM (
    SELECT experiment, coalesce(run_name, 'unknown') AS model, run_id, f1_weighted
    FROM runs JOIN experiments USING (experiment_id)
    QUALIFY row_number() OVER (PARTITION BY experiment, coalesce(run_name, 'unknown') ORDER BY f1_weighted DESC, run_id) = 1)""")
def experiment_rankings(spark, sf):
    """One ranking per experiment, written to one folder each and read back."""
    runs = event_runs(spark, sf).join(event_experiments(spark, sf), "experiment_id")
    named = t.model_names(runs, None, combined=False)
    # The same model name in two experiments is two models here.
    keyed = named.withColumn("pair", F.struct("experiment", "model"))
    best = t.best_run_per_model(keyed.drop("model"), "f1_weighted", "pair").select("pair.model", "run_id", "f1_weighted", "experiment")
    path = write_by_experiment(t.rank_models(best, within="experiment"), scratch_path(spark, "rankings"))
    return spark.read.parquet(path).select("experiment_safe", "model", "run_id", "rank")


@query("global_rank", """SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey,
  row_number() OVER (ORDER BY l_returnflag DESC, l_extendedprice DESC, l_orderkey, l_partkey, l_suppkey, l_linenumber) AS rank
  FROM lineitem""")
def global_rank(spark, sf):
    """Rank of every line; the first sort key has three values only."""
    from lodestat.operators.ranking import SortKey
    from lodestat.operators.ranking import global_rank as rank

    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey", "l_returnflag")
    keys = [SortKey("l_returnflag", True), SortKey("l_extendedprice", True), SortKey("l_orderkey"), SortKey("l_partkey"),
            SortKey("l_suppkey"), SortKey("l_linenumber")]
    return rank(df, keys, small_rows=10_000).drop("l_returnflag")


@query("latest_run", with_ctes(EVENT_RUNS) + """SELECT experiment_id, run_id, end_time FROM runs
  QUALIFY row_number() OVER (PARTITION BY experiment_id ORDER BY end_time DESC, run_id DESC) = 1""")
def latest_run(spark, sf):
    return t.latest_run(event_runs(spark, sf))


@query("latest_model_run", with_ctes(EVENT_RUNS) + """SELECT experiment_id AS experiment, run_id, end_time FROM runs
  WHERE has_model AND experiment_id IN ('purchase', 'signup') ORDER BY experiment_id = 'signup', end_time DESC, run_id LIMIT 1""")
def latest_model_run(spark, sf):
    named = event_runs(spark, sf).withColumnRenamed("experiment_id", "experiment")
    return t.latest_model_run(named, ["purchase", "signup"]).select("experiment", "run_id", "end_time")


_TOP = RESOLVED + """, top AS (SELECT * FROM resolved ORDER BY test_f1_weighted DESC, model LIMIT 5)"""


@query("radar_rows", with_ctes(_TOP) + union_all([
    f"SELECT model, '{m}' AS metric, round({m}, 6) AS value FROM top"
    for m in ("test_acc", "test_f1_weighted", "test_f1_macro", "cv_f1_weighted_mean")]))
def radar_rows(spark, sf):
    return t.radar_rows(t.rank_models(resolved_runs(spark, sf))).withColumn("value", r6("value"))


@query("model_insights", with_ctes(RESOLVED) + """, b AS (SELECT * FROM resolved ORDER BY test_f1_weighted DESC, model LIMIT 1)
SELECT count(*) AS n_models, (SELECT model FROM b) AS best_model, round(max(test_f1_weighted), 6) AS best,
  round(avg(test_f1_weighted), 6) AS mean, round(max(test_f1_weighted) - min(test_f1_weighted), 6) AS score_range,
  (SELECT CASE WHEN cv_f1_weighted_std < 0.01 THEN 'high' WHEN cv_f1_weighted_std < 0.05 THEN 'moderate' ELSE 'variable' END
   FROM b) AS stability, max(test_f1_weighted) > avg(test_f1_weighted) + 0.1 AS stands_out FROM resolved""")
def model_insights(spark, sf):
    out = t.model_insights(resolved_runs(spark, sf))
    return out.select("n_models", "best_model", *[r6(c).alias(c) for c in ("best", "mean", "score_range")],
                      "stability", "stands_out")


@query("safe_names", with_ctes(EVENT_EXPERIMENTS) + """SELECT experiment,
  'models_comparison_' || translate(experiment, ' /\\', '___') AS report FROM experiments""")
def safe_names(spark, sf):
    return event_experiments(spark, sf).select(
        "experiment", F.concat(F.lit("models_comparison_"), t.safe_name(F.col("experiment"))).alias("report"))


# ---------------------------------------------------------------- grid results
_FOLDS = """folds AS (SELECT user_id AS combo_id, event_type AS scorer, (event_id % 3)::INT AS fold,
  sum(value::DECIMAL(18,2))::DOUBLE / count(*) / 97 AS score FROM events GROUP BY ALL),
summary AS (SELECT combo_id, scorer, avg(score) AS mean, stddev_pop(score) AS std, count(score) AS folds FROM folds GROUP BY ALL)"""


def fold_scores(spark, sf):
    """Events as fold scores of combinations: the user is the combination."""
    return table(spark, sf, "events").groupBy(
        F.col("user_id").alias("combo_id"), F.col("event_type").alias("scorer"),
        (F.col("event_id") % 3).cast("int").alias("fold"),
    ).agg((F.sum(F.col("value").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1)) / 97).alias("score"))


@query("cv_summary", with_ctes(_FOLDS) + """SELECT combo_id, scorer, round(mean, 6) AS mean, round(std, 6) AS std, folds
  FROM summary""")
def cv_summary(spark, sf):
    out = t.cv_summary(fold_scores(spark, sf))
    return out.select("combo_id", "scorer", r6("mean").alias("mean"), r6("std").alias("std"), "folds")


@query("top_n_models", with_ctes(_FOLDS) + """SELECT combo_id, round(mean, 6) AS mean, row_number() OVER (
  ORDER BY mean DESC, combo_id) AS rank, row_number() OVER (ORDER BY mean DESC, combo_id) = 1 AS best_model
  FROM summary WHERE scorer = 'purchase' ORDER BY rank LIMIT 5""")
def top_n_models(spark, sf):
    summary = t.cv_summary(fold_scores(spark, sf)).filter(F.col("scorer") == "purchase")
    return t.top_models(summary, "mean").select("combo_id", r6("mean").alias("mean"), "rank", "best_model")


@query("best_run_flag", with_ctes(EVENT_RUNS) + """SELECT experiment_id, run_id, rounded AS acc,
  rounded = max(rounded) OVER () AS is_best FROM (SELECT *, round(acc_test, 1) AS rounded FROM runs)""")
def best_run_flag(spark, sf):
    df = event_runs(spark, sf).select("experiment_id", "run_id", F.round("acc_test", 1).alias("acc"))
    return t.flag_best(df, "acc")


@query("param_grid", """SELECT status, priority, segment, fold FROM
  (SELECT DISTINCT o_orderstatus AS status FROM orders), (SELECT DISTINCT o_orderpriority AS priority FROM orders),
  (SELECT DISTINCT c_mktsegment AS segment FROM customer), (SELECT DISTINCT (o_orderkey % 3)::INT AS fold FROM orders)""")
def param_grid(spark, sf):
    """All combinations of value lists found in the tables."""
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    listed = orders.agg(
        F.array_sort(F.collect_set("o_orderstatus")).alias("status"),
        F.array_sort(F.collect_set("o_orderpriority")).alias("priority"),
        F.array_sort(F.collect_set((F.col("o_orderkey") % 3).cast("int"))).alias("fold"),
    ).withColumn("segment", customer.agg(F.array_sort(F.collect_set("c_mktsegment"))).scalar())
    return t.parameter_grid(listed, {c: F.col(c) for c in ("status", "priority", "segment", "fold")})


@query("model_card", with_ctes(REPORT_SQL) + """SELECT 'rule' AS model_type, '{"buckets":10,"hits":6}' AS parameters,
  round(sum(hits)::DOUBLE / sum(support), 6) AS test_accuracy, round(sum(f1 * support) / sum(support), 6) AS test_f1_weighted,
  (SELECT string_agg(DISTINCT label, ',' ORDER BY label) FROM predictions) AS classes, 'none' AS preprocessing FROM report""")
def model_card(spark, sf):
    counts = confusion_counts(predictions(spark, sf))
    metrics = summary_metrics(counts).select(
        r6("accuracy").alias("test_accuracy"), r6("f1_weighted").alias("test_f1_weighted"))
    classes = [r["label"] for r in counts.select("label").distinct().orderBy("label").collect()]
    return t.model_card(metrics, {"buckets": 10, "hits": 6}, classes, "rule", "none")
