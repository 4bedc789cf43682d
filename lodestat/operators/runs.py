"""Analytics over experiment runs and grid-search results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.operators.fitted import join_fitted, quoted, settle
from lodestat.operators.ranking import SortKey, global_rank, rank_within

# Names under which a metric may have been logged, best first.
METRIC_ALIASES: Mapping[str, Sequence[str]] = {
    "test_acc": ("test_acc", "acc_test", "accuracy", "test_accuracy"),
    "train_acc": ("acc_train",),
    "test_f1_weighted": ("test_f1_weighted", "f1_weighted"),
    "test_f1_macro": ("test_f1_macro", "f1_macro"),
    "test_f1_micro": ("f1_micro",),
    "cv_f1_weighted_mean": ("cv_f1_weighted_mean",),
    "cv_f1_weighted_std": ("cv_f1_weighted_std",),
}
# Metrics drawn in the radar and bar charts, in order.
CHART_METRICS = ("test_acc", "test_f1_weighted", "test_f1_macro", "cv_f1_weighted_mean", "accuracy", "f1_weighted")
# Stability bounds and the margin of an outstanding model.
STABLE_BELOW, MODERATE_BELOW, OUTSTANDING_MARGIN = 0.01, 0.05, 0.1
MEDALS = {1: "🥇", 2: "🥈", 3: "🥉"}


def runs_pivot(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """One row per run with one column per metric; the latest logged value counts.

    Conditional aggregates over the given names: no second pass to discover the
    pivot values and no per-run lists.
    """
    latest = [
        F.max_by(F.when(F.col("name") == m, F.col("value")),
                 F.when(F.col("name") == m, F.struct("step", "ts", "value"))).alias(m)
        for m in names
    ]
    return metrics.groupBy("experiment_id", "run_id").agg(*latest)


def runs_per_experiment(experiments: DataFrame, runs: DataFrame) -> DataFrame:
    """Run counts, 0 for an experiment without runs."""
    counted = runs.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("n"))
    return experiments.join(counted, "experiment_id", "left").select(
        "experiment_id", "experiment", F.coalesce("n", F.lit(0)).alias("n_runs")
    )


def model_names(runs: DataFrame, experiments: DataFrame | None, combined: bool = True) -> DataFrame:
    """Add ``model``: the run name, prefixed by its experiment when several are combined."""
    base = F.coalesce("run_name", F.lit("unknown"))
    if not combined:
        return runs.withColumn("model", base)
    named = join_fitted(runs, experiments.select("experiment_id", "experiment"), "experiment_id")
    return named.withColumn("model", F.concat_ws(" - ", F.nullif("experiment", F.lit("")), base)).drop("experiment")


def best_run_per_model(runs: DataFrame, score: str = "test_f1_weighted", model: str = "model") -> DataFrame:
    """The run with the highest score per model; on ties the smallest run id.

    One aggregation that keeps a single row per model: a model with most of the
    runs needs no sort of its own.
    """
    kept = [c for c in runs.columns if c != model]
    rank = F.struct((-F.coalesce(quoted(score), F.lit(0.0))).alias("s"), quoted("run_id").alias("r"))
    return runs.groupBy(quoted(model).alias(model)).agg(
        F.min_by(F.struct(*[quoted(c) for c in kept]), rank).alias("best")
    ).select(model, "best.*")


def resolve_metrics(runs: DataFrame, ids: Sequence[str] = ("model", "run_id")) -> DataFrame:
    """Standard metric columns from whichever names were logged; 0 when none was."""
    out = []
    for name, aliases in METRIC_ALIASES.items():
        found = [quoted(a) for a in aliases if a in runs.columns]
        out.append(F.coalesce(*found, F.lit(0.0)).alias(name))
    return runs.select(*[quoted(c) for c in ids if c in runs.columns], *out)


def _score_column(df: DataFrame) -> str:
    return next((c for c in ("test_f1_weighted", "f1_weighted") if c in df.columns), df.columns[1])


def rank_models(runs: DataFrame, model: str = "model", within: str | None = None) -> DataFrame:
    """Rank by the first available F1 column, descending, with a medal for the first three.

    ``within`` ranks inside each value of that column, one report per experiment.
    """
    keys = [SortKey(_score_column(runs), descending=True), SortKey(model)]
    ranked = rank_within(runs, within, keys) if within else global_rank(runs, keys)
    medal = F.lit("")
    for place, sign in MEDALS.items():
        medal = F.when(F.col("rank") == place, sign).otherwise(medal)
    return ranked.withColumn("medal", medal)


def latest_run(runs: DataFrame) -> DataFrame:
    """The newest run of every experiment by end time; on ties the larger run id."""
    return runs.groupBy("experiment_id").agg(
        F.max_by(F.struct("run_id", "end_time"), F.struct("end_time", "run_id")).alias("r")
    ).select("experiment_id", "r.*")


def latest_model_run(runs: DataFrame, priority: Sequence[str]) -> DataFrame:
    """The newest run that has a model, in the first experiment of the list that has one."""
    order = F.array_position(F.array(*[F.lit(e) for e in priority]), F.col("experiment"))
    return (
        runs.filter(F.col("has_model") & F.col("experiment").isin(*priority))
        .withColumn("priority", order.cast("int"))
        .orderBy("priority", F.col("end_time").desc(), "run_id").limit(1)
    )


def top_models(results: DataFrame, score: str, combo: str = "combo_id", n: int = 5) -> DataFrame:
    """Best ``n`` combinations by mean score, ranked; rank 1 is flagged best."""
    first = results.orderBy(quoted(score).desc_nulls_last(), quoted(combo)).limit(n)
    ranked = global_rank(first, [SortKey(score, descending=True), SortKey(combo)])
    return ranked.withColumn("best_model", F.col("rank") == 1)


def flag_best(results: DataFrame, score: str) -> DataFrame:
    """Flag every row that reaches the best score."""
    results, _ = settle(results, "results")
    best = results.agg(F.max(quoted(score))).scalar()
    return results.withColumn("is_best", quoted(score) == best)


def cv_summary(fold_scores: DataFrame, combo: str = "combo_id") -> DataFrame:
    """Mean and population deviation per combination and scorer."""
    return fold_scores.groupBy(quoted(combo).alias(combo), "scorer").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"), F.count("score").alias("folds")
    )


def parameter_grid(seed_row: DataFrame, lists: Mapping[str, Column]) -> DataFrame:
    """All combinations of parameter lists, one explode per parameter.

    ``lists`` maps a parameter to an array column of the one-row ``seed_row``.
    """
    grid = seed_row.select(*[col.alias(f"__{i}") for i, col in enumerate(lists.values())])
    for i, name in enumerate(lists):
        grid = grid.withColumn(name, F.explode(F.col(f"__{i}"))).drop(f"__{i}")
    return grid


def radar_rows(ranked: DataFrame, top: int = 5, metrics: int = 4, model: str = "model") -> DataFrame:
    """``(model, metric, value)`` of the first models and chart metrics."""
    names = [m for m in CHART_METRICS if m in ranked.columns][:metrics]
    best = ranked.orderBy("rank").limit(top)
    return best.select(quoted(model), *[quoted(m).cast("double") for m in names]).unpivot(
        [quoted(model)], [quoted(m) for m in names], "metric", "value"
    )


def model_insights(runs: DataFrame, model: str = "model") -> DataFrame:
    """Count, best, mean, range, stability of the best model, and whether it stands out."""
    score = _score_column(runs)
    spread = F.coalesce(quoted("cv_f1_weighted_std"), F.lit(0.0)) if "cv_f1_weighted_std" in runs.columns else F.lit(0.0)
    first = F.struct((-quoted(score)).alias("s"), quoted(model).alias("m"))
    sums = runs.agg(
        F.count(F.lit(1)).alias("n_models"), F.max(quoted(score)).alias("best"), F.avg(quoted(score)).alias("mean"),
        (F.max(quoted(score)) - F.min(quoted(score))).alias("score_range"),
        F.min_by(F.struct(quoted(model).alias("m"), spread.alias("sd")), first).alias("b"),
    )
    stability = F.when(F.col("b.sd") < STABLE_BELOW, "high").when(
        F.col("b.sd") < MODERATE_BELOW, "moderate").otherwise("variable")
    return sums.select(
        "n_models", F.col("b.m").alias("best_model"), "best", "mean", "score_range", stability.alias("stability"),
        (F.col("best") > F.col("mean") + OUTSTANDING_MARGIN).alias("stands_out"),
    )


def safe_name(col: Column) -> Column:
    """A name usable in a path: blanks and slashes become underscores."""
    return F.translate(col, " /\\", "___")


def model_card(metrics: DataFrame, params: Mapping[str, object], classes: Sequence[str], model_type: str,
               preprocessing: str) -> DataFrame:
    """One registry row per model: type, parameters, test metrics, classes, preprocessing."""
    return metrics.select(
        F.lit(model_type).alias("model_type"),
        F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in params.items()])).alias("parameters"),
        "*",
        F.array_join(F.array(*[F.lit(c) for c in classes]), ",").alias("classes"),
        F.lit(preprocessing).alias("preprocessing"),
    )
