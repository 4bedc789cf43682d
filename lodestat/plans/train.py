"""Train, evaluate and record one model; search a grid and keep the best."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.calibration import calibrate
from lodestat.operators.cleaning import drop_invalid_features, drop_missing_target, resolve_aliases
from lodestat.operators.encoding import encode_ordinal, fit_categories, one_hot_stages
from lodestat.operators.evaluation import confusion_counts, ordinal_metrics, summary_metrics
from lodestat.operators.fitted import quoted
from lodestat.operators.runs import cv_summary, top_models
from lodestat.operators.sampling import stratified_folds, stratified_split
from lodestat.operators.training import (
    SCORERS, Classifier, CleanStep, fit_classifier, fit_ordinal, forest, gives_margins_only, grid_search, index_labels, ordinal_forest, prepare,
    score_rows,
)
from lodestat.session import materialize
from lodestat.sources.runstore import log_run


# One fold of the training part calibrates.
CALIBRATION_FOLDS = 5


@dataclass(frozen=True)
class Training:
    classifier: Classifier
    counts: DataFrame  # (label, prediction, n) on the test rows, labels as text
    metrics: DataFrame


@dataclass(frozen=True)
class RunLog:
    """Where a plan logs its run: a record store, the experiment, the run's id and its tags."""

    path: str
    experiment_id: str
    run_id: str
    tags: Mapping[str, str] = field(default_factory=dict)

    def write(self, metrics: DataFrame, params: Mapping[str, object]) -> None:
        log_run(metrics.sparkSession, self.path, self.experiment_id, self.run_id, metrics, params, self.tags)


def estimator_params(estimator: Estimator) -> dict[str, object]:
    """The settings of an estimator: of Spark's own those that were set, of others the plain attributes."""
    set_ones = {p.name: v for p, v in estimator.extractParamMap().items() if estimator.isSet(p)}
    plain = {k: v for k, v in vars(estimator).items() if not k.startswith("_") and isinstance(v, (int, float, str, bool)) and k != "uid"}
    return {"estimator": type(estimator).__name__, **plain, **set_ones}


def _needed(df: DataFrame, *groups: Sequence[str] | str) -> DataFrame:
    names = [c for g in groups for c in ([g] if isinstance(g, str) else g)]
    return df.select(*[quoted(c) for c in dict.fromkeys(names)])


def holdout_counts(classifier: Classifier, rows: DataFrame) -> DataFrame:
    names = F.array(*[F.lit(x) for x in classifier.labels])
    coded = index_labels(rows, classifier.label_col, classifier.labels)
    shown = classifier.predict(coded).select(
        F.element_at(names, F.col("label").cast("int") + 1).alias("label"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("prediction"),
    )
    return confusion_counts(shown)


def train(
    df: DataFrame, key_cols: Sequence[str], label: str, categorical: Sequence[str], numeric: Sequence[str] = (),
    estimator: Estimator | None = None, seed: int = 42, clean: bool = False,
    aliases: Mapping[str, Sequence[str]] | None = None, log: RunLog | None = None,
) -> Training:
    """Split, fit on the training part, evaluate on the test part.

    ``clean`` drops rows with a missing target or feature and normalises the features; the
    classifier keeps that step, with the ``aliases``, for the records it will score.
    With a ``log`` the test metrics, the estimator's settings and the features are recorded as a run.
    A model with margins only is fitted on four fifths of the training part and calibrated on the fifth.
    """
    step = CleanStep(list(categorical), list(numeric), {k: list(v) for k, v in (aliases or {}).items()}) if clean else None
    df = resolve_aliases(df, step.aliases) if step else df
    rows = _needed(drop_invalid_features(drop_missing_target(df, label), label) if clean else df,
                   key_cols, label, categorical, numeric)
    # Fitting passes over the rows many times: the split table is written once.
    split = materialize(stratified_split(rows, key_cols, label, seed=seed), "split")
    training, estimator = split.filter("split = 'train'"), estimator or forest()
    if gives_margins_only(estimator):
        folded = materialize(stratified_folds(training, key_cols, label, CALIBRATION_FOLDS, seed), "folds")
        classifier = fit_classifier(folded.filter("fold <> 0"), label, categorical, numeric, estimator, step, written=True)
        classifier = calibrate(classifier, folded.filter("fold = 0"))
    else:
        classifier = fit_classifier(training, label, categorical, numeric, estimator, step, written=True)
    counts = holdout_counts(classifier, split.filter("split = 'test'"))
    metrics = summary_metrics(counts)
    if log:
        settings = {"target": label, "categorical": ",".join(categorical), "numeric": ",".join(numeric), "split_seed": seed}
        log.write(metrics, {**estimator_params(estimator), **settings})
    return Training(classifier, counts, metrics)


def train_ordinal(
    df: DataFrame, key_cols: Sequence[str], label: str, ordered: Sequence[str], categorical: Sequence[str],
    numeric: Sequence[str] = (), estimator: Estimator | None = None, seed: int = 42,
) -> tuple[Classifier, DataFrame]:
    """The ordinal variant: continuous prediction, MAE and rounded class metrics."""
    split = materialize(
        stratified_split(_needed(df, key_cols, label, categorical, numeric), key_cols, label, seed=seed), "split")
    classifier = fit_ordinal(
        split.filter("split = 'train'"), label, ordered, categorical, numeric, estimator or ordinal_forest(), written=True
    )
    test = encode_ordinal(split.filter("split = 'test'"), label, ordered, "label", check=False)
    return classifier, ordinal_metrics(classifier.predict(test), "label", "prediction", len(ordered))


def search(
    df: DataFrame, key_cols: Sequence[str], label: str, categorical: Sequence[str], numeric: Sequence[str],
    combos: Sequence[Mapping], build: Callable[..., Estimator] = forest, folds: int = 3, top: int = 5,
    parallelism: int = 4, seed: int = 42, log: RunLog | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Cross-validated search: ``(summary per combination and scorer, ranked best)``.

    With a ``log`` every ranked combination is recorded as a run of its own, with its rank and settings.
    """
    df = materialize(_needed(df, key_cols, label, categorical, numeric), "search")
    labels = fit_categories(df, [label])[label]
    coded = index_labels(df, label, labels, "label_id")
    data = prepare(coded, key_cols, "label_id", one_hot_stages(df, categorical, numeric), folds, seed)
    scores = grid_search(data, build, combos, folds, parallelism=parallelism)
    summary = cv_summary(score_rows(scores))
    best = top_models(summary.filter(F.col("scorer") == "f1_weighted"), "mean", n=top)
    if log:
        summary, best = materialize(summary, "summary"), materialize(best, "best")
        for r in best.select("combo_id", "rank", "best_model").collect():  # at most ``top`` rows
            own = summary.filter(F.col("combo_id") == r["combo_id"]).agg(*[
                F.max(F.when(F.col("scorer") == s, F.col(kind))).alias(f"cv_{s}_{kind}") for s in SCORERS for kind in ("mean", "std")])
            run = RunLog(log.path, log.experiment_id, f"{log.run_id}-{r['rank']}", {**log.tags, "rank": str(r["rank"]), "best_model": str(r["best_model"]).lower()})
            run.write(own, {**combos[r["combo_id"]], "folds": folds})
    return summary, best


def search_ordinal(
    df: DataFrame, key_cols: Sequence[str], label: str, ordered: Sequence[str], categorical: Sequence[str],
    numeric: Sequence[str], combos: Sequence[Mapping], folds: int = 3, top: int = 5, parallelism: int = 4,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """The ordinal search: combinations ranked by the smallest mean absolute error."""
    df = materialize(_needed(df, key_cols, label, categorical, numeric), "search")
    coded = encode_ordinal(df, label, ordered, "label_id")
    data = prepare(coded, key_cols, "label_id", one_hot_stages(df, categorical, numeric), folds, seed)
    scores = grid_search(data, ordinal_forest, combos, folds, n_classes=len(ordered), parallelism=parallelism)
    negative = scores.withColumn("neg_mae", -F.col("mae"))
    summary = cv_summary(score_rows(negative, ["neg_mae"]))
    return summary, top_models(summary, "mean", n=top)


def refit(
    df: DataFrame, key_cols: Sequence[str], label: str, categorical: Sequence[str], numeric: Sequence[str],
    combos: Sequence[Mapping], build: Callable[..., Estimator] = forest, parallelism: int = 4, seed: int = 42,
) -> DataFrame:
    """Fit every given combination on the whole training part and score it on the holdout.

    Returns ``(combo_id, <metrics>)``; used for the winners of a search and for
    grids that compare all combinations on the test rows.
    """
    df = materialize(_needed(df, key_cols, label, categorical, numeric), "refit")
    labels = fit_categories(df, [label])[label]
    split = materialize(stratified_split(df, key_cols, label, seed=seed), "split")
    coded = index_labels(split, label, labels, "label_id")
    stages = one_hot_stages(df, categorical, numeric)
    data = Pipeline(stages=stages).fit(coded).transform(coded).select(
        "features", F.col("label_id").alias("label"), F.when(F.col("split") == "test", 0).otherwise(1).alias("fold"))
    # Only the fit that leaves the test rows out is needed.
    scores = grid_search(data, build, combos, 1, parallelism=parallelism)
    return scores.filter("part = 'test'").drop("fold", "part")
