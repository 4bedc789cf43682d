"""Model fitting and multi-metric grid search with distributed estimators."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from math import prod
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.functions.numbers import half_even_class
from lodestat.functions.text import clean_numeric_text, number_from_text
from lodestat.operators.boosting import SoftmaxBoosting
from lodestat.operators.cleaning import clean_categoricals, resolve_aliases, text_columns
from lodestat.operators.encoding import encode_ordinal, fit_categories, one_hot_stages
from lodestat.operators.evaluation import summary_metrics
from lodestat.operators.fitted import quoted
from lodestat.operators.kernels import KernelMargins
from lodestat.operators.sampling import stratified_folds
from lodestat.session import materialize

# Forest settings of the chosen classifier and of the ordinal regressor.
FOREST = {"numTrees": 20, "maxDepth": 20, "impurity": "gini", "featureSubsetStrategy": "sqrt",
          "minInstancesPerNode": 1, "seed": 888}
ORDINAL_FOREST = {"numTrees": 120, "maxDepth": 12, "impurity": "variance", "featureSubsetStrategy": "sqrt",
                  "minInstancesPerNode": 1, "seed": 888}
# Search grids.  The smallest split size of the original grids has
# no counterpart in the distributed trees and is left out.
FOREST_GRID = {"numTrees": [16, 18, 20, 22, 24, 26], "maxDepth": [16, 18, 20, 22, 24], "minInstancesPerNode": [1, 2],
               "featureSubsetStrategy": ["sqrt"], "impurity": ["gini"]}
BOOST_GRID = {"maxIter": [50, 100], "stepSize": [0.05, 0.1, 0.2], "maxDepth": [3, 5]}
SVC_GRID = {"C": [0.1, 1, 10], "kernel": ["rbf", "poly"], "gamma": ["scale", "auto"]}
ORDINAL_GRID = {"numTrees": [40, 60, 80, 100, 120, 140, 160, 180, 200, 220], "maxDepth": [8, 12, 16, 20, 24, 28],
                "minInstancesPerNode": [1, 2, 3, 4], "featureSubsetStrategy": ["sqrt", "log2"]}
# Scorers of the grid search, the one that picks the winner first.
SCORERS = ("f1_weighted", "accuracy", "f1_macro", "precision_weighted", "recall_weighted")


def forest(**params) -> RandomForestClassifier:
    return RandomForestClassifier(**{**FOREST, **params})


def ordinal_forest(**params) -> RandomForestRegressor:
    return RandomForestRegressor(**{**ORDINAL_FOREST, **params})


def boosting(**params) -> SoftmaxBoosting:
    """Gradient boosting for several classes, as one softmax model."""
    return SoftmaxBoosting(**params)


def support_vectors(**params) -> KernelMargins:
    """Support vectors, one margin per class, behind the feature map of a kernel."""
    return KernelMargins(**params)


def gives_margins_only(estimator: Estimator) -> bool:
    """Whether models of the estimator have margins but no probabilities, unless they are calibrated."""
    return isinstance(estimator, KernelMargins)


@dataclass(frozen=True)
class CleanStep:
    """What raw records go through before they are encoded, in training and in scoring alike.

    Aliases resolve to the feature's name, categories are trimmed, single-spaced and
    lower-cased, and numbers sent as text are parsed.
    """

    categorical: list[str]
    numeric: list[str] = field(default_factory=list)
    aliases: dict[str, list[str]] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        named = clean_categoricals(resolve_aliases(df, self.aliases), self.categorical)
        texts = set(text_columns(named)) & set(self.numeric)
        return named.withColumns({c: number_from_text(clean_numeric_text(quoted(c))) for c in sorted(texts)})


@dataclass(frozen=True)
class Classifier:
    """A fitted pipeline with the labels it was fitted on, in code order, and the clean step its records need."""

    model: PipelineModel
    labels: list[str]
    label_col: str
    features: list[str] = field(default_factory=list)
    clean: CleanStep | None = None

    def prepare(self, df: DataFrame) -> DataFrame:
        return self.clean.apply(df) if self.clean else df

    def predict(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.prepare(df))


def index_labels(df: DataFrame, label: str, labels: Sequence[str], out: str = "label") -> DataFrame:
    """Alphabetical label codes with class metadata; rows without a known label are left out."""
    indexer = StringIndexerModel.from_labels(list(labels), inputCol="__label", outputCol=out, handleInvalid="skip")
    named = df.withColumn("__label", quoted(label).cast("string"))
    return indexer.transform(named.drop(out)).drop("__label")  # a column of that name gives way to the codes


def _flat(model: PipelineModel) -> PipelineModel:
    """Stages that are pipelines themselves are taken apart, so that the whole is saved as Spark's own stages where it can be."""
    stages = []
    for stage in model.stages:
        stages += _flat(stage).stages if isinstance(stage, PipelineModel) else [stage]
    return PipelineModel(stages)


def _columns(df: DataFrame, label: str, features: Sequence[str], written: bool) -> DataFrame:
    """The columns of the fit, written once: several passes read them."""
    rows = df.select(*[quoted(c) for c in dict.fromkeys([label, *features])])
    return rows if written else materialize(rows, "training")


def fit_classifier(
    df: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str] = (),
    estimator: Estimator | None = None, clean: CleanStep | None = None, written: bool = False,
) -> Classifier:
    """Encode and fit.  ``written`` says that ``df`` is a plain table already, not a plan to be computed anew by each pass."""
    features = [*categorical, *numeric]
    rows = _columns(clean.apply(df) if clean else df, label, features, written and not clean)
    categories = fit_categories(rows, [*dict.fromkeys([label, *categorical])])
    labels = categories[label]
    stages = one_hot_stages(rows, categorical, numeric, categories=categories)
    model = Pipeline(stages=[*stages, estimator or forest()]).fit(index_labels(rows, label, labels))
    return Classifier(_flat(model), labels, label, features, clean)


def fit_ordinal(
    df: DataFrame, label: str, ordered: Sequence[str], categorical: Sequence[str], numeric: Sequence[str] = (),
    estimator: Estimator | None = None, written: bool = False,
) -> Classifier:
    """A regressor on the position of the label in its fixed order."""
    features = [*categorical, *numeric]
    rows = _columns(df, label, features, written)
    stages = one_hot_stages(rows, categorical, numeric)
    coded = encode_ordinal(rows, label, ordered, "label").filter(F.col("label").isNotNull())
    return Classifier(Pipeline(stages=[*stages, estimator or ordinal_forest()]).fit(coded), list(ordered), label, features)


# ---------------------------------------------------------------- grid search
def combinations_of(grid: Mapping[str, Sequence]) -> list[dict]:
    return [dict(zip(grid, values, strict=True)) for values in product(*grid.values())]


def grid_size(grid: Mapping[str, Sequence], folds: int = 1) -> int:
    return prod(len(v) for v in grid.values()) * folds


def prepare(
    df: DataFrame, key_cols: Sequence[str], label_id: str, stages: Sequence, folds: int, seed: int = 42
) -> DataFrame:
    """``(features, label, fold)``: encoded once for every fit.

    A category absent from the other folds is a constant column there.  No tree
    splits on it, but it takes part in the draw of feature subsets, so scores may
    differ a little from those of an encoding fitted per fold.
    """
    folded = stratified_folds(df, key_cols, label_id, folds, seed)
    encoded = Pipeline(stages=list(stages)).fit(folded).transform(folded)
    return encoded.select("features", quoted(label_id).alias("label"), "fold")


def grid_search(
    data: DataFrame,
    build: Callable[..., Estimator],
    combos: Sequence[Mapping],
    folds: int = 3,
    n_classes: int | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Fit every combination on every fold and score both sides.

    Returns ``(combo_id, fold, part, <metrics>)`` with ``part`` test or train.
    Each fit needs one grouped count over its predictions; all metrics of all
    fits then come from those counts together.  With ``n_classes`` the estimator
    is a regressor on ordinal codes and ``mae`` is added.
    """
    data = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        def run(job: tuple[int, int]) -> list[tuple]:
            combo_id, fold = job
            model = build(**combos[combo_id]).fit(data.filter(F.col("fold") != fold))
            if isinstance(model, RandomForestClassificationModel):  # only its prediction is counted
                model = model.setRawPredictionCol("").setProbabilityCol("")
            scored = model.transform(data)
            shown = half_even_class(F.col("prediction"), n_classes) if n_classes else F.col("prediction").cast("int")
            counts = scored.groupBy(
                F.when(F.col("fold") == fold, "test").otherwise("train").alias("part"),
                F.col("label").cast("int").alias("label"), shown.alias("p"),
            ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.abs(F.col("label") - F.col("prediction"))).alias("error"))
            return [(combo_id, fold, r["part"], r["label"], r["p"], r["n"], r["error"]) for r in counts.collect()]

        jobs = [(c, f) for c in range(len(combos)) for f in range(folds)]
        with ThreadPool(min(parallelism, len(jobs))) as pool:
            results = pool.map(inheritable_thread_target(data.sparkSession)(run), jobs)
    finally:
        data.unpersist()
    counts = data.sparkSession.createDataFrame(
        [row for rows in results for row in rows],
        "combo_id int, fold int, part string, label int, prediction int, n bigint, error double",
    )
    ids = ["combo_id", "fold", "part"]
    metrics = summary_metrics(counts, ids)
    if not n_classes:
        return metrics
    errors = counts.groupBy(*ids).agg((F.sum("error") / F.sum("n")).alias("mae"))
    return metrics.join(errors, ids)


def score_rows(scores: DataFrame, scorers: Sequence[str] = SCORERS, part: str = "test") -> DataFrame:
    """``(combo_id, fold, scorer, score)`` of one part."""
    return scores.filter(F.col("part") == part).select("combo_id", "fold", *scorers).unpivot(
        ["combo_id", "fold"], list(scorers), "scorer", "score"
    )
