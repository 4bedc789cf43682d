"""A forest whose rows left out are known again: out-of-bag score without storing the resamples.

A row's weight in a tree is a Poisson draw with mean 1 from the hash of its key, the seed and the
tree's number.  So which trees left a row out follows from its key alone, on any partitioning
and after any retry, and scoring needs no table of resamples.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import exp, factorial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.functions.hashing import hash_order
from lodestat.operators.encoding import fit_categories, one_hot_stages
from lodestat.operators.evaluation import confusion_counts, summary_metrics
from lodestat.operators.fitted import quoted
from lodestat.operators.training import FOREST, Classifier, index_labels
from lodestat.session import materialize

#: Larger draws are rarer than one in 10^13, less than the hash can tell.
MOST_DRAWS = 16
#: Trees applied in one projection when votes are counted.
TREES_AT_ONCE = 20


def poisson_limits(mean: float = 1.0) -> list[float]:
    """The chance of a draw of at most 0, 1, 2, ..."""
    limits, total = [], 0.0
    for k in range(MOST_DRAWS):
        total += exp(-mean) * mean**k / factorial(k)
        limits.append(total)
    return limits


def tree_weight(key_cols: Sequence[str], seed: int | str, tree: int) -> Column:
    """How often the row is in the tree's sample: the limits that the row's fraction of the hash range reaches."""
    place = F.conv(F.substring(hash_order(key_cols, f"{seed}|{tree}"), 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))
    # A lambda over one value, as plain comparisons would hash for each limit.
    reached = lambda p: sum((F.when(F.lit(x) <= p, 1).otherwise(0) for x in poisson_limits()), F.lit(0))
    return F.get(F.transform(F.array(place), reached), F.lit(0))


def _forest(spark: SparkSession, trees: list[DecisionTreeClassificationModel], n_features: int, n_classes: int) -> RandomForestClassificationModel:
    context = spark.sparkContext
    kind = context._jvm.org.apache.spark.ml.classification
    java_trees = context._gateway.new_array(kind.DecisionTreeClassificationModel, len(trees))
    for i, tree in enumerate(trees):
        java_trees[i] = tree._java_obj
    model = RandomForestClassificationModel(kind.RandomForestClassificationModel("rfc_outofbag", java_trees, n_features, n_classes))
    return model._set(numTrees=len(trees))  # a saved forest is checked against this number


@dataclass(frozen=True)
class OutOfBag:
    classifier: Classifier
    predictions: DataFrame  # the key, label and prediction as text, votes; NULL where every tree had the row
    metrics: DataFrame  # of the rows some tree left out, with n_without: those no tree left out


def fit_out_of_bag(
    df: DataFrame, key_cols: Sequence[str], label: str, categorical: Sequence[str], numeric: Sequence[str] = (),
    seed: int = 42, parallelism: int = 4, **params,
) -> OutOfBag:
    """Fit a forest on Poisson resamples and score every row with the trees that left it out.

    ``params`` are those of the forest.  Votes are the trees' class shares, as in the forest
    itself; equal votes go to the smaller label.  Rows without a known label are left out.
    """
    params = {**FOREST, **params}
    n_trees = params.pop("numTrees")
    names = [*key_cols, label, *categorical, *numeric]
    rows = materialize(df.select(*[quoted(c) for c in dict.fromkeys(names)]), "bags")
    labels = fit_categories(rows, [label])[label]
    stages = Pipeline(stages=one_hot_stages(rows, categorical, numeric)).fit(rows)
    coded = index_labels(stages.transform(rows), label, labels)
    # Written with every tree's weights: a tree reads its own in each of its passes, and the votes read all.
    weights = [tree_weight(key_cols, seed, t).cast("byte").alias(_weight(t)) for t in range(n_trees)]
    coded = materialize(coded.select(*[quoted(c) for c in key_cols], "features", "label", *weights), "bags")
    spark = df.sparkSession

    def one(t: int) -> DecisionTreeClassificationModel:
        weighted = index_metadata(coded.filter(F.col(_weight(t)) > 0), len(labels)).select("features", "label", F.col(_weight(t)).cast("double").alias("w"))
        tree = RandomForestClassifier(**{**params, "numTrees": 1, "bootstrap": False, "weightCol": "w", "seed": params["seed"] + t})
        return tree.fit(weighted).trees[0]

    with ThreadPool(min(parallelism, n_trees)) as pool:
        trees = pool.map(inheritable_thread_target(spark)(one), range(n_trees))
    votes = coded
    for at in range(0, n_trees, TREES_AT_ONCE):
        votes = _voted(votes, trees, range(at, min(at + TREES_AT_ONCE, n_trees)), len(labels))
    shown = F.array(*[F.lit(x) for x in labels])
    best = F.array_position("votes", F.array_max("votes")).cast("int")
    predictions = votes.select(
        *[quoted(c) for c in key_cols], F.element_at(shown, F.col("label").cast("int") + 1).alias("label"),
        F.when(F.col("bags") > 0, F.element_at(shown, best)).alias("prediction"), F.col("bags").alias("votes"))
    predictions = materialize(predictions, "outofbag")
    counts = confusion_counts(predictions.filter("votes > 0").select("label", "prediction"))
    metrics = summary_metrics(counts).withColumn("n_without", predictions.filter("votes = 0").agg(F.count(F.lit(1))).scalar())
    width = trees[0].numFeatures
    model = _forest(spark, trees, width, len(labels))
    return OutOfBag(Classifier(PipelineModel([*stages.stages, model]), labels, label, [*categorical, *numeric]), predictions, metrics)


def index_metadata(df: DataFrame, n_classes: int) -> DataFrame:
    """``label`` with the number of classes, which a tree must know even if its sample lacks one."""
    nominal = {"ml_attr": {"type": "nominal", "name": "label", "vals": [str(i) for i in range(n_classes)]}}
    return df.withColumn("label", F.col("label").alias("label", metadata=nominal))


def _weight(tree: int) -> str:
    return f"__w{tree}"


def _voted(df: DataFrame, trees: list, turns: range, n_classes: int) -> DataFrame:
    """``votes`` (an array over the classes) and ``bags`` (trees that left the row out) with the given trees added."""
    names = [*[c for c in df.columns if c not in ("votes", "bags")]]
    votes = F.col("votes") if "votes" in df.columns else F.array(*[F.lit(0.0)] * n_classes)
    bags = F.col("bags") if "bags" in df.columns else F.lit(0)
    kept = df.columns
    for t in turns:
        tree = trees[t].copy().setProbabilityCol(f"__p{t}").setRawPredictionCol("").setPredictionCol("")
        df = tree.transform(df)
        out = F.col(_weight(t)) == 0
        df = df.select(*[quoted(c) for c in kept if c in df.columns], *[F.col(f"__v{s}") for s in turns if s < t], F.when(
            out, vector_to_array(f"__p{t}")).alias(f"__v{t}"))
    for t in turns:
        own = F.col(f"__v{t}")
        votes = F.when(own.isNull(), votes).otherwise(F.zip_with(votes, own, lambda a, b: a + b))
        bags = bags + own.isNotNull().cast("int")
    return df.select(*[quoted(c) for c in names], votes.alias("votes"), bags.alias("bags"))
