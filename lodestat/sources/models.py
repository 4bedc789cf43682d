"""Saving and loading a fitted classifier with its labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.operators.runs import latest_model_run
from lodestat.operators.training import Classifier, CleanStep
from lodestat.sources.zones import read_if_exists


DESCRIPTION = (
    "label_col string, labels array<string>, features array<string>, clean struct<categorical: array<string>, "
    "numeric: array<string>, aliases: array<struct<name: string, others: array<string>>>>"
)


def save_classifier(classifier: Classifier, path: str) -> str:
    classifier.model.write().overwrite().save(f"{path}/stages")
    spark = SparkSession.active()
    step = classifier.clean
    clean = (step.categorical, step.numeric, [(k, list(v)) for k, v in step.aliases.items()]) if step else None
    row = [(classifier.label_col, classifier.labels, classifier.features, clean)]
    # The description is written last: its presence marks a complete model.
    spark.createDataFrame(row, DESCRIPTION).coalesce(1).write.mode("overwrite").json(f"{path}/description")
    return path


def load_classifier(spark: SparkSession, path: str) -> Classifier | None:
    """The saved classifier, or None when there is none at the path."""
    if read_if_exists(spark, f"{path}/description", "json") is None:
        return None
    row = spark.read.schema(DESCRIPTION).json(f"{path}/description").first()
    step = row["clean"]
    clean = CleanStep(list(step["categorical"]), list(step["numeric"]), {a["name"]: list(a["others"]) for a in step["aliases"]}) if step else None
    return Classifier(PipelineModel.load(f"{path}/stages"), list(row["labels"]), row["label_col"], list(row["features"]), clean)


def choose_classifier(
    spark: SparkSession, local_path: str, runs: DataFrame, priority: Sequence[str]
) -> Classifier | None:
    """The model at ``local_path``; without one, that of the newest run of the listed experiments.

    ``runs`` needs ``experiment, run_id, end_time, has_model, model_path``.
    """
    found = load_classifier(spark, local_path)
    if found is not None:
        return found
    newest = latest_model_run(runs, priority).select(F.col("model_path")).first()
    return load_classifier(spark, newest["model_path"]) if newest else None
