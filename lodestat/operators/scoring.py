"""Batch scoring with a fitted pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.cleaning import drop_invalid_features, drop_missing_target
from lodestat.operators.evaluation import confusion_counts, summary_metrics
from lodestat.operators.fitted import quoted
from lodestat.operators.training import Classifier, index_labels
from lodestat.operators.validation import require_columns


def score(df: DataFrame, classifier: Classifier, keep: Sequence[str] | None = None) -> DataFrame:
    """Add the class, its probability and the map of all class probabilities.

    Records are cleaned as the training rows were; the kept columns stay as they were
    sent.  A model with margins only has no probabilities until it is calibrated.
    """
    kept = list(keep) if keep is not None else df.columns
    prepared = classifier.prepare(df.withColumn("__sent", F.struct(*[quoted(c) for c in kept])))
    require_columns(prepared, classifier.features)
    scored = classifier.model.transform(prepared)
    names = F.array(*[F.lit(x) for x in classifier.labels])
    code = F.col("prediction").cast("int")
    columns = [F.col("__sent").getField(c).alias(c) for c in kept] + [F.element_at(names, code + 1).alias("predicted")]
    if "probability" in scored.columns:
        shares = vector_to_array("probability")
        columns += [
            F.element_at(shares, code + 1).alias("confidence"),
            F.map_from_arrays(names, shares).alias("all_probabilities"),
        ]
    return scored.select(*columns)


def evaluate(df: DataFrame, classifier: Classifier, filtered: bool = True) -> DataFrame:
    """Metrics of a saved model on a current table, using the labels saved with it.

    ``filtered`` drops rows with a missing target or feature first.  Rows whose
    label the model does not know are counted in ``n_unknown`` and not scored.
    """
    label = classifier.label_col
    rows = drop_invalid_features(drop_missing_target(df, label), label) if filtered else df
    known = index_labels(rows, label, classifier.labels)
    counts = confusion_counts(classifier.predict(known).select(F.col("label").cast("int").alias("label"),
                                                               F.col("prediction").cast("int").alias("prediction")))
    unknown = rows.filter(~F.coalesce(quoted(label).cast("string").isin(*classifier.labels), F.lit(False)))
    return summary_metrics(counts).withColumn("n_unknown", unknown.agg(F.count(F.lit(1))).scalar())
