"""Class probabilities for margins, by isotonic regression on rows the model hasn't seen.

For each class, "is it this class?" is regressed on the class's margin under the sole
condition that it doesn't fall: neighbours that violate the order are pooled.  A row's
probabilities are the classes' values in shares of their sum.  The steps are Spark stages and
become part of the model, so they are saved and applied with it.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.operators.training import Classifier, index_labels
from lodestat.session import materialize


def calibrate(classifier: Classifier, held_out: DataFrame) -> Classifier:
    """``classifier`` with probabilities fitted on ``held_out``, rows that took no part in its fit.

    Rows without a known label are left out.  Where every class gets 0, the shares are equal.
    """
    k = len(classifier.labels)
    scored = classifier.predict(index_labels(held_out, classifier.label_col, classifier.labels))
    if "rawPrediction" not in scored.columns:
        raise ValueError("only models with a margin for each class can be calibrated")
    rows = materialize(scored.select("rawPrediction", "label"), "margins")
    if rows.isEmpty():
        raise ValueError("calibration needs rows with a known label")
    stages = []
    for c in range(k):
        target = rows.select("rawPrediction", F.when(F.col("label") == c, 1.0).otherwise(0.0).alias("is_class"))
        steps = IsotonicRegression(featuresCol="rawPrediction", featureIndex=c, labelCol="is_class", predictionCol=f"__step{c}")
        stages.append(steps.fit(target))
    total = " + ".join(f"`__step{c}`" for c in range(k))
    shares = ", ".join(f"IF({total} > 0, `__step{c}` / ({total}), {1 / k!r}D) AS `__calibrated{c}`" for c in range(k))
    if "probability" in scored.columns:  # the model's own give way
        stages.append(SQLTransformer(statement="SELECT * EXCEPT (probability) FROM __THIS__"))
    stages += [SQLTransformer(statement=f"SELECT *, {shares} FROM __THIS__"),
               VectorAssembler(inputCols=[f"__calibrated{c}" for c in range(k)], outputCol="probability")]
    return replace(classifier, model=PipelineModel([*classifier.model.stages, *stages]))
