"""Boosting for several classes: one additive softmax model.

Every class has a margin, at first the log of its share.  A round turns the margins into
shares ``p`` by softmax and fits one regression tree for each class on the common gradient:
on ``(y - p) / h`` with row weights ``h = p (1 - p)``.  A leaf's weighted mean is then the
Newton step ``sum(y - p) / sum(h)``, and splits are chosen by the same second-order gain.
The margins move by ``step * (K - 1) / K`` times the leaf.

The fitted model is made of Spark's own stages (a tree ensemble for each class, softmax as SQL
expressions), so it is saved, loaded and applied without any code of this library.
"""

from __future__ import annotations

from math import log
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestat.session import materialize

#: A row's weight is at least this, so that a certain row's gradient over its weight stays finite.
LEAST_WEIGHT = 1e-6
#: The margins are written once in so many rounds; in between, the trees since then are applied on the way.
CARRY = 10


def additive(spark: SparkSession, trees: list[DecisionTreeRegressionModel], weight: float, output: str, features: str) -> GBTRegressionModel:
    """Spark's ensemble model over already fitted trees, all of one weight."""
    context = spark.sparkContext
    java_trees = context._gateway.new_array(context._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, len(trees))
    weights = context._gateway.new_array(context._jvm.double, len(trees))
    for i, tree in enumerate(trees):
        java_trees[i], weights[i] = tree._java_obj, float(weight)
    uid = f"GBTRegressionModel_{output}"
    model = GBTRegressionModel(context._jvm.org.apache.spark.ml.regression.GBTRegressionModel(uid, java_trees, weights))
    return model.setFeaturesCol(features).setPredictionCol(output)


def softmax(margins: list[Column]) -> list[Column]:
    top = F.greatest(*margins) if len(margins) > 1 else margins[0]
    parts = [F.exp(m - top) for m in margins]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def softmax_stages(k: int, start: list[float]) -> list:
    """From ``__tree0 .. __treeK`` to ``rawPrediction``, ``probability`` and ``prediction``.

    Equal margins go to the smaller code.
    """
    margins = ", ".join(f"`__tree{i}` + {start[i]!r}D AS `__margin{i}`" for i in range(k))
    names = ", ".join(f"`__margin{i}`" for i in range(k))
    top = f"array_max(array({names}))"
    parts = [f"exp(`__margin{i}` - `__top`)" for i in range(k)]
    shares = ", ".join(f"{p} / ({' + '.join(parts)}) AS `__share{i}`" for i, p in enumerate(parts))
    return [
        SQLTransformer(statement=f"SELECT *, {margins} FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {top} AS `__top`, CAST(array_position(array({names}), {top}) - 1 AS DOUBLE) AS prediction FROM __THIS__"),
        SQLTransformer(statement=f"SELECT *, {shares} FROM __THIS__"),
        VectorAssembler(inputCols=[f"__margin{i}" for i in range(k)], outputCol="rawPrediction"),
        VectorAssembler(inputCols=[f"__share{i}" for i in range(k)], outputCol="probability"),
    ]


def _source(c: int, k: int) -> tuple[int, float]:
    """Whose trees class ``c`` takes, and their sign: of two classes one's gradient is the other's, turned round."""
    return (1, -1.0) if k == 2 and c == 0 else (c, 1.0)


class SoftmaxBoosting(Estimator):
    """Fits the additive softmax model on ``features`` and ``label`` (codes from 0).

    After a fit, ``losses`` holds the mean log loss on the training rows before the first and
    after every round, if ``track`` is set; each costs a pass over the rows.
    """

    def __init__(self, maxIter: int = 20, stepSize: float = 0.1, maxDepth: int = 3, track: bool = False, parallelism: int = 4,
                 seed: int = 888, featuresCol: str = "features", labelCol: str = "label", **tree) -> None:
        super().__init__()
        if maxIter < 1:
            raise ValueError("boosting needs a round at least")
        self.maxIter, self.stepSize, self.track, self.parallelism = maxIter, stepSize, track, parallelism
        self.features, self.label = featuresCol, labelCol
        self.tree = {"maxDepth": maxDepth, "seed": seed, **tree}
        self.losses: list[float] = []

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        spark = dataset.sparkSession
        rows = materialize(dataset.select(F.col(self.features).alias("features"), F.col(self.label).cast("int").alias("y")), "boosting")
        sizes = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per class
        if not sizes or min(sizes) < 0:
            raise ValueError("boosting needs rows with codes from 0")
        k, total = max(sizes) + 1, sum(sizes.values())
        # A class without rows starts as if it had half of one.
        start = [log(max(sizes.get(c, 0), 0.5) / total) for c in range(k)]
        carried = rows.select("features", "y", *[F.lit(s).alias(f"m{c}") for c, s in enumerate(start)])
        scale = self.stepSize * (k - 1) / k
        trees: list[list[DecisionTreeRegressionModel]] = [[] for _ in range(k)]
        since = 0
        current = carried
        self.losses = [self._loss(current, k)] if self.track else []
        for turn in range(self.maxIter):
            shares = softmax([F.col(f"m{c}") for c in range(k)])
            needed = [c for c in range(k) if _source(c, k)[0] == c]
            with ThreadPool(min(self.parallelism, len(needed))) as pool:
                fitted = pool.map(inheritable_thread_target(spark)(lambda c: self._one(current, c, shares[c])), needed)  # noqa: B023
            for c, tree in zip(needed, fitted, strict=True):
                trees[c].append(tree)
            since += 1
            current = self._moved(spark, carried, trees, since, scale, k)
            if since == CARRY and turn + 1 < self.maxIter:
                carried = current = materialize(current, "margins")
                since = 0
            if self.track:
                self.losses.append(self._loss(current, k))
        models = [additive(spark, trees[of], sign * scale, f"__tree{c}", self.features) for c in range(k) for of, sign in [_source(c, k)]]
        return PipelineModel([*models, *softmax_stages(k, start)])

    def _one(self, rows: DataFrame, c: int, share: Column) -> DecisionTreeRegressionModel:
        h = F.greatest(share * (1 - share), F.lit(LEAST_WEIGHT))
        data = rows.select("features", ((F.when(F.col("y") == c, 1.0).otherwise(0.0) - share) / h).alias("label"), h.alias("h"))
        return DecisionTreeRegressor(weightCol="h", **self.tree).fit(data)

    def _moved(self, spark, carried: DataFrame, trees: list, since: int, scale: float, k: int) -> DataFrame:
        for c in range(k):
            of, sign = _source(c, k)
            carried = additive(spark, trees[of][-since:], sign * scale, f"t{c}", "features").transform(carried)
        return carried.select("features", "y", *[(F.col(f"m{c}") + F.col(f"t{c}")).alias(f"m{c}") for c in range(k)])

    def _loss(self, rows: DataFrame, k: int) -> float:
        shares = F.array(*softmax([F.col(f"m{c}") for c in range(k)]))
        return rows.agg(F.avg(-F.log(F.get(shares, F.col("y"))))).first()[0]
