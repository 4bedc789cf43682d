"""Support vectors with curved borders: feature maps in front of the linear learner.

``RbfMap`` draws random Fourier features, whose inner products approach the Gaussian kernel;
``PolynomialMap`` is a tensor sketch, whose inner products approach ``(gamma x.y) ** degree``.
Both are drawn from their seed alone, so a saved map holds a few numbers and no matrix, and
every task maps a row alike.  Rows are mapped a few at a time with one matrix product, so a
task's memory does not grow with its rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KERNELS = ("linear", "rbf", "poly")
#: Numbers in the vectors that a task maps at once and hands back; 8 bytes each.
BATCH_NUMBERS = 1 << 19


class _Map(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    gamma = Param(Params._dummy(), "gamma", "scale of the kernel", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "length of the input vectors", TypeConverters.toInt)
    components = Param(Params._dummy(), "components", "length of the output vectors", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, gamma=1.0, width=None, components=256, seed=888):
        super().__init__()
        self._setDefault(gamma=1.0, components=256, seed=888)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def mapper(self) -> Callable[[np.ndarray], np.ndarray]:
        raise NotImplementedError

    def _transform(self, dataset: DataFrame) -> DataFrame:
        mapped, at_once = self.mapper(), max(1, BATCH_NUMBERS // self.getOrDefault("components"))

        @F.pandas_udf("array<double>")
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            # Handed back in parts: a batch's vectors may be many times its rows' size.
            for batch in batches:
                for a in range(0, len(batch), at_once):
                    yield pd.Series(list(mapped(np.stack(batch.iloc[a: a + at_once].to_numpy()))), dtype=object)

        return dataset.withColumn(self.getOutputCol(), array_to_vector(apply(vector_to_array(self.getInputCol()))))


class RbfMap(_Map):
    """``sqrt(2 / D) cos(w.x + b)`` with normal ``w`` and uniform ``b``: the kernel ``exp(-gamma |x - y|^2)``."""

    def mapper(self):
        gamma, width, size = self.getOrDefault("gamma"), self.getOrDefault("width"), self.getOrDefault("components")
        rng = np.random.Generator(np.random.PCG64(self.getSeed()))
        w = rng.normal(size=(width, size)) * np.sqrt(2 * gamma)
        b = rng.uniform(0, 2 * np.pi, size)
        return lambda x: np.sqrt(2 / size) * np.cos(x @ w + b)


class PolynomialMap(_Map):
    """The tensor sketch of degree ``degree``: count sketches, multiplied as polynomials by Fourier transforms."""

    degree = Param(Params._dummy(), "degree", "degree of the kernel", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol=None, outputCol=None, gamma=1.0, width=None, components=256, seed=888, degree=3):
        given = self._input_kwargs  # the parent's constructor puts its own in their place
        super().__init__()
        self._setDefault(degree=3)
        self._set(**{k: v for k, v in given.items() if v is not None})

    def mapper(self):
        gamma, width, size = self.getOrDefault("gamma"), self.getOrDefault("width"), self.getOrDefault("components")
        rng = np.random.Generator(np.random.PCG64(self.getSeed()))
        sketches = []
        for _ in range(self.getOrDefault("degree")):
            sketch = np.zeros((width, size))
            sketch[np.arange(width), rng.integers(0, size, width)] = rng.choice([-1.0, 1.0], width)
            sketches.append(sketch * np.sqrt(gamma))

        def mapped(x: np.ndarray) -> np.ndarray:
            product = np.ones(size // 2 + 1, complex)
            for sketch in sketches:
                product = product * np.fft.rfft(x @ sketch, axis=1)
            return np.fft.irfft(product, size, axis=1)
        return mapped


def scale_of(rows: DataFrame, features: str, gamma: str | float) -> tuple[float, int, int]:
    """``(gamma, width, rows)``: ``auto`` is one over the width, ``scale`` also divides by the variance of all entries."""
    x = vector_to_array(features)
    sums = rows.select(F.size(x).alias("w"), F.aggregate(x, F.lit(0.0), lambda a, v: a + v).alias("s"),
                       F.aggregate(x, F.lit(0.0), lambda a, v: a + v * v).alias("q"))
    row = sums.agg(F.max("w").alias("w"), F.count(F.lit(1)).alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q")).first()
    if not row["n"]:
        raise ValueError("support vectors need rows")
    width, n = row["w"], row["n"]
    if gamma == "auto":
        return 1.0 / width, width, n
    if gamma == "scale":
        variance = row["q"] / (n * width) - (row["s"] / (n * width)) ** 2
        return 1.0 / (width * variance) if variance > 0 else 1.0, width, n
    return float(gamma), width, n


class KernelMargins(Estimator):
    """One margin per class after a feature map; ``C`` becomes a penalty per row."""

    def __init__(self, C: float = 1.0, kernel: str = "rbf", gamma: str | float = "scale", components: int = 256, degree: int = 3,
                 seed: int = 888, featuresCol: str = "features", labelCol: str = "label", **params) -> None:
        super().__init__()
        if kernel not in KERNELS:
            raise ValueError(f"unknown kernel: {kernel}")
        if C <= 0:
            raise ValueError("C must be positive")
        self.C, self.kernel, self.gamma, self.components, self.degree, self.seed = C, kernel, gamma, components, degree, seed
        self.features, self.label, self.params_of_learner = featuresCol, labelCol, params

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        gamma, width, n = scale_of(dataset, self.features, self.gamma)
        common = {"inputCol": self.features, "outputCol": "__mapped", "gamma": gamma, "width": width, "components": self.components, "seed": self.seed}
        stages = []
        if self.kernel == "rbf":
            stages = [RbfMap(**common)]
        elif self.kernel == "poly":
            stages = [PolynomialMap(degree=self.degree, **common)]
        mapped = stages[0].transform(dataset).drop(self.features) if stages else dataset
        learner = LinearSVC(regParam=1.0 / (self.C * n), **self.params_of_learner)
        margins = OneVsRest(classifier=learner, featuresCol="__mapped" if stages else self.features, labelCol=self.label)
        return PipelineModel([*stages, margins.fit(mapped)])
