"""Scaling, one-hot encoding, principal components and label maps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, PCAModel, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.functions.numbers import present
from lodestat.functions.text import strip
from lodestat.operators.counts import value_counts, value_text
from lodestat.operators.fitted import join_fitted, quoted, settle
from lodestat.operators.ranking import SortKey, global_rank
from lodestat.operators.wide import Sketch, dense_rows, sparse_rows, spread_rows
from lodestat.session import materialize


# Unknown labels an error message spells out; it always says how many there are.
SHOWN_LABELS = 1000
# Columns up to which components are taken from the whole covariance matrix.
DENSE_WIDTH = 256
# Categories of a column that may become columns, vector slots or model labels; larger sets of labels go by ``label_map``.
CATEGORY_LIMIT = 10_000


# ---------------------------------------------------------------- scaling
@dataclass(frozen=True)
class Scaler:
    """``(x - mean) / std`` with the population deviation; a constant divides by 1."""

    moments: dict[str, tuple[float | None, float | None]]

    def column(self, df: DataFrame, name: str) -> Column:
        mean, std = self.moments[name]
        col = present(name, df.schema[name].dataType).cast("double")
        return (col - F.lit(mean)) / F.lit(std if std else 1.0)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select(
            *[self.column(df, c).alias(c) if c in self.moments else quoted(c) for c in df.columns]
        )


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> Scaler:
    if not columns:
        return Scaler({})
    stats = []
    for i, c in enumerate(columns):
        col = present(c, df.schema[c].dataType).cast("double")
        stats += [F.avg(col).alias(f"m{i}"), F.stddev_pop(col).alias(f"s{i}")]
    row = df.agg(*stats).first()
    return Scaler({c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)})


# ---------------------------------------------------------------- one-hot
def fit_categories(df: DataFrame, columns: Sequence[str], limit: int | None = CATEGORY_LIMIT) -> dict[str, list[str]]:
    """Sorted categories per column from one grouped count.

    The lists become columns, vector slots or model labels, so they are values of the
    plan.  A column with more than ``limit`` values is an error, found without fetching
    them; None lifts the limit.
    """
    if not columns:
        return {}
    values = value_counts(df, columns).filter(F.col("value").isNotNull()).select("column", "value")
    values, _ = settle(values, "categories")
    if limit is not None:
        sizes = values.groupBy("column").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit)
        if wide := sorted(r["column"] for r in sizes.collect()):  # one row per column
            raise ValueError(f"too many categories for one-hot encoding (limit {limit}): {wide}")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in values.toLocalIterator():
        found[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in found.items()}


def one_hot_select(df: DataFrame, categories: dict[str, list[str]]) -> list[Column]:
    """``<column>_<value>`` flags; an unseen or missing value gives all zeros."""
    flags = []
    for name, values in categories.items():
        shown = value_text(name, df.schema[name].dataType)
        flags += [shown.eqNullSafe(F.lit(v)).cast("double").alias(f"{name}_{v}") for v in values]
    return flags


def one_hot_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    categories = fit_categories(df, columns)
    return df.select(*[quoted(c) for c in keep], *one_hot_select(df, categories))


def one_hot_stages(
    df: DataFrame, columns: Sequence[str], numeric: Sequence[str] = (), output: str = "features",
    categories: dict[str, list[str]] | None = None,
) -> list:
    """Pipeline stages that turn categories into one sparse vector.

    The category lists are fitted here, with the size check, unless they are given;
    indexer and encoder are then pure projections.
    """
    stages: list = []
    inputs = list(numeric)
    categories = fit_categories(df, columns) if categories is None else categories
    columns = [c for c in columns if categories[c]]  # a column without any value has no slots
    if columns:
        names = [f"__ix{i}" for i in range(len(columns))]
        # One indexer per column: a joint one pads shorter label lists with nulls.
        stages += [
            StringIndexerModel.from_labels(categories[c], inputCol=c, outputCol=name, handleInvalid="keep")
            for c, name in zip(columns, names, strict=True)
        ]
        hot = [f"__hot{i}" for i in range(len(columns))]
        # The extra "unseen" index is the dropped last slot: it encodes as zeros.
        stages.append(OneHotEncoder(inputCols=names, outputCols=hot, dropLast=True, handleInvalid="error"))
        inputs += hot
    stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
    return stages


# ---------------------------------------------------------------- components
@dataclass(frozen=True)
class Components:
    """Centred principal components with a fixed sign."""

    inputs: list[str]
    means: list[float]
    loadings: list[list[float]]  # one list per component
    explained: list[float]

    def columns(self, source: Column | None = None) -> list[Column]:
        vector = source if source is not None else F.array(*[quoted(c).cast("double") for c in self.inputs])
        result = []
        for i, weights in enumerate(self.loadings):
            shift = sum(m * w for m, w in zip(self.means, weights, strict=True))
            products = F.zip_with(vector, F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
            dot = F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
            result.append((dot - F.lit(shift)).alias(f"PC{i + 1}"))
        return result


def fit_components(df: DataFrame, vector: Column, names: Sequence[str], k: int) -> Components:
    """Fit on an array column of doubles, all of one length.

    Up to ``DENSE_WIDTH`` columns the covariance is summed in the executors and taken apart on
    the driver (columns squared, then cubed); wider rows go through the randomised search,
    of which the driver holds ``k`` columns and a few more.
    """
    width = len(names)
    k = min(k, width)
    if width > DENSE_WIDTH:
        return _searched(dense_rows(spread_rows(df), vector, width), names, k)
    frame = df.select(vector.alias("v")).filter(F.col("v").isNotNull())
    means_row = frame.select(F.count_if(F.size("v") != width).alias("wrong"), *[F.avg(F.get("v", F.lit(i))).alias(f"m{i}") for i in range(width)]).first()
    if means_row["wrong"]:
        raise ValueError(f"{means_row['wrong']} vectors have another length than {width}")
    means = [float(means_row[f"m{i}"]) for i in range(width)]
    model: PCAModel = PCA(k=k, inputCol="x", outputCol="y").fit(frame.select(array_to_vector("v").alias("x")))
    matrix = model.pc.toArray()
    loadings = []
    for j in range(k):
        weights = matrix[:, j]
        top = max(range(width), key=lambda i: abs(weights[i]))
        loadings.append([float(w) for w in (weights if weights[top] > 0 else -weights)])
    return Components(list(names), means, loadings, [float(x) for x in model.explainedVariance.toArray()])


def _searched(rows: DataFrame, names: Sequence[str], k: int) -> Components:
    mean, directions, shares = Sketch(materialize(rows, "sparse"), len(names), k).fit()
    return Components(list(names), mean.tolist(), [directions[:, j].tolist() for j in range(directions.shape[1])], shares.tolist())


def fit_sparse_components(df: DataFrame, scaler: Scaler, numeric: Sequence[str], categories: dict[str, list[str]], k: int) -> Components:
    """Components of scaled numbers and one-hot flags without making the flags' columns: a row is its few set places."""
    flags, at = [], len(numeric)
    for name, values in categories.items():
        flags.append((value_text(name, df.schema[name].dataType), values, at))
        at += len(values)
    names = [*numeric, *[f"{c}_{v}" for c, values in categories.items() for v in values]]
    return _searched(sparse_rows(spread_rows(df), [scaler.column(df, c) for c in numeric], flags), names, min(k, len(names)))


# ---------------------------------------------------------------- feature tables
def preprocess_advanced(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    n_components: int = 3,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Scaled numerics, then one-hot columns, then components, in one projection."""
    if not numeric and not categorical:
        return df
    scaler = fit_scaler(df, numeric)
    categories = fit_categories(df, categorical)
    matrix = df.select(
        *[quoted(c) for c in keep],
        *[scaler.column(df, c).alias(c) for c in numeric],
        *one_hot_select(df, categories),
    )
    if n_components <= 0:
        return matrix
    names = [c for c in matrix.columns if c not in keep]
    vector = F.array(*[quoted(c).cast("double") for c in names])
    if len(names) > DENSE_WIDTH:
        components = fit_sparse_components(df, scaler, numeric, categories, n_components)
    else:
        components = fit_components(matrix, vector, names, n_components)
    return matrix.select("*", *components.columns())


def preprocess_for_training(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """Unscaled numerics, one-hot columns, then every other column untouched."""
    if not numeric and not categorical:
        return df
    rest = [c for c in df.columns if c not in numeric and c not in categorical]
    return df.select(
        *[quoted(c) for c in numeric],
        *one_hot_select(df, fit_categories(df, categorical)),
        *[quoted(c) for c in rest],
    )


# ---------------------------------------------------------------- labels
def label_map(df: DataFrame, label: str) -> DataFrame:
    """``(label, label_id)``: alphabetical codes from 0."""
    distinct = df.select(quoted(label).cast("string").alias("label")).filter(F.col("label").isNotNull()).distinct()
    return global_rank(distinct, [SortKey("label")], "place").select(
        "label", (F.col("place") - 1).cast("int").alias("label_id")
    )


def encode_labels(df: DataFrame, label: str, mapping: DataFrame, out: str = "label_id") -> DataFrame:
    """Add the code of each label; an unknown label gets NULL."""
    named = mapping.select(F.col("label").alias("__label"), F.col("label_id").alias(out))
    return join_fitted(df, named, quoted(label).cast("string") == F.col("__label")).drop("__label")


def decode_labels(df: DataFrame, id_col: str, mapping: DataFrame, out: str = "label") -> DataFrame:
    named = mapping.select(F.col("label_id").alias("__id"), F.col("label").alias(out))
    return join_fitted(df, named, quoted(id_col) == F.col("__id")).drop("__id")


def encode_ordinal(
    df: DataFrame, label: str, ordered: Sequence[str], out: str = "label_id", check: bool = True
) -> DataFrame:
    """Codes in the given order after trim and lower-case; unknown labels are an error."""
    shown = F.lower(strip(quoted(label).cast("string")))
    code = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(ordered))):
        code = F.when(shown == F.lit(name), F.lit(i)).otherwise(code)
    if check:
        unknown = (
            df.select(F.coalesce(shown, F.lit("none")).alias("v")).filter(~F.col("v").isin(*ordered))
            .distinct()
        )
        n = unknown.count()
        if n:
            names = [r["v"] for r in unknown.orderBy("v").limit(SHOWN_LABELS).collect()]
            more = f" and {n - len(names)} more" if n > len(names) else ""
            raise ValueError(f"{n} labels outside the ordinal scale: {names}{more}")
    return df.withColumn(out, code)


def feature_pipeline(
    df: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = (), estimator=None
) -> Pipeline:
    stages = one_hot_stages(df, categorical, numeric)
    return Pipeline(stages=[*stages, estimator] if estimator is not None else stages)


def feature_model(df: DataFrame, categorical: Sequence[str], numeric: Sequence[str] = ()) -> PipelineModel:
    return feature_pipeline(df, categorical, numeric).fit(df)


