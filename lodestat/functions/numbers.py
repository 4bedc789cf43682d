"""Numeric expressions shared by several operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_floating(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.FloatType, T.DoubleType))


def is_numeric(dtype: T.DataType) -> bool:
    """Numeric in the sense of column roles: numbers and booleans."""
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN read as missing."""
    col = F.col(f"`{name}`")
    return F.when(~F.isnan(col), col) if is_floating(dtype) else col


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` and 0 where the denominator is 0."""
    return F.when(denominator == 0, F.lit(0.0)).otherwise(
        numerator.cast("double") / F.when(denominator != 0, denominator)
    )


def corrected_skewness(col: Column) -> Column:
    """Bias-corrected sample skewness; NULL below three values, 0 when constant."""
    n = F.count(col)
    spread = F.stddev_pop(col)
    return F.when(n < 3, F.lit(None).cast("double")).when(spread == 0, F.lit(0.0)).otherwise(
        F.skewness(col) * F.sqrt(n * (n - F.lit(1))) / F.nullif(n - F.lit(2), F.lit(0))
    )


def half_even_class(col: Column, n_classes: int) -> Column:
    """Round half to even and clip to ``0 .. n_classes - 1``."""
    return F.least(F.greatest(F.rint(col), F.lit(0.0)), F.lit(float(n_classes - 1))).cast("int")
