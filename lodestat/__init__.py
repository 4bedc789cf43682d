"""Profiling, cleaning, scoring and drift monitoring of tabular data on Spark.

Every operator takes DataFrames and returns DataFrames.  Operators that fit
something (roles, medians, category lists, split thresholds) run one or a few
small jobs and return plain values; applying them is a narrow projection.
"""

__version__ = "0.1.0"
