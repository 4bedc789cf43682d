"""Whole-table profile in three variants."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lodestat.operators import profiling as p
from lodestat.operators.cleaning import clean_categoricals
from lodestat.operators.imputing import fit_imputer
from lodestat.operators.typing import split_num_cat

VARIANTS = ("base", "clean", "preprocessed")


def prepare_variant(df: DataFrame | None, variant: str) -> DataFrame:
    if variant not in VARIANTS:
        raise ValueError(f"unknown profile variant: {variant}")
    if df is None:
        raise FileNotFoundError(f"no table for the {variant} profile")
    if variant != "clean":
        return df
    roles = split_num_cat(df)
    cleaned = clean_categoricals(df, roles.categorical)
    return fit_imputer(cleaned, roles).transform(cleaned)


def profile(df: DataFrame | None, variant: str = "base") -> dict[str, DataFrame]:
    """Every table of the report by name; roles are decided once and passed on."""
    table = prepare_variant(df, variant)
    roles = split_num_cat(table)
    numeric = [c for c in roles.numeric if c in p.numeric_columns(table)]
    target = p.guess_target(table)
    parts = {
        "summary": p.table_summary(table, roles),
        "schema": p.schema_table(table),
        "nulls": p.null_profile(table),
        "cardinality": p.cardinality(table),
        "note": p.profile_note(table, roles, target),
    }
    if variant == "preprocessed":
        parts["correlation"] = p.correlation(table, p.correlation_columns(table))
        parts["variance"] = p.top_variance(table)
        for i, points in enumerate(p.component_scatter(table)):
            parts[f"scatter_{i + 1}"] = points
        return parts
    parts["correlation"] = p.correlation(table)
    parts["categories"] = p.category_counts(table, roles.categorical)
    if target:
        parts["target"] = p.target_distribution(table, target)
        parts["balance"] = p.target_balance(table, target)
    if numeric:
        parts["histogram"] = p.histogram(table, numeric)
        parts["box"] = p.box_stats(table, numeric)
        parts["numeric"] = p.numeric_notes(table, numeric)
    return parts
