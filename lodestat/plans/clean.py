"""From a raw text table to the clean interim table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestat.operators.cleaning import JUNK_COLUMN, clean_categoricals, drop_if_present
from lodestat.operators.typing import CATEGORY_MAX, basic_typing, split_num_cat
from lodestat.sources.zones import INTERIM_NAME, Zones


def make_clean(df: DataFrame, null_token: str | None = None, max_categories: int = CATEGORY_MAX) -> DataFrame:
    """Type every column, normalise the categorical ones, drop the junk column.

    Two small jobs decide the types and the roles; the result itself is one
    projection of the input.  Nothing is imputed.  ``null_token="none"`` writes
    missing categories as that text.
    """
    typed = basic_typing(df)
    roles = split_num_cat(typed, max_categories)
    return drop_if_present(clean_categoricals(typed, roles.categorical, null_token), JUNK_COLUMN)


def run_clean(spark: SparkSession, zones: Zones, raw: DataFrame, name: str = INTERIM_NAME) -> str:
    return zones.save_interim(make_clean(raw, "none"), name)
