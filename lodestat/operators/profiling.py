"""Table profile: the numbers behind every chart and note of a data report."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.hashing import row_digest
from lodestat.functions.numbers import corrected_skewness, present
from lodestat.operators.counts import position_of, value_counts, value_text
from lodestat.operators.fitted import quoted
from lodestat.operators.ranking import exact_quantiles
from lodestat.operators.typing import Roles, small_cardinalities, small_value_counts, split_num_cat
from lodestat.operators.wide import correlations

# Names taken as the target, in order of preference.
TARGET_NAMES = ("Performance", "performance", "target", "label", "Target", "Label")
# Class counts of a guessed target, chart limits and verdict bounds.
TARGET_MIN, TARGET_MAX = 2, 10
MAX_BARS = 20
NOTE_VALUES = 15
BINS = 30
BALANCED_BELOW = 0.6
HIGH_NULL_PERCENT = 10
SYMMETRIC_BELOW = 0.3
VARIANCE_TOP = 30
CORRELATION_MAX = 60


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def _value(df: DataFrame, name: str) -> Column:
    return present(name, df.schema[name].dataType)


def _fold(row: DataFrame, entries: Sequence[tuple[str, Sequence[Column]]], names: Sequence[str]) -> DataFrame:
    """Turn one wide statistics row into one row per column."""
    structs = [
        F.struct(F.lit(i).alias("position"), F.lit(name).alias("column"),
                 *[c.alias(n) for c, n in zip(cells, names, strict=True)])
        for i, (name, cells) in enumerate(entries)
    ]
    return row.select(F.inline(F.array(*structs)))


# ---------------------------------------------------------------- table level
def schema_table(df: DataFrame) -> DataFrame:
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, dtype string")


def head(df: DataFrame, key_cols: Sequence[str], n: int = 5) -> DataFrame:
    return df.orderBy(*[quoted(c) for c in key_cols]).limit(n)


def guess_target(df: DataFrame) -> str | None:
    """A column with a known name, else the first one with 2 to 10 distinct values."""
    for name in TARGET_NAMES:
        if name in df.columns:
            return name
    few = small_cardinalities(df, df.columns, TARGET_MAX)
    return next((c for c in df.columns if c in few and few[c][0] >= TARGET_MIN), None)


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first occurrence, NULL equal to NULL.

    Rows are grouped by a digest, so the shuffle carries one short key per row
    and not the row; a row repeated a billion times is one partial count.
    """
    return (
        df.groupBy(row_digest(df.schema, columns).alias("d")).agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def null_profile(df: DataFrame) -> DataFrame:
    """``(position, column, n_null, null_percent)`` in one pass."""
    counters = [F.count(F.lit(1)).alias("n")]
    counters += [F.count(_value(df, c)).alias(f"c{i}") for i, c in enumerate(df.columns)]
    row = df.agg(*counters)
    entries = []
    for i, name in enumerate(df.columns):
        missing = F.col("n") - F.col(f"c{i}")
        share = F.when(F.col("n") > 0, missing * 100 / F.nullif(F.col("n"), F.lit(0))).otherwise(F.lit(0.0))
        entries.append((name, [missing, share]))
    return _fold(row, entries, ["n_null", "null_percent"])


def missing_note(nulls: DataFrame) -> DataFrame:
    """The three columns with most missing values as a sentence."""
    worst = nulls.orderBy(F.col("null_percent").desc(), "position").limit(3)
    shown = F.format_string("%s (%.1f%%)", "column", "null_percent")
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("null_percent")).alias("k"), "position", shown.alias("t"))))
    return worst.agg(F.max("null_percent").alias("top"), ordered.alias("items")).select(
        F.when(F.coalesce("top", F.lit(0.0)) == 0, "No se detectaron valores nulos.").otherwise(
            F.concat(F.lit("Columnas con mayor porcentaje de nulos: "),
                     F.array_join(F.transform("items", lambda x: x["t"]), ", "), F.lit("."))
        ).alias("note")
    )


def cardinality(df: DataFrame, columns: Sequence[str] | None = None, approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column.

    Exact by default: one grouped count of all cells, long texts as digests.
    ``approximate`` uses one sketch per column in a single pass without a
    shuffle of values.
    """
    names = list(columns) if columns is not None else df.columns
    if approximate:
        row = df.agg(*[F.approx_count_distinct(_value(df, c)).alias(f"d{i}") for i, c in enumerate(names)])
        return _fold(row, [(c, [F.col(f"d{i}")]) for i, c in enumerate(names)], ["n_distinct"])
    counted = value_counts(df, names, digest=True).groupBy("column").agg(F.count("value").alias("n_distinct"))
    listed = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(names)], "position int, column string")
    # One row per schema column on both sides.
    return listed.join(F.broadcast(counted), "column", "left").select(
        "position", "column", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct")
    )


def table_bytes(df: DataFrame) -> Column:
    """Data size: text bytes plus the fixed width of other types, for use in ``agg``."""
    # Bytes per value.
    widths = {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}
    parts: list[Column] = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(quoted(f.name)), F.lit(0)).cast("bigint"))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(value_text(f.name, f.dataType)), F.lit(0)).cast("bigint"))
        else:
            parts.append(F.lit(widths.get(f.dataType.simpleString(), 8)).cast("bigint"))
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return F.coalesce(F.sum(total), F.lit(0))


def table_summary(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Size, roles, missing share, duplicates and mean cardinality in one row."""
    roles = roles or split_num_cat(df)
    width = len(df.columns)
    filled = F.lit(0)
    for c in df.columns:
        filled = filled + _value(df, c).isNotNull().cast("int")
    distinct = cardinality(df).agg(F.avg("n_distinct"))
    sums = df.agg(
        F.count(F.lit(1)).alias("rows"), table_bytes(df).alias("bytes"),
        F.coalesce(F.sum(filled), F.lit(0)).alias("filled"),
    )
    cells = F.col("rows") * width
    return sums.select(
        "rows",
        F.lit(width).alias("cols"),
        F.lit(len(roles.numeric)).alias("n_numeric"),
        F.lit(len(roles.categorical)).alias("n_categorical"),
        # Every column has as many rows, so the mean of shares is the share of all cells.
        F.bround(F.when(cells > 0, (cells - F.col("filled")) * 100 / F.nullif(cells, F.lit(0))).otherwise(F.lit(0.0)), 2)
        .alias("null_percent_mean"),
        duplicate_rows(df).scalar().alias("duplicates"),
        F.bround(F.col("bytes") / F.lit(1e6), 2).alias("size_mb"),
        F.bround(distinct.scalar(), 2).alias("cardinality_mean"),
    )


def profile_note(df: DataFrame, roles: Roles | None = None, target: str | None = None) -> DataFrame:
    """The global sentence of the report, from the summary row."""
    summary = table_summary(df, roles)
    target = target or guess_target(df)
    high = null_profile(df).filter(F.col("null_percent") > HIGH_NULL_PERCENT).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(
            F.struct((-F.col("null_percent")).alias("k"), "position", "column"))), lambda x: x["column"]), ", ")
    )
    # Wording of the report.
    target_text = f"Target estimado: {target}." if target else "No se detectó target automáticamente."
    named = summary.withColumn("high", high.scalar())
    nulls_text = F.when(
        F.col("high") == "", F.format_string("%s%% nulos promedio; sin columnas con >10%% nulos.", _plain("null_percent_mean"))
    ).otherwise(
        F.format_string("%s%% nulos promedio; columnas con >10%% nulos: %s.", _plain("null_percent_mean"), F.col("high"))
    )
    return named.select(F.format_string(
        "El dataset contiene %d filas y %d columnas (%d numéricas, %d categóricas). %s %s "
        "Duplicados: %d. Memoria estimada: %s MB. Cardinalidad media por columna: %s.",
        F.col("rows"), F.col("cols"), F.col("n_numeric"), F.col("n_categorical"), F.lit(target_text), nulls_text,
        F.col("duplicates"), _plain("size_mb"), _plain("cardinality_mean"),
    ).alias("note"))


def _plain(name: str) -> Column:
    """Two-decimal number without trailing zeros, one decimal at least."""
    fixed = F.format_string("%.2f", F.col(name))
    return F.regexp_replace(fixed, "0$", "")


# ---------------------------------------------------------------- target
def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and percent per class, a missing class included."""
    counts = df.groupBy(quoted(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    # The total reads the same exchanged counts again, not the table.
    total = counts.agg(F.sum("n")).scalar()
    return counts.select("class", "n", F.bround(F.col("n") * 100 / total, 2).alias("percent"))


def target_balance(df: DataFrame, target: str) -> DataFrame:
    """Balanced when the largest class holds less than the fixed share."""
    counts = df.groupBy(quoted(target).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    sums = counts.agg(F.max("n").alias("top"), F.sum("n").alias("total"))
    share = F.col("top") / F.col("total")
    return sums.select(share.alias("top_share"), (share < BALANCED_BELOW).alias("balanced"))


# ---------------------------------------------------------------- categories
def category_counts(
    df: DataFrame, columns: Sequence[str] | None = None, max_values: int = MAX_BARS
) -> DataFrame:
    """Counts per value of the categorical columns with 2 to ``max_values`` values, NULL included.

    Columns beyond the limit are found by the screening pass and never counted;
    the others are counted in one pass.
    """
    names = list(columns) if columns is not None else split_num_cat(df).categorical
    counts, found = small_value_counts(df, names, max_values)
    shown = [c for c in names if c in found and 2 <= found[c][0] + (found[c][1] > 0) <= max_values]
    return counts.filter(F.col("column").isin(shown))


def category_notes(counts: DataFrame) -> DataFrame:
    """Number of values, the first 15 by frequency, and the top value with its percent.

    ``counts`` comes from :func:`category_counts`, so a column has few rows.
    """
    # NULL reads as the text "nan" in the sentence; ties go to the smaller value.
    shown = F.coalesce("value", F.lit("nan"))
    items = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), shown.alias("v"))))
    per_column = counts.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("total"), items.alias("items")
    )
    listed = F.array_join(F.transform(F.slice("items", 1, NOTE_VALUES), lambda x: x["v"]), ", ")
    return per_column.select(
        "column", "n_values",
        F.when(F.col("n_values") > NOTE_VALUES, F.concat(listed, F.lit(", ..."))).otherwise(listed).alias("first_values"),
        F.col("items")[0]["v"].alias("top_value"),
        F.bround(-F.col("items")[0]["k"] * 100 / F.col("total"), 1).alias("top_percent"),
    )


# ---------------------------------------------------------------- numbers
def histogram(df: DataFrame, columns: Sequence[str], bins: int = BINS) -> DataFrame:
    """Equal-width bins per column: ``(column, bin, low, high, n)``; empty bins left out."""
    if not columns:
        raise ValueError("histogram needs at least one numeric column")
    limits = df.agg(*[
        f(_value(df, c)).cast("double").alias(f"{kind}{i}")
        for i, c in enumerate(columns) for kind, f in (("lo", F.min), ("hi", F.max))
    ]).first()
    cells, edges = [], []
    for i, c in enumerate(columns):
        low, high = limits[f"lo{i}"], limits[f"hi{i}"]
        if low is None:
            continue
        width = (high - low) / bins
        col = _value(df, c).cast("double")
        place = F.least(F.floor((col - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int") if width else F.when(
            col.isNotNull(), F.lit(0))
        cells.append(place.alias(c))
        edges.append((c, low, width))
    if not cells:
        return df.sparkSession.createDataFrame([], "column string, bin int, low double, high double, n bigint")
    counted = (
        df.select(*cells).unpivot([], [quoted(c) for c, _, _ in edges], "column", "bin")
        .filter(F.col("bin").isNotNull()).groupBy("column", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    at = position_of([c for c, _, _ in edges], F.col("column")) + 1
    low = F.element_at(F.array(*[F.lit(x) for _, x, _ in edges]), at)
    width = F.element_at(F.array(*[F.lit(x) for _, _, x in edges]), at)
    return counted.select(
        "column", "bin", (low + F.col("bin") * width).alias("low"), (low + (F.col("bin") + 1) * width).alias("high"), "n"
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and rows outside them."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75])
    stats, entries = [], []
    for i, c in enumerate(columns):
        q = quartiles[c]
        col = _value(df, c).cast("double")
        if q[0.5] is None:
            entries.append((c, [F.lit(None).cast("double")] * 5 + [F.lit(0).cast("bigint")]))
            continue
        reach = 1.5 * (q[0.75] - q[0.25])
        inside = (col >= F.lit(q[0.25] - reach)) & (col <= F.lit(q[0.75] + reach))
        stats += [
            F.min(F.when(inside, col)).alias(f"lo{i}"), F.max(F.when(inside, col)).alias(f"hi{i}"),
            F.count_if(~inside).alias(f"out{i}"),
        ]
        entries.append((c, [F.lit(q[0.25]), F.lit(q[0.5]), F.lit(q[0.75]), F.col(f"lo{i}"), F.col(f"hi{i}"),
                            F.col(f"out{i}")]))
    row = df.agg(*stats) if stats else df.sparkSession.range(1)
    return _fold(row, entries, ["q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"])


def numeric_notes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, population deviation, corrected skewness and its verdict, in one pass."""
    stats, entries = [], []
    for i, c in enumerate(columns):
        col = _value(df, c).cast("double")
        stats += [F.count(col).alias(f"n{i}"), F.avg(col).alias(f"m{i}"), F.stddev_pop(col).alias(f"s{i}"),
                  corrected_skewness(col).alias(f"g{i}")]
        # A missing skewness counts as 0.
        skew = F.coalesce(F.col(f"g{i}"), F.lit(0.0))
        verdict = F.when(F.col(f"n{i}") == 0, "empty").when(F.abs(skew) < SYMMETRIC_BELOW, "symmetric").when(
            skew > 0, "right").otherwise("left")
        entries.append((c, [F.col(f"n{i}"), F.col(f"m{i}"), F.col(f"s{i}"), F.col(f"g{i}"), verdict]))
    return _fold(df.agg(*stats), entries, ["n", "mean", "sd", "skew", "shape"])


#: Columns up to which every pair is an aggregate of its own.
PAIRED_COLUMNS = 40


def correlation(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(i, j, column_a, column_b, r)`` for every pair ``i < j``; missing values drop pairwise.

    A first pass finds means and gaps.  Pairs of complete columns then need one
    sum of centred products each, which stays small generated code; pairs with gaps
    use the correlation aggregate.  Beyond ``PAIRED_COLUMNS`` columns that would be
    thousands of aggregates: blocks of columns are multiplied instead, in a plan of a
    few steps.  A constant column has no correlation.  Fewer than two columns give no rows.
    """
    names = list(columns) if columns is not None else numeric_columns(df)
    if len(names) > PAIRED_COLUMNS:
        values = df.select(*[_value(df, c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
        shown = F.array(*[F.lit(c) for c in names])
        return correlations(values).select(
            "i", "j", F.get(shown, F.col("i")).alias("column_a"), F.get(shown, F.col("j")).alias("column_b"), "r")
    pairs = list(combinations(range(len(names)), 2))
    schema = "i int, j int, column_a string, column_b string, r double"
    if not pairs:
        return df.sparkSession.createDataFrame([], schema)
    wide = df.select(*[_value(df, c).cast("double").alias(f"x{i}") for i, c in enumerate(names)])
    first = wide.agg(F.count(F.lit(1)).alias("n"), *[
        f(F.col(f"x{i}")).alias(f"{kind}{i}") for i in range(len(names))
        for kind, f in (("count", F.count), ("mean", F.avg), ("low", F.min), ("high", F.max))
    ]).first()
    n = first["n"]
    complete = [first[f"count{i}"] == n for i in range(len(names))]
    constant = [first[f"low{i}"] == first[f"high{i}"] for i in range(len(names))]
    centred = wide.select(*[
        (F.col(f"x{i}") - F.lit(first[f"mean{i}"])).alias(f"d{i}") if complete[i] else F.col(f"x{i}").alias(f"d{i}")
        for i in range(len(names))
    ])
    sums = [F.lit(0).alias("none")]
    for i in range(len(names)):
        if complete[i]:
            sums += [F.sum(f"d{i}").alias(f"s{i}"), F.sum(F.col(f"d{i}") * F.col(f"d{i}")).alias(f"q{i}")]
    for i, j in pairs:
        both = F.sum(F.col(f"d{i}") * F.col(f"d{j}")) if complete[i] and complete[j] else F.corr(f"d{i}", f"d{j}")
        sums.append(both.alias(f"p{i}_{j}"))

    def spread(i: int) -> Column:
        # The rest of the mean's rounding is taken out as well.
        return F.col(f"q{i}") - F.col(f"s{i}") * F.col(f"s{i}") / F.lit(n)

    def r(i: int, j: int) -> Column:
        if constant[i] or constant[j]:
            return F.lit(None).cast("double")
        if not (complete[i] and complete[j]):
            return F.col(f"p{i}_{j}")
        cross = F.col(f"p{i}_{j}") - F.col(f"s{i}") * F.col(f"s{j}") / F.lit(n)
        return F.greatest(F.least(cross / F.sqrt(spread(i) * spread(j)), F.lit(1.0)), F.lit(-1.0))

    structs = [
        F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.lit(names[i]).alias("column_a"),
                 F.lit(names[j]).alias("column_b"), r(i, j).alias("r"))
        for i, j in pairs
    ]
    return centred.agg(*sums).select(F.inline(F.array(*structs)))


def correlation_matrix(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The full square: both orders of every pair and 1 on the diagonal."""
    names = list(columns) if columns is not None else numeric_columns(df)
    half = correlation(df, names).select("column_a", "column_b", "r")
    cells = half.select(F.inline(F.array(
        F.struct("column_a", "column_b", "r"),
        F.struct(F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "r"),
    )))
    diagonal = df.sparkSession.createDataFrame(
        [(c, c, 1.0) for c in names], "column_a string, column_b string, r double")
    return cells.unionByName(diagonal) if len(names) > 1 else diagonal.limit(0)


def top_correlation(pairs: DataFrame) -> DataFrame:
    """The pair with the largest ``|r|``, the first one on ties; no row when all are 0."""
    return (
        pairs.filter(F.abs("r") > 0).orderBy(F.abs("r").desc(), "i", "j").limit(1)
        .select("column_a", "column_b", F.abs("r").alias("abs_r"))
    )


def variances(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    names = list(columns) if columns is not None else numeric_columns(df)
    row = df.agg(*[F.var_samp(_value(df, c).cast("double")).alias(f"v{i}") for i, c in enumerate(names)])
    return _fold(row, [(c, [F.col(f"v{i}")]) for i, c in enumerate(names)], ["variance"])


def top_variance(df: DataFrame, columns: Sequence[str] | None = None, k: int = VARIANCE_TOP) -> DataFrame:
    return variances(df, columns).orderBy(F.col("variance").desc_nulls_last(), "position").limit(k)


def correlation_columns(df: DataFrame, max_cols: int = CORRELATION_MAX) -> list[str]:
    """Numeric columns for a wide correlation: components and the junk column left out.

    When too many are left, those with the largest variance stay.
    """
    names = numeric_columns(df)
    kept = [c for c in names if not c.lower().startswith("pc") and "mixed_type_col" not in c.lower()] or names
    if len(kept) <= max_cols:
        return kept
    return [r["column"] for r in top_variance(df, kept, max_cols).collect()]


def component_columns(columns: Sequence[str]) -> dict[int, str]:
    """Columns that hold the first three components, by name."""
    found = {}
    for i in (1, 2, 3):
        name = next((c for c in columns if c.lower() in (f"pc{i}", f"pca_{i}")), None)
        if name:
            found[i] = name
    return found


def component_scatter(df: DataFrame) -> list[DataFrame]:
    """Point tables of the first component against the second and the third."""
    pcs = component_columns(df.columns)
    return [
        df.select(quoted(pcs[1]).alias("x"), quoted(pcs[j]).alias("y"), F.lit(pcs[1]).alias("x_name"),
                  F.lit(pcs[j]).alias("y_name"))
        for j in (2, 3) if 1 in pcs and j in pcs
    ]


def null_map(df: DataFrame, key_cols: Sequence[str], buckets: int = 64) -> DataFrame:
    """Missing cells per key bucket and column.

    A map of single cells grows with the table; for display the rows are folded
    into a fixed number of buckets by key hash.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(F.concat_ws("|", *[quoted(c).cast("string") for c in key_cols])), 1, 8),
                           16, 10).cast("bigint"), F.lit(buckets)).cast("int")
    shown = [c for c in df.columns if c not in key_cols]
    row = df.groupBy(bucket.alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(_value(df, c)).alias(f"c{i}") for i, c in enumerate(shown)]
    )
    cells = [F.struct(F.lit(c).alias("column"), (F.col("n") - F.col(f"c{i}")).alias("n_null"), "n")
             for i, c in enumerate(shown)]
    return row.select("bucket", F.inline(F.array(*cells)))


def null_cells(df: DataFrame, key_cols: Sequence[str]) -> DataFrame:
    """The unfolded map: 1 for a missing cell, 0 otherwise, one column per column."""
    return df.select(*[quoted(c) for c in key_cols], *[
        _value(df, c).isNull().cast("int").alias(c) for c in df.columns if c not in key_cols
    ])


def size_comparison(modified: DataFrame, original: DataFrame) -> DataFrame:
    """Rows and columns of two tables as ``(metric, value)``."""
    counted = modified.agg(F.count(F.lit(1)).alias("rows_modified")).select(
        "rows_modified", F.lit(len(modified.columns)).cast("bigint").alias("cols_modified"),
        original.agg(F.count(F.lit(1))).scalar().alias("rows_original"),
        F.lit(len(original.columns)).cast("bigint").alias("cols_original"),
    )
    return counted.unpivot([], counted.columns, "metric", "value")
