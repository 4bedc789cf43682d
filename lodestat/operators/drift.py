"""Population stability, metric degradation and synthetic drift."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.functions.hashing import hash_choice, hash_order
from lodestat.operators.cleaning import text_columns
from lodestat.operators.counts import long_values
from lodestat.operators.fitted import join_fitted, quoted
from lodestat.operators.imputing import fit_modes
from lodestat.operators.ranking import SortKey, global_rank, hash_order_of
from lodestat.operators.sampling import exact_share, sample_ranks, within
from lodestat.operators.typing import small_cardinalities

# Share given to a category that one side lacks, and thresholds.
MISSING_SHARE = 1e-6
PSI_MODERATE, PSI_HIGH = 0.1, 0.25
DROP_AMBER, DROP_RED = 5, 10


def side_counts(
    baseline: DataFrame,
    current: DataFrame,
    columns: Sequence[str],
    null_as_category: bool = False,
    digest: bool = False,
) -> DataFrame:
    """``(column, value, n_e, n_a)`` with both sides counted in one grouping.

    The side is a flag on the cell, so there is no join between the two tables;
    a dominating category is summed up before the shuffle.  ``digest`` replaces
    long texts where only their identity matters.
    """
    cells = long_values(baseline, columns, [F.lit(0).alias("side")], digest).unionByName(
        long_values(current, columns, [F.lit(1).alias("side")], digest)
    )
    if not null_as_category:
        cells = cells.filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(
        F.count_if(F.col("side") == 0).alias("n_e"), F.count_if(F.col("side") == 1).alias("n_a")
    )


def _total(condition: Column, value: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def psi_of(counts: DataFrame, ids: Sequence[str] = ("column",)) -> DataFrame:
    """Stability index per group from category counts ``n_e`` and ``n_a``.

    The index ``sum (a - e) * ln(a / e)`` needs the totals of each side before
    the shares are known.  Written out over counts it is a formula of a few
    sums, so one aggregation gives totals and index together: no window over a
    column's categories and no join back to totals.  A category that one side
    lacks gets the fixed small share on that side, without rescaling.
    """
    e, a = F.col("n_e").cast("double"), F.col("n_a").cast("double")
    only_e = (F.col("n_e") > 0) & (F.col("n_a") == 0)
    sums = counts.groupBy(*ids).agg(
        F.sum(e).alias("te"),
        F.count_if(only_e).alias("ke"), _total(only_e, e).alias("oe"),
        _total(only_e, F.log(e)).alias("le"), _total(only_e, e * F.log(e)).alias("oel"),
        *_current_sums(e, a),
    )
    return sums.select(*ids, _psi_formula().alias("psi"))


def _current_sums(e: Column, a: Column) -> list[Column]:
    """Sums over the categories the current side has; ``e`` is 0 where the baseline lacks one."""
    both, only_a = (e > 0) & (a > 0), (a > 0) & (e == 0)
    gap = F.log(a / F.nullif(e, F.lit(0.0)))
    return [
        F.sum(a).alias("ta"),
        _total(both, e).alias("be"), _total(both, a).alias("ba"),
        _total(both, e * gap).alias("beg"), _total(both, a * gap).alias("bag"),
        F.count_if(only_a).alias("ka"), _total(only_a, a).alias("oa"),
        _total(only_a, F.log(a)).alias("la"), _total(only_a, a * F.log(a)).alias("oal"),
    ]


def _psi_formula() -> Column:
    zero = F.lit(0.0)
    te, ta = F.nullif(F.col("te"), zero), F.nullif(F.col("ta"), zero)
    small, log_small = F.lit(MISSING_SHARE), F.lit(math.log(MISSING_SHARE))
    # ln(a / e) of a shared category = ln(n_a / n_e) + ln(te / ta)
    shared = (F.col("bag") / ta - F.col("beg") / te) + F.log(te / ta) * (F.col("ba") / ta - F.col("be") / te)

    def one_sided(k: str, s: str, logs: str, weighted: str, t: Column) -> Column:
        # sum over categories of (small - share) * (ln small - ln share)
        ln_t = F.log(t)
        sum_ln_share = F.col(logs) - F.col(k) * ln_t
        sum_share_ln = (F.col(weighted) - F.col(s) * ln_t) / t
        terms = F.col(k) * small * log_small - small * sum_ln_share - log_small * F.col(s) / t + sum_share_ln
        return F.when(F.col(k) > 0, terms)

    # A side without any value has no terms of its own.
    return (
        F.coalesce(shared, zero)
        + F.coalesce(one_sided("ke", "oe", "le", "oel", te), zero)
        + F.coalesce(one_sided("ka", "oa", "la", "oal", ta), zero)
    )


def psi(
    baseline: DataFrame, current: DataFrame, columns: Sequence[str] | None = None, null_as_category: bool = False
) -> DataFrame:
    """``(column, psi)`` for the text columns; a column without values on both sides gives NULL."""
    names = list(columns) if columns is not None else [c for c in text_columns(baseline) if c in current.columns]
    found = psi_of(side_counts(baseline, current, names, null_as_category, digest=True))
    listed = baseline.sparkSession.createDataFrame([(c,) for c in names], "column string")
    return listed.join(F.broadcast(found), "column", "left")  # one row per schema column


def psi_status(index: Column) -> Column:
    size = F.abs(index)
    return F.when(size < PSI_MODERATE, "ok").when(size < PSI_HIGH, "moderate").when(size >= PSI_HIGH, "high")


def metric_drop(baseline: Column, current: Column) -> Column:
    """Loss in percent of the baseline, 0 when the baseline is 0."""
    return F.when(baseline > 0, (baseline - current) / F.nullif(baseline, F.lit(0.0)) * 100).otherwise(F.lit(0.0))


def alert_level(drop: Column) -> Column:
    """``unknown`` without a drop to judge."""
    return F.when(drop > DROP_RED, "red").when(drop > DROP_AMBER, "amber").when(drop.isNotNull(), "ok").otherwise("unknown")


def feature_shares(baseline: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Share of every category on both sides, 0 where a side lacks it."""
    counts = side_counts(baseline, current, columns)
    totals = counts.groupBy("column").agg(F.sum("n_e").alias("te"), F.sum("n_a").alias("ta"))
    # One row per column: the broadcast is as small as the schema.
    joined = join_fitted(counts, totals, "column")
    share = lambda n, t: F.when(F.col(t) > 0, F.col(n) / F.col(t)).otherwise(F.lit(0.0))
    return joined.select(
        "column", "value", share("n_e", "te").alias("share_baseline"), share("n_a", "ta").alias("share_current")
    )


def drift_record(metrics: DataFrame, indexes: DataFrame, filtered: bool) -> DataFrame:
    """One report row: metrics, drops, alert, index per column, and whether rows were filtered.

    ``metrics`` is one row with ``acc_baseline, acc_current, f1_baseline,
    f1_current``; ``indexes`` has one row per column.
    """
    entries = indexes.agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("column", "psi")))).alias("psi")
    )
    acc_drop = metric_drop(F.col("acc_baseline"), F.col("acc_current"))
    return metrics.select(
        "acc_baseline", "acc_current", "f1_baseline", "f1_current",
        acc_drop.alias("acc_drop"),
        metric_drop(F.col("f1_baseline"), F.col("f1_current")).alias("f1_drop"),
        alert_level(acc_drop).alias("alert"),
        entries.scalar().alias("psi"),
        F.lit(filtered).alias("filtered"),
    )


# ---------------------------------------------------------------- synthetic drift
@dataclass(frozen=True)
class Force:
    """Set a column to a preferred value, or to its mode, on a stretch of the picked rows."""

    column: str
    preferred: str
    start: float = 0.0
    end: float = 1.0


@dataclass(frozen=True)
class Draw:
    """Draw a column from few existing values on a stretch of the picked rows.

    ``preferred`` values are used where they exist; otherwise every existing
    value, or the ``smallest`` first ones when that is set.
    """

    column: str
    start: float
    end: float
    preferred: Sequence[str] = ()
    smallest: int | None = None


@dataclass(frozen=True)
class DriftPlan:
    target: str
    changes: Sequence[Force | Draw] = field(default_factory=tuple)
    share: float = 0.3


def _draw_values(df: DataFrame, change: Draw) -> list[str] | None:
    """The values to draw from; None when there are too many to list."""
    present_values = df.select(quoted(change.column).cast("string").alias("v")).filter(F.col("v").isNotNull())
    if change.smallest is not None:
        rows = present_values.distinct().orderBy("v").limit(change.smallest).collect()
        return [r["v"] for r in rows]
    liked = present_values.filter(F.col("v").isin(*change.preferred)).distinct().collect() if change.preferred else []
    if liked:
        return sorted(r["v"] for r in liked)
    few = small_cardinalities(df, [change.column], 200)
    if change.column not in few:
        return None
    return sorted(r["v"] for r in present_values.distinct().collect())


def inject_drift(df: DataFrame, key_cols: Sequence[str], plan: DriftPlan, seed: int | str = 42) -> DataFrame:
    """Perturb a fixed share of rows using values the table already has.

    The picked rows are the first rows of the seeded hash order; each change
    applies to a stretch of them.  Every column without a change of its own, the
    target and keys aside, is set to its mode on all picked rows.
    """
    order = hash_order_of(df, key_cols, seed)
    n_drift = math.floor(order.total() * exact_share(plan.share))
    bounds = sorted({n_drift, *[
        math.floor(n_drift * exact_share(x)) for c in plan.changes for x in (c.start, c.end)
    ]} - {0})
    at = dict(zip(bounds, sample_ranks(order, bounds), strict=True)) if bounds else {}

    def first(count: int) -> Column:
        return within(key_cols, seed, at.get(count))

    def stretch(change: Force | Draw) -> Column:
        low = math.floor(n_drift * exact_share(change.start))
        high = math.floor(n_drift * exact_share(change.end))
        return first(high) & ~first(low) if low else first(high)

    changed = {c.column: c for c in plan.changes if c.column in df.columns}
    others = [c for c in df.columns if c not in changed and c != plan.target and c not in key_cols]
    forced = [c.column for c in changed.values() if isinstance(c, Force)]
    filled = _columns_with_values(df, others + forced)
    modes = fit_modes(df, filled)
    out = []
    drawn_rows = df
    for name in df.columns:
        dtype: T.DataType = df.schema[name].dataType
        col = quoted(name)
        change = changed.get(name)
        if isinstance(change, Force) and name in modes:
            exists = df.filter(quoted(name) == change.preferred).limit(1).count() > 0
            value = F.lit(change.preferred if exists else modes[name]).cast(dtype)
            col = F.when(stretch(change), value).otherwise(col)
        elif isinstance(change, Draw):
            values = _draw_values(df, change)
            if values is None:  # the drawn rank finds its value by a join
                ranked = global_rank(df.select(col.cast("string").alias(f"__drawn_{name}")).filter(col.isNotNull()).distinct(),
                                     [SortKey(f"__drawn_{name}")], f"__place_{name}")
                pick = hash_choice(hash_order([*key_cols], f"{seed}|{name}"), ranked.count())
                drawn_rows = drawn_rows.withColumn(f"__pick_{name}", F.when(stretch(change), pick + 1))
                drawn_rows = drawn_rows.join(ranked, F.col(f"__pick_{name}") == quoted(f"__place_{name}"), "left")
                col = F.coalesce(quoted(f"__drawn_{name}").cast(dtype), col)
            elif values:
                pick = hash_choice(hash_order([*key_cols], f"{seed}|{name}"), len(values))
                drawn = F.element_at(F.array(*[F.lit(v) for v in values]), pick + 1).cast(dtype)
                col = F.when(stretch(change), drawn).otherwise(col)
        elif name in modes and name in others:
            col = F.when(first(n_drift), F.lit(modes[name]).cast(dtype)).otherwise(col)
        out.append(col.alias(name))
    return drawn_rows.select(*out)


def _columns_with_values(df: DataFrame, names: Sequence[str]) -> list[str]:
    if not names:
        return []
    row = df.agg(*[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(names)]).first()
    return [c for i, c in enumerate(names) if row[f"n{i}"]]


def windowed_psi(
    baseline: DataFrame, current: DataFrame, ts: str, columns: Sequence[str], width: str = "1 day"
) -> DataFrame:
    """Index per time window of ``current`` against the whole fixed baseline."""
    stamp = quoted(ts)
    if not isinstance(current.schema[ts].dataType, (T.TimestampType, T.TimestampNTZType)):
        stamp = stamp.cast("timestamp")
    window_start = F.window(stamp, width)["start"].alias("window_start")
    counted = (
        long_values(current, columns, [window_start], digest=True)
        .filter(F.col("value").isNotNull())
        .groupBy("window_start", "column", "value").agg(F.count(F.lit(1)).alias("n_a"))
    )
    return psi_against(baseline_counts(baseline, columns), counted)


def baseline_counts(baseline: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = long_values(baseline, columns, digest=True).filter(F.col("value").isNotNull())
    return cells.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n_e"))


def psi_against(reference: DataFrame, counted: DataFrame) -> DataFrame:
    """Index per window from baseline counts and windowed counts.

    Categories that a window lacks enter as the baseline's column sums minus the
    sums over the categories it has, so the baseline is never repeated per
    window.
    """
    e = F.col("n_e").cast("double")
    whole = reference.groupBy("column").agg(
        F.sum(e).alias("te"), F.count(F.lit(1)).alias("k_all"),
        F.sum(F.log(e)).alias("l_all"), F.sum(e * F.log(e)).alias("el_all"),
    )
    matched = join_fitted(counted, reference, ["column", "value"])
    known = F.coalesce(e, F.lit(0.0))
    has = F.col("n_e").isNotNull()
    sums = matched.groupBy("window_start", "column").agg(
        F.count_if(has).alias("k_in"), _total(has, F.log(e)).alias("l_in"), _total(has, e * F.log(e)).alias("el_in"),
        *_current_sums(known, F.col("n_a").cast("double")),
    )
    # ``whole`` has one row per schema column.
    joined = join_fitted(sums, whole, "column")
    completed = joined.select(
        "window_start", "column", "te", "ta", "be", "ba", "beg", "bag", "ka", "oa", "la", "oal",
        (F.col("k_all") - F.col("k_in")).alias("ke"), (F.col("te") - F.col("be")).alias("oe"),
        (F.col("l_all") - F.col("l_in")).alias("le"), (F.col("el_all") - F.col("el_in")).alias("oel"),
    )
    return completed.select("window_start", "column", _psi_formula().alias("psi"))


def status_table(indexes: DataFrame) -> DataFrame:
    return indexes.withColumn("status", psi_status(F.col("psi")))


def metrics_pair(baseline: Mapping[str, float], current: Mapping[str, float], df: DataFrame) -> DataFrame:
    row = (
        float(baseline["accuracy"]), float(current["accuracy"]),
        float(baseline["f1_weighted"]), float(current["f1_weighted"]),
    )
    return df.sparkSession.createDataFrame(
        [row], "acc_baseline double, acc_current double, f1_baseline double, f1_current double"
    )
