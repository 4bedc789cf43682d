"""Exact ranks and order statistics without sending a table through one task."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestat.functions.hashing import hash_order
from lodestat.functions.numbers import present
from lodestat.operators.fitted import PIN_ROWS, join_fitted, pin, quoted, settle
from lodestat.session import materialize


@dataclass(frozen=True)
class SortKey:
    name: str
    descending: bool = False

    def ordering(self) -> Column:
        col = quoted(self.name)
        return col.desc_nulls_last() if self.descending else col.asc_nulls_last()


# Position within a partition in the generated row ids: the low 33 bits.
_POSITION = (1 << 33) - 1


def global_rank(
    df: DataFrame, keys: Sequence[SortKey], rank_col: str = "rank", small_rows: int = PIN_ROWS
) -> DataFrame:
    """Add the 1-based position of every row in a total order.

    A small table is ranked as it is.  Otherwise the rows are range-partitioned
    on the full sort key, ties included, so equal leading values spread over
    several tasks, and sorted within each range.  They are written once with
    range and position; adding the sizes of the ranges before it completes the
    rank.  The rows are shuffled once and no task sees more than its range.
    """
    order = [k.ordering() for k in keys]
    table, small = pin(df, small_rows)
    if small:
        return table.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = materialize(
        df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn(
            "__place", F.monotonically_increasing_id()),
        "ranked",
    ).withColumn("__range", F.shiftright("__place", 33))
    # One row per range: a window over at most as many rows as partitions.
    sizes = placed.groupBy("__range").agg(F.count(F.lit(1)).alias("n"))
    offsets = sizes.select("__range", F.coalesce(
        F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    ).alias("__before"))
    joined = join_fitted(placed, offsets, "__range", "inner")
    rank = F.col("__before") + F.col("__place").bitwiseAND(F.lit(_POSITION)) + 1
    return joined.select(*[quoted(c) for c in df.columns], rank.alias(rank_col))


def rank_within(
    df: DataFrame, group: str, keys: Sequence[SortKey], rank_col: str = "rank", small_rows: int = PIN_ROWS
) -> DataFrame:
    """Rank inside each group: the global rank by group and keys, counted from the group's first row.

    A group with most of the rows is ranked by several tasks.
    """
    ranked = global_rank(df, [SortKey(group), *keys], "__global", small_rows)
    first = ranked.groupBy(quoted(group).alias("__group")).agg(F.min("__global").alias("__first"))
    joined = join_fitted(ranked, first, F.equal_null(quoted(group), F.col("__group")), "inner")
    return joined.select(*[quoted(c) for c in df.columns], (F.col("__global") - F.col("__first") + 1).alias(rank_col))


# Leading hash digits counted first, and digits added while a prefix holds more
# rows than one task should rank.
FIRST_DIGITS, MORE_DIGITS, RANKED_ROWS = 3, 4, 1_000_000
HASH_DIGITS = 32
SHARED_KEY = "rows with one key lie on both sides of the wanted number of rows: give key columns that identify a row"


@dataclass(frozen=True)
class HashOrder:
    """The seeded hash order of a table's rows, optionally per group.

    ``prefixes`` holds ``(grp, prefix, n)``: rows per leading hash digits, at
    most 4,096 per group whatever the size of the group.
    """

    hashed: DataFrame
    prefixes: DataFrame

    def sizes(self) -> DataFrame:
        """``(grp, n)``: rows per group, summed from the prefixes."""
        return self.prefixes.groupBy("grp").agg(F.sum("n").alias("n"))

    def total(self) -> int:
        return self.prefixes.agg(F.sum("n")).first()[0] or 0


def hash_order_of(
    df: DataFrame, key_cols: Sequence[str], seed: int | str, group_col: str | None = None
) -> HashOrder:
    group = quoted(group_col) if group_col else F.lit(0)
    hashed = df.select(group.alias("grp"), hash_order(key_cols, seed).alias("h"))
    counted = hashed.groupBy("grp", F.substring("h", 1, FIRST_DIGITS).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    return HashOrder(hashed, materialize(counted, "prefixes"))


def hash_thresholds(order: HashOrder, targets: DataFrame, ranked_rows: int = RANKED_ROWS) -> DataFrame:
    """Find which hash value stands at given ranks of the hash order.

    ``targets`` holds ``(grp, slot, rank)``: per group (the constant 0 without
    groups) the wanted 1-based ranks.  Returns ``(grp, slot, threshold)``.  The
    prefix that holds each rank is known from the prefix sizes; only its rows
    are ranked, after longer prefixes while it holds too many.  So no task ranks
    a whole group, and taking the first ``rank`` rows of a group afterwards is
    the comparison ``hash <= threshold``.
    """
    wanted = targets.filter(F.col("rank") >= 1).select(
        F.col("grp").alias("g"), "slot", "rank", F.lit("").alias("parent"))
    digits = FIRST_DIGITS
    counted = order.prefixes.withColumn("parent", F.lit(""))
    while True:
        holding, small = settle(_holding(counted, wanted), "holding")
        side = F.broadcast(holding) if small else holding
        # Null-safe on both keys: the hash is never null and needs no null filter.
        here = F.equal_null(F.col("grp"), F.col("g")) & F.equal_null(F.substring("h", 1, digits), F.col("prefix"))
        near = order.hashed.join(side, here, "left_semi")
        # Beyond all digits a prefix is one hash, and its rows share a key.
        if digits >= HASH_DIGITS or not holding.filter(F.col("n") > ranked_rows).limit(1).count():
            break
        counted = near.groupBy(
            "grp", F.substring("h", 1, digits).alias("parent"),
            F.substring("h", 1, digits + MORE_DIGITS).alias("prefix"),
        ).agg(F.count(F.lit(1)).alias("n"))
        wanted = holding.select("g", "slot", "rank", F.col("prefix").alias("parent"))
        digits = min(digits + MORE_DIGITS, HASH_DIGITS)
    # Equal hashes are counted first, so a key with many rows is one row here.
    alike = near.groupBy("grp", F.substring("h", 1, digits).alias("at"), "h").agg(F.count(F.lit(1)).alias("same"))
    through = F.sum("same").over(Window.partitionBy("grp", "at").orderBy("h"))
    ranked = alike.withColumn("through", through)
    place = (
        F.equal_null(F.col("grp"), F.col("g")) & (F.col("at") == F.col("prefix"))
        & (F.col("rank") <= F.col("through")) & (F.col("rank") > F.col("through") - F.col("same"))
    )
    # A quota that ends among rows of one key cannot be met by a comparison of keys.
    threshold = F.when(F.col("rank") < F.col("through"), F.raise_error(F.lit(SHARED_KEY))).otherwise(F.col("h"))
    return ranked.join(side, place).select("grp", "slot", threshold.alias("threshold"))


def _holding(counted: DataFrame, wanted: DataFrame) -> DataFrame:
    """The prefix that holds each wanted rank, and the rank inside it."""
    # At most 16 ** digits rows per window: prefixes that share group and parent.
    window = Window.partitionBy("grp", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("through", F.sum("n").over(window)).withColumnRenamed("parent", "above")
    same = F.equal_null(F.col("grp"), F.col("g")) & (F.col("above") == F.col("parent"))
    before = F.col("through") - F.col("n")
    return (
        running.join(wanted, same)
        .filter((F.col("rank") <= F.col("through")) & (F.col("rank") > before))
        .select("g", "prefix", "n", "slot", (F.col("rank") - before).alias("rank"))
    )


# A rank interval holding at most this many rows is finished by counting its values.
FINISH_ROWS = 200_000
# Bits of a value that one pass over the rows decides.
DIGIT = 16


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], finish_rows: int = FINISH_ROWS
) -> dict[str, dict[float, float | None]]:
    """Exact interpolated quantiles of several columns.

    A single exact percentile aggregate keeps every distinct value of the table in one
    task.  Here a value is a 64-bit key in its order, and a pass counts the next
    ``DIGIT`` bits of all keys that still share a wanted rank's leading bits, for all
    columns and ranks together; after at most four passes the key is known.  A rank with
    few rows left is finished by counting their values.  Where passes are needed, the
    columns are written once, so that the source is read twice in all.
    """
    if not columns:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    # -0.0 and 0.0 are one value.
    values = {c: present(c, types[c]).cast("double") + F.lit(0.0) for c in columns}
    counts = df.agg(*[F.count(values[c]).alias(f"n{i}") for i, c in enumerate(columns)]).first()
    out: dict[str, dict[float, float | None]] = {c: dict.fromkeys(probabilities) for c in columns}
    wanted: dict[tuple[str, int, int], _Bracket] = {}
    places = {}
    for i, c in enumerate(columns):
        n = counts[f"n{i}"]
        for p in probabilities if n else ():
            at = p * (n - 1)
            places[(c, p)] = (c, math.floor(at), math.ceil(at)), at - math.floor(at)
            wanted[places[(c, p)][0]] = _Bracket(None, None, 0, n)
    if any(b.rows > finish_rows for b in wanted.values()):
        rows = materialize(df.select(*[values[c].alias(f"x{i}") for i, c in enumerate(columns)]), "quantiles")
        values = {c: F.col(f"x{i}") for i, c in enumerate(columns)}
        ends = _select(rows, values, wanted, finish_rows)
    else:
        ends = _finish(df, values, wanted)
    for (c, p), (key, part) in places.items():
        low, high = ends[key]
        out[c][p] = low if low == high else low + (high - low) * part
    return out


@dataclass(frozen=True)
class _Bracket:
    """Values from ``low`` to ``high`` (all when None): rows before them, rows in them."""

    low: float | None
    high: float | None
    before: int
    rows: int

    def keep(self, value: Column) -> Column:
        if self.low is None:
            return value
        return F.when((value >= F.lit(self.low)) & (value <= F.lit(self.high)), value)


@dataclass(frozen=True)
class _Prefix:
    """The keys of column number ``column`` that begin with the ``bits`` leading bits ``prefix``: those before, those with it."""

    column: int
    prefix: int
    bits: int
    before: int
    rows: int

    def bracket(self) -> _Bracket:
        rest = 64 - self.bits
        return _Bracket(_value_of(self.prefix << rest), _value_of((self.prefix << rest) + (1 << rest) - 1), self.before, self.rows)


_SIGN = 1 << 63


def order_keys(values: np.ndarray) -> np.ndarray:
    """64-bit keys that are ordered as the doubles are."""
    raw = values.view(np.uint64)
    return np.where(raw >> np.uint64(63) == 1, ~raw, raw | np.uint64(_SIGN))


def _value_of(key: int) -> float:
    """The double of a key; beyond the infinities there are none, so those stand for what would be a NaN."""
    raw = key ^ _SIGN if key & _SIGN else key ^ (1 << 64) - 1
    value = float(np.array([raw], np.uint64).view(np.float64)[0])
    return (math.inf if key & _SIGN else -math.inf) if math.isnan(value) else value


def _digits(rows: DataFrame, prefixes: Sequence[_Prefix]) -> dict[int, list[tuple[int, int]]]:
    """For every prefix the counted next digits, in order."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(1 << DIGIT, np.int64) for _ in prefixes]
        for batch in batches:
            keys = {}
            for slot, p in enumerate(prefixes):
                if p.column not in keys:
                    values = batch.column(p.column).drop_null().to_numpy(zero_copy_only=False)
                    keys[p.column] = order_keys(values)
                key = keys[p.column]
                if p.bits:
                    key = key[key >> np.uint64(64 - p.bits) == np.uint64(p.prefix)]
                digit = (key >> np.uint64(64 - p.bits - DIGIT)) & np.uint64((1 << DIGIT) - 1)
                totals[slot] += np.bincount(digit.astype(np.int64), minlength=1 << DIGIT)
        for slot, total in enumerate(totals):
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), slot, np.int32)), pa.array(at.astype(np.int32)), pa.array(total[at])],
                                             ["slot", "digit", "n"])

    counted = rows.mapInArrow(count, "slot int, digit int, n long").groupBy("slot", "digit").agg(F.sum("n").alias("n"))
    found: dict[int, list[tuple[int, int]]] = {}
    for r in counted.orderBy("slot", "digit").toLocalIterator():  # at most 2 ** DIGIT rows for each prefix
        found.setdefault(r["slot"], []).append((r["digit"], r["n"]))
    return found


def _select(rows: DataFrame, values: dict[str, Column], wanted: dict, finish_rows: int) -> dict:
    """The values at the wanted ranks: digits are decided until few rows are left, which are counted by value."""
    names = list(values)
    # A pair of ranks may part on the way, so each rank is followed by itself.
    ranks = {(c, rank): _Prefix(names.index(c), 0, 0, 0, b.rows) for (c, first, last), b in wanted.items() for rank in (first, last)}
    while wide := {p for p in ranks.values() if p.rows > finish_rows and p.bits < 64}:
        prefixes = sorted(wide, key=lambda p: (p.column, p.prefix))
        found = _digits(rows, prefixes)
        for key, p in ranks.items():
            if p not in wide:
                continue
            before = p.before
            for digit, n in found[prefixes.index(p)]:
                if key[1] < before + n:
                    ranks[key] = _Prefix(p.column, p.prefix << DIGIT | digit, p.bits + DIGIT, before, n)
                    break
                before += n
    ends = _finish(rows, values, {(c, rank, rank): p.bracket() for (c, rank), p in ranks.items()})
    return {(c, first, last): (ends[(c, first, first)][0], ends[(c, last, last)][0]) for c, first, last in wanted}


def _finish(df: DataFrame, values: dict[str, Column], brackets: dict) -> dict:
    """``{key: (value at the first rank, value at the last rank)}``."""
    result = {k: (b.low, b.low) for k, b in brackets.items() if b.low is not None and b.low == b.high}
    open_keys = [k for k in brackets if k not in result]
    if not open_keys:
        return result
    slots: dict[tuple[str, float | None, float | None], int] = {}
    for k in open_keys:
        slots.setdefault((k[0], brackets[k].low, brackets[k].high), len(slots))
    cells = []
    for (c, low, high), slot in slots.items():
        cells.append(F.struct(F.lit(slot).alias("slot"), _Bracket(low, high, 0, 0).keep(values[c]).alias("value")))
    counted = (
        df.select(F.inline(F.array(*cells)))
        .filter(F.col("value").isNotNull())
        .groupBy("slot", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # At most FINISH_ROWS rows per slot, or two values, by construction.
    running = counted.withColumn("through", F.sum("n").over(Window.partitionBy("slot").orderBy("value")))
    picks = []
    for j, k in enumerate(open_keys):
        b = brackets[k]
        here = F.col("slot") == slots[(k[0], b.low, b.high)]
        for side, rank in enumerate(k[1:]):
            hit = here & (F.col("through") > rank - b.before)
            picks.append(F.min(F.when(hit, F.col("value"))).alias(f"v{j}_{side}"))
    row = running.agg(*picks).first()
    result.update({k: (row[f"v{j}_0"], row[f"v{j}_1"]) for j, k in enumerate(open_keys)})
    return result
