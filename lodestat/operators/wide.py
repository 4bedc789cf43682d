"""Sums over many columns at once: correlations of wide tables, components of wide or sparse rows.

Tasks multiply blocks of rows as matrices and hand on one small matrix for each pair of column
blocks (or one thin matrix), which are added up in a tree.  The plan has a few steps however many
columns there are, and no pass holds more than ``PASS_BYTES`` of sums in a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns in a block; a pair of blocks has four matrices of sums.
BLOCK = 128
PASS_BYTES = 192 << 20
#: Partial sums that are added up in one task.
FAN = 32
_SUMS = "pair int, part int, sums binary"
_PAIRS = "i int, j int, r double"


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The batch as an array of doubles, missing values as NaN."""
    return np.column_stack([c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in batch.columns])


def add_up(partial: DataFrame, keys: int) -> DataFrame:
    """One row per ``pair`` with the sum of its ``sums`` (doubles as bytes), ``FAN`` at a time."""
    def added(table: pa.Table) -> pa.Table:
        total = None
        for data in table.column("sums").to_pylist():
            own = np.frombuffer(data, np.float64)
            total = own.copy() if total is None else total + own
        return pa.table({"pair": table.column("pair").slice(0, 1), "part": table.column("part").slice(0, 1), "sums": [total.tobytes()]})

    tasks = max(1, partial.rdd.getNumPartitions())
    while tasks > 1:
        tasks = -(-tasks // FAN)
        partial = partial.groupBy("pair", F.pmod("part", F.lit(tasks)).alias("to")).applyInArrow(added, _SUMS)
    return partial


def column_shifts(wide: DataFrame) -> np.ndarray:
    """For every column a value near its mean, taken off before products are summed; 0 where nothing is there."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = _matrix(batch)
            there = ~np.isnan(x)
            own = np.concatenate([there.sum(axis=0), np.where(there, x, 0).sum(axis=0)])
            total = own if total is None else total + own
        if total is not None:
            yield _row(0, total)

    found = add_up(wide.mapInArrow(sums, _SUMS), 1).collect()  # two numbers for each column
    if not found:
        return np.zeros(len(wide.columns))
    n, s = np.frombuffer(found[0]["sums"], np.float64).reshape(2, -1)
    return np.divide(s, n, out=np.zeros_like(s), where=n > 0)


def _row(pair: int, sums: np.ndarray, part: int | None = None) -> pa.RecordBatch:
    from pyspark import TaskContext

    context = TaskContext.get()
    part = part if part is not None else context.partitionId() if context else 0
    return pa.RecordBatch.from_arrays([pa.array([pair], pa.int32()), pa.array([part], pa.int32()), pa.array([np.ascontiguousarray(sums, np.float64).tobytes()])],
                                      ["pair", "part", "sums"])


def correlations(wide: DataFrame) -> DataFrame:
    """``(i, j, r)`` of all pairs ``i < j`` of the columns of ``wide`` (doubles); missing values drop pairwise.

    NULL where a pair has fewer than two common rows or either column is constant on them.
    """
    p = len(wide.columns)
    shift = column_shifts(wide)
    blocks = [range(a, min(a + BLOCK, p)) for a in range(0, p, BLOCK)]
    pairs = list(combinations_with_replacement(range(len(blocks)), 2))
    at_once = max(1, PASS_BYTES // (5 * 8 * BLOCK * BLOCK))
    out = None
    for first in range(0, len(pairs), at_once):
        own = pairs[first: first + at_once]
        used = sorted({b for pair in own for b in pair})
        place = {b: k for k, b in enumerate(used)}
        columns = [i for b in used for i in blocks[b]]
        starts = np.cumsum([0, *[len(blocks[b]) for b in used]])

        def products(batches: Iterator[pa.RecordBatch], own=own, place=place, columns=columns, starts=starts) -> Iterator[pa.RecordBatch]:
            totals: dict[int, np.ndarray] = {}
            for batch in batches:
                x = _matrix(batch) - shift[columns]
                there = ~np.isnan(x)
                x = np.where(there, x, 0)
                m, q = there.astype(np.float64), x * x
                for number, (a, b) in enumerate(own):
                    s, t = slice(starts[place[a]], starts[place[a] + 1]), slice(starts[place[b]], starts[place[b] + 1])
                    both = [m[:, s].T @ m[:, t], x[:, s].T @ m[:, t], m[:, s].T @ x[:, t], q[:, s].T @ m[:, t], m[:, s].T @ q[:, t], x[:, s].T @ x[:, t]]
                    sums = np.stack(both)
                    totals[number] = totals[number] + sums if number in totals else sums
            for number, sums in totals.items():
                yield _row(number, sums)

        def finished(batches: Iterator[pa.RecordBatch], own=own) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for number, data in zip(batch.column("pair").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                    a, b = (blocks[k] for k in own[number])
                    n, sx, sy, qx, qy, xy = np.frombuffer(data, np.float64).reshape(6, len(a), len(b))
                    with np.errstate(invalid="ignore", divide="ignore"):
                        vx, vy = qx - sx * sx / n, qy - sy * sy / n
                        r = (xy - sx * sy / n) / np.sqrt(vx * vy)
                    # What is left of a constant column is rounding.
                    flat = (n < 2) | ~(vx > 1e-12 * qx) | ~(vy > 1e-12 * qy)
                    r = np.clip(r, -1, 1)
                    i, j = np.meshgrid(np.array(a), np.array(b), indexing="ij")
                    upper = i < j
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), pa.array(r[upper], mask=(flat | np.isnan(r))[upper])],
                        ["i", "j", "r"])

        part = wide.select(*[F.col(f"`{wide.columns[i]}`") for i in columns]).mapInArrow(products, _SUMS)
        found = add_up(part, len(own)).mapInArrow(finished, _PAIRS)
        out = found if out is None else out.unionByName(found)
    return out


# ---------------------------------------------------------------- components
#: Directions beyond the wanted ones, which speed the search up.
SPARE = 8
MOST_PASSES = 60
#: The search ends when no wanted direction turns by more than this (sine of the angle).
STILL = 1e-9


class Sketch:
    """Leading directions of centred rows by a randomised search, which holds a few columns on the driver.

    Rows are given sparse, as ``at`` (places) and ``x`` (values), or with a value for every place,
    ``at`` being null.  A pass multiplies the rows with the present directions and back again: ``A' (A Q) - n m (m' Q)`` is the centred product
    without ever centring a row.  The passes are repeated until the wanted directions stand still.
    """

    def __init__(self, rows: DataFrame, width: int, k: int, seed: int = 888) -> None:
        self.rows, self.width, self.k = rows, width, min(k, width)
        self.size = min(width, self.k + SPARE)
        self.seed = seed

    def _pass(self, q: np.ndarray | None) -> np.ndarray | None:
        """Sums over all rows of ``a (a' Q)``; without directions ``(n, sum of squares, sum of a)``."""
        width = self.width

        def dense(x: np.ndarray) -> np.ndarray:
            if q is None:
                return np.concatenate([[len(x), np.vdot(x, x)], x.sum(axis=0)])
            return x.T @ (x @ q)

        def sparse(at: np.ndarray, x: np.ndarray, many: np.ndarray) -> np.ndarray:
            row = np.repeat(np.arange(len(many)), many)
            if q is None:
                return np.concatenate([[len(many), (x * x).sum()], np.bincount(at, x, minlength=width)])
            own = np.empty((width, q.shape[1]))
            for j in range(q.shape[1]):
                product = np.bincount(row, x * q[at, j], minlength=len(many))
                own[:, j] = np.bincount(at, x * product[row], minlength=width)
            return own

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for batch in batches:
                full = batch.column(0).is_null()
                for rows, whole in ((batch.filter(full), True), (batch.filter(pc.invert(full)), False)):
                    if not rows.num_rows:
                        continue
                    x = rows.column(1).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
                    if whole:
                        own = dense(x.reshape(-1, width))
                    else:
                        at = rows.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                        own = sparse(at, x, np.diff(np.asarray(rows.column(0).offsets)))
                    total = own if total is None else total + own
            if total is not None:
                yield _row(0, total)

        found = add_up(self.rows.mapInArrow(sums, _SUMS), 1).collect()
        return np.frombuffer(found[0]["sums"], np.float64) if found else None

    def fit(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Means, the directions (a column each, largest variance first, largest entry positive), and their shares of the variance."""
        first = self._pass(None)
        if first is None or first[0] < 2:
            raise ValueError("components need two rows at least")
        n, total, mean = first[0], first[1], first[2:] / first[0]
        total -= n * float(mean @ mean)
        rng = np.random.default_rng(self.seed)
        q = np.linalg.qr(rng.normal(size=(self.width, self.size)))[0]
        for _ in range(MOST_PASSES):
            y = self._pass(q).reshape(self.width, -1) - n * np.outer(mean, mean @ q)
            values, turn = np.linalg.eigh((q.T @ y + y.T @ q) / 2)
            turn = turn[:, ::-1]
            best = q @ turn[:, : self.k]
            moved = y @ turn[:, : self.k] - best * values[::-1][: self.k]
            if np.linalg.norm(moved, axis=0).max() <= STILL * max(values[-1], 1e-300) or self.size == self.width:
                break
            q = np.linalg.qr(y)[0]
        sign = np.where(best[np.abs(best).argmax(axis=0), np.arange(self.k)] < 0, -1.0, 1.0)
        shares = np.maximum(values[::-1][: self.k], 0) / total if total > 0 else np.zeros(self.k)
        return mean, best * sign, shares


def spread_rows(df: DataFrame) -> DataFrame:
    """``df`` dealt out while its rows are still narrow, as one small file may hold the rows of very many wide ones."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism))


def sparse_rows(df: DataFrame, numeric: Sequence[Column], flags: Sequence[tuple[Column, Sequence[str], int]]) -> DataFrame:
    """Rows as ``at`` and ``x``: numbers at the first places, then a one at each category's place.

    ``flags`` holds the value as text, the categories and the place of the first.
    """
    cells = [F.struct(F.lit(i).alias("at"), c.cast("double").alias("x")) for i, c in enumerate(numeric)]
    for value, categories, first in flags:
        place = F.array_position(F.array(*[F.lit(c) for c in categories]), value) if categories else F.lit(0)
        cells.append(F.when(place > 0, F.struct((place - 1 + first).cast("int").alias("at"), F.lit(1.0).alias("x"))))
    both = F.filter(F.array(*cells), lambda c: c.isNotNull() & c["x"].isNotNull() & (c["x"] != 0))
    return df.select(F.transform(both, lambda c: c["at"]).alias("at"), F.transform(both, lambda c: c["x"]).alias("x"))


def dense_rows(df: DataFrame, vector: Column, width: int) -> DataFrame:
    """Rows of an array column, a value for every place; one of another length is an error, rows without a vector are left out."""
    rows = df.select(vector.alias("x")).filter(F.col("x").isNotNull())
    wrong = F.raise_error(F.concat(F.lit(f"a vector of {width} numbers was expected, one of "), F.size("x").cast("string"), F.lit(" was found")))
    return rows.select(F.lit(None).cast("array<int>").alias("at"), F.when(F.size("x") == width, F.col("x")).otherwise(wrong.cast("array<double>")).alias("x"))
