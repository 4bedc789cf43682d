"""Hard negatives for contrastive training, found with an inverted multi-index.

A vector is cut into two halves and each half has a codebook of its own, fitted by k-means on
a sample of at most ``SAMPLE_ROWS`` rows (those of smallest hash).  A row belongs to the cell
of its two nearest codewords.  For an anchor ``a`` and a codeword ``c`` whose rows lie within
radius ``r``, no row's half score exceeds ``a . c + |a| r``; the sum of both halves bounds a
cell.  A multi-sequence heap over the two sorted lists of half bounds visits cells by falling
bound, so as soon as the next bound is below what is still needed, the result is certified:
nothing in the cells left can change it.

*Rounds.*  Positives: every anchor visits cells with about ``budget`` rows; the least score
among its best rows is then a certified floor, and one more round visits every other cell
whose bound reaches it.  Negatives likewise, where the floor of a positive is the lower edge
of its window, or its last negative once all are found.  A cell whose own radii rule it out
is not read.  Vectors without structure have bounds that rule out little; the rounds then
read all rows, and the result is the same.

*As a Spark job.*  Every row is indexed.  Cells are cut into pieces of bounded size, so a
vector in a third of all rows fills many pieces, and pieces are dealt in turn to buckets of
about ``BUCKET_ROWS`` rows.  An anchor is sent once to each bucket that has a cell it visits; beyond
``BLOCK_ANCHORS`` anchors, a bucket is read once for each block of them.  A bucket returns
the best few rows for each anchor.  The driver holds the codebooks and one row for each cell,
at most ``MOST_CODES`` squared.

Rows with a null id, a null label, a null or empty vector, or any null or non-finite
component take no part, nor do vectors of another length than the most frequent one (of
equally frequent lengths, the longest).  Rows that share an id are one row: the one of smallest
label, then of smallest vector hash.  Scores are exact while
they stay below 2^53, rounded beyond, and held within 2^56.  Ties go to
the smaller id.  An anchor without another row of its label gives no row, nor does a positive
without a row in its window.  An empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestat.llm.common import power_of_two, rows_with
from lodestat.session import materialize

SAMPLE_ROWS = 10_000
MOST_CODES = 256
CELL_ROWS = 64
BUCKET_ROWS = 400_000
BLOCK_ANCHORS = 200_000
#: A bucket is scored in slices, against so many anchors at once.
SLICE_ROWS = 1 << 16
ANCHORS_AT_ONCE = 64
#: Bounds are rounded sums; this much is added to them.
SLACK = 1e-3
#: A hundred times this is a long still.
MOST_SCORE = 2.0**56
_WIDTHS = {2: np.dtype("<i2"), 4: np.dtype("<i4"), 8: np.dtype("<f8")}


# --- vectors --------------------------------------------------------------------------------------------------


def _pack(vectors: np.ndarray) -> list[bytes]:
    """Rows of whole numbers in the narrowest kind that holds them."""
    most = np.abs(vectors).max(axis=1)
    width = np.where(most < 1 << 15, 2, np.where(most < 1 << 31, 4, 8))
    out = np.empty(len(vectors), object)
    for w, kind in _WIDTHS.items():
        mine = np.flatnonzero(width == w)
        for i, row in zip(mine.tolist(), vectors[mine].astype(kind), strict=True):
            out[i] = row.tobytes()
    return out.tolist()


def _unpack(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), dim))
    width = np.fromiter(map(len, values), np.int64, len(values)) // max(1, dim)
    for w, kind in _WIDTHS.items():
        mine = np.flatnonzero(width == w)
        if len(mine):
            out[mine] = np.frombuffer(b"".join([values[i] for i in mine.tolist()]), kind).reshape(-1, dim)
    return out


def _whole_numbers(scale: int):
    """id, label, length and packed ``floor(scale * x)`` of the rows that take part."""
    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(0).is_valid().to_numpy(False) & batch.column(1).is_valid().to_numpy(False)
                                 & batch.column(2).is_valid().to_numpy(False))
            lists = batch.column(2)
            flat = lists.flatten()
            values = flat.cast(pa.float64()).to_numpy(False)  # nulls become NaN
            size = np.diff(np.asarray(lists.offsets))
            begin = np.cumsum(size) - size
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
            fit = (size > 0) & (bad[begin + size] == bad[begin])
            packed = np.empty(len(size), object)
            with np.errstate(over="ignore"):
                for n in np.unique(size[fit]).tolist():
                    mine = np.flatnonzero(fit & (size == n))
                    packed[mine] = _pack(np.floor(values[begin[mine][:, None] + np.arange(n)] * scale))
            at = np.flatnonzero(fit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)), pa.array(size[at].astype(np.int32)),
                 pa.array(packed[at].tolist(), pa.binary())], ["id", "label", "n", "v"])
    return convert


def _points(rows: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    """The rows that take part, one for each id, and the length of their vectors."""
    rows = rows_with(rows, id=id_col, label=label_col, v=vector_col)
    rows = rows.select(F.col("id").cast("long"), F.col("label").cast("long"), "v")
    points = materialize(rows.mapInArrow(_whole_numbers(scale), "id long, label long, n int, v binary"), "points")
    length = points.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    if length is None:
        return points, 0
    points = points.where(F.col("n") == length["n"]).select("id", "label", "v")
    repeated = materialize(points.groupBy("id").count().where("count > 1").select(F.col("id").alias("of")), "repeated")
    if not repeated.isEmpty():
        shared = F.col("id") == F.col("of")
        least = F.min(F.struct("label", F.xxhash64("v").alias("hash"), "v"))
        one = points.join(repeated, shared, "left_semi").groupBy("id").agg(least.alias("least")).select("id", "least.label", "least.v")
        points = materialize(points.join(repeated, shared, "left_anti").unionByName(one), "points")
    return points, length["n"]


# --- the index ------------------------------------------------------------------------------------------------


def _codebook(sample: np.ndarray, codes: int, rounds: int = 8) -> np.ndarray:
    """At most ``codes`` codewords by k-means; the first distinct rows of the sample are the beginning."""
    _, first = np.unique(sample, axis=0, return_index=True)
    words = sample[np.sort(first)[:codes]]
    for _ in range(rounds):
        code = _nearest(sample, words)
        count = np.bincount(code, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, code, sample)
        words = np.where(count[:, None] > 0, sums / np.maximum(1, count)[:, None], words)
    return words


def _nearest(rows: np.ndarray, words: np.ndarray) -> np.ndarray:
    half = (words * words).sum(axis=1) / 2
    return np.concatenate([np.argmax(rows[a: a + 8192] @ words.T - half, axis=1) for a in range(0, max(1, len(rows)), 8192)])


class Index(NamedTuple):
    dim: int
    left: np.ndarray  # codewords of the first half
    right: np.ndarray
    count: np.ndarray  # rows of each cell, a matrix over the two codes
    left_radius: np.ndarray  # of each cell, in the first half
    right_radius: np.ndarray
    first_piece: np.ndarray  # the pieces of all cells are numbered one after the other
    pieces: np.ndarray
    buckets: int

    def bounds(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bounds of the half scores of every codeword's rows (minus infinity without rows), and of every cell."""
        cut = self.left.shape[1]
        one, two = a[:cut], a[cut:]
        x, y = self.left @ one, self.right @ two
        one, two = np.sqrt(one @ one), np.sqrt(two @ two)
        cell = (x[:, None] + one * self.left_radius) + (y + two * self.right_radius)
        full = self.count > 0
        of_left = np.where(full.any(axis=1), x + one * np.where(full, self.left_radius, 0).max(axis=1), -np.inf)
        of_right = np.where(full.any(axis=0), y + two * np.where(full, self.right_radius, 0).max(axis=0), -np.inf)
        return of_left, of_right, np.where(full, cell, -np.inf)

    def visit(self, a: np.ndarray, floor: float, skip: int, budget: float) -> tuple[list[int], int]:
        """Cells to read by falling bound, until the bound is below ``floor`` or ``budget`` rows are reached.

        The first ``skip`` cells of the order were visited before.  Also returns how far the order was followed.
        """
        of_left, of_right, cell = self.bounds(a)
        p, q = np.argsort(-of_left, kind="stable").tolist(), np.argsort(-of_right, kind="stable").tolist()
        x, y = of_left[p].tolist(), of_right[q].tolist()
        count, own = self.count.tolist(), cell.tolist()
        heap = [(-(x[0] + y[0]), 0, 0)]
        cells, rows, visited = [], 0, 0
        while heap and rows < budget:
            bound, i, j = heap[0]
            if -bound + SLACK < floor or bound == np.inf:
                break
            heapq.heappop(heap)
            visited += 1
            if j + 1 < len(y):
                heapq.heappush(heap, (-(x[i] + y[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(x):
                heapq.heappush(heap, (-(x[i + 1] + y[0]), i + 1, 0))
            if visited > skip and count[p[i]][q[j]] and own[p[i]][q[j]] + SLACK >= floor:
                cells.append(p[i] * len(y) + q[j])
                rows += count[p[i]][q[j]]
        return cells, visited


def _build(points: DataFrame, dim: int, total: int) -> tuple[Index, DataFrame]:
    """The index, and every row with its cell and the bucket of its piece."""
    codes = min(MOST_CODES, max(2, power_of_two(int(np.sqrt(total / CELL_ROWS)))))
    sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toArrow()
    cut = (dim + 1) // 2
    sample = _unpack(sample.column("v"), dim)
    left, right = _codebook(sample[:, :cut], codes), _codebook(sample[:, cut:], codes)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _unpack(batch.column(2), dim)
            i, j = _nearest(v[:, :cut], left), _nearest(v[:, cut:], right)
            away = [np.sqrt(((v[:, :cut] - left[i]) ** 2).sum(axis=1)), np.sqrt(((v[:, cut:] - right[j]) ** 2).sum(axis=1))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((i * len(right) + j).astype(np.int32)), *map(pa.array, away)],
                                             ["id", "label", "v", "cell", "r1", "r2"])

    indexed = materialize(points.mapInArrow(place, "id long, label long, v binary, cell int, r1 double, r2 double"), "indexed")
    cells = indexed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).toArrow()
    at, shape = cells.column("cell").to_numpy(), (len(left), len(right))
    count, r1, r2 = np.zeros(shape, np.int64), np.zeros(shape), np.zeros(shape)
    for grid, name in ((count, "n"), (r1, "r1"), (r2, "r2")):
        grid.ravel()[at] = cells.column(name).to_numpy()
    buckets = power_of_two(max(16, total // BUCKET_ROWS))
    piece_rows = max(16, total // buckets // 16)
    pieces = -(-count // piece_rows).ravel()
    first = np.cumsum(pieces) - pieces
    index = Index(dim, left, right, count, r1, r2, first, pieces, buckets)
    spark = points.sparkSession
    full = np.flatnonzero(pieces)
    where = spark.createDataFrame(pa.table({"of": full.astype(np.int32), "first": first[full], "pieces": pieces[full]}))
    piece = F.col("first") + F.pmod(F.xxhash64("id"), F.col("pieces"))
    dealt = indexed.join(F.broadcast(where), F.col("cell") == F.col("of"))  # at most MOST_CODES squared rows
    return index, dealt.select("id", "label", "v", "cell", F.pmod(piece, F.lit(buckets)).cast("int").alias("bucket"))


# --- the search -----------------------------------------------------------------------------------------------


_VISIT = "bucket int, block int, anchor long, label long, v binary, edges binary, cells binary"
_STATE = "anchor long, label long, v binary, edges binary, floor double, skip int"


def _plan(index: Index, budget: float, blocks: int):
    """Each anchor's cells of this round, one row for each bucket that has a piece of one."""
    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _unpack(batch.column("v"), index.dim)
            rows = []
            for a, (anchor, label, packed, edges, floor, skip) in zip(vectors, zip(*(c.to_pylist() for c in batch.columns), strict=True), strict=True):
                cells = np.array(index.visit(a, floor, skip, budget)[0], np.int32)
                if not len(cells):
                    continue
                first, many = index.first_piece[cells], np.minimum(index.pieces[cells], index.buckets)
                turn = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                bucket, cell = (np.repeat(first, many) + turn) % index.buckets, np.repeat(cells, many)
                order = np.argsort(bucket, kind="stable")
                bucket, cell = bucket[order], cell[order]
                begin = np.flatnonzero(np.diff(bucket, prepend=-1))
                for x, y in zip(begin.tolist(), [*begin[1:].tolist(), len(bucket)], strict=True):
                    rows.append((int(bucket[x]), anchor % blocks, anchor, label, packed, edges, cell[x:y].tobytes()))
                if len(rows) >= 5000:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)

    def _batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                          ["bucket", "block", "anchor", "label", "v", "edges", "cells"])
    return plan


def _best(score: np.ndarray, ids: np.ndarray, at: np.ndarray, most: int) -> np.ndarray:
    """Of the rows ``at``, the ``most`` of highest score, then of smallest id."""
    if len(at) > most:
        own = score[at]
        at = at[own >= np.partition(own, len(own) - most)[len(own) - most]]
    return at[np.lexsort((ids[at], -score[at]))][:most]


def _scorer(dim: int, most: int, low: int, high: int):
    """The best rows of a bucket for every anchor sent to it.

    Without ``edges``, of the anchor's own label; otherwise for each score in ``edges`` those of other labels
    with ``low * edge <= 100 * score <= high * edge``.
    """
    def of_slice(rows: pa.Table, sent: pa.Table) -> Iterator[np.ndarray]:
        ids, labels, cell = (rows.column(c).to_numpy() for c in ("id", "label", "cell"))
        vectors = _unpack(rows.column("v"), dim)
        for at in range(0, sent.num_rows, ANCHORS_AT_ONCE):
            part = sent.slice(at, ANCHORS_AT_ONCE)
            asked = [np.frombuffer(x, np.int32) for x in part.column("cells").to_pylist()]
            every = np.unique(np.concatenate(asked))
            first, stop = np.searchsorted(cell, every), np.searchsorted(cell, every, side="right")
            many = stop - first
            chosen = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
            scores = np.clip(_unpack(part.column("v"), dim) @ vectors[chosen].T, -MOST_SCORE, MOST_SCORE).astype(np.int64)
            own_ids, own_labels, own_cell = ids[chosen], labels[chosen], np.searchsorted(every, cell[chosen])
            for k, (anchor, label, edges) in enumerate(zip(*(part.column(c).to_pylist() for c in ("anchor", "label", "edges")), strict=True)):
                open_ = np.zeros(len(every), bool)
                open_[np.searchsorted(every, asked[k])] = True
                mine, s = open_[own_cell], scores[k]
                if edges is None:
                    windows = [(0, mine & (own_labels == label) & (own_ids != anchor))]
                else:
                    other = mine & (own_labels != label)
                    windows = [(e, other & (100 * s >= low * e) & (100 * s <= high * e)) for e in np.frombuffer(edges, np.int64).tolist()]
                for edge, inside in windows:
                    best = _best(s, own_ids, np.flatnonzero(inside), most)
                    yield np.stack([np.full(len(best), anchor), np.full(len(best), edge), own_ids[best], s[best]])

    def score(rows: pa.Table, sent: pa.Table) -> pa.Table:
        found = [np.empty((4, 0), np.int64)]
        if sent.num_rows:
            rows = rows.sort_by("cell")
            for at in range(0, rows.num_rows, SLICE_ROWS):
                found += of_slice(rows.slice(at, SLICE_ROWS), sent)
        found = np.concatenate(found, axis=1)
        return pa.table(dict(zip(["anchor", "edge", "id", "score"], map(pa.array, found), strict=True)))
    return score


def _top(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("anchor", "edge").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _search(index: Index, dealt: DataFrame, state: DataFrame, blocks: int, budget: float, most: int, low: int, high: int) -> DataFrame:
    """One round: the cells planned for each anchor are read."""
    sent = state.mapInArrow(_plan(index, budget, blocks), _VISIT)
    if blocks > 1:
        dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    else:
        dealt = dealt.withColumn("block", F.lit(0))
    found = dealt.groupBy("bucket", "block").cogroup(sent.groupBy("bucket", "block")).applyInArrow(
        _scorer(index.dim, most, low, high), "anchor long, edge long, id long, score long")
    return materialize(_top(found, most), "found")


def _two_rounds(index: Index, dealt: DataFrame, state: DataFrame, blocks: int, budget: float, most: int, low: int, high: int) -> DataFrame:
    """The best rows for every (anchor, edge), certified.

    ``state`` has a row for each anchor: ``anchor``, ``label``, ``v``, ``edges`` (scores, or null) and ``wanted``.
    """
    def columns(df: DataFrame) -> DataFrame:
        return df.select("anchor", "label", "v", "edges", F.col("floor").cast("double").alias("floor"), F.col("skip").cast("int").alias("skip"))

    lowest = F.lit(float("-inf"))
    start = F.coalesce(F.array_min("scores").cast("double") * low / 100, lowest)
    first = _search(index, dealt, columns(state.withColumns({"floor": start, "skip": F.lit(0)})), blocks, budget, most, low, high)
    # What is needed still: for each edge the last of the best rows if all are there, else all the window.
    last = first.groupBy("anchor", "edge").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    edges = state.select("anchor", "wanted", F.explode_outer("scores").alias("edge"))
    edges = edges.withColumns({"window": F.coalesce(F.col("edge").cast("double") * low / 100, lowest), "edge": F.coalesce("edge", F.lit(0))})
    need = F.when(F.col("n") >= F.col("wanted"), F.col("last").cast("double")).otherwise(F.col("window"))
    floors = edges.join(last, ["anchor", "edge"], "left").groupBy("anchor").agg(F.min(need).alias("floor"))

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:  # how far the first round went
            vectors = _unpack(batch.column("v"), index.dim)
            begin = batch.column("start").to_pylist()
            skip = [index.visit(a, f, 0, budget)[1] for a, f in zip(vectors, begin, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(skip, pa.int32())], ["anchor", "label", "v", "edges", "floor", "skip"])

    state = state.withColumn("start", start).join(floors, "anchor").select("anchor", "label", "v", "edges", "floor", "start")
    state = state.mapInArrow(reached, _STATE)
    second = _search(index, dealt, state, blocks, float("inf"), most, low, high)
    return materialize(_top(first.unionByName(second).drop("rank"), most), "best")


def mine(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 100,
         positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``, the anchors.

    Vectors become whole numbers ``floor(scale * x)`` and a row's score is its inner product with
    the anchor.  An anchor's positives are its best rows of the same label; for each, the best rows
    of other labels with a score from ``low`` to ``high`` percent of the positive's are returned:
    ``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``.
    """
    points, dim = _points(rows, id_col, label_col, vector_col, scale)
    total = points.count()
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not total:
        return rows.sparkSession.createDataFrame([], out)
    index, dealt = _build(points, dim, total)
    budget = min(max(2000, total // 32), 200_000)
    others = points.groupBy(F.col("label").alias("of")).agg((F.count(F.lit(1)) - 1).alias("others"))
    anchors = points.where(F.col("id") % every == 0).join(others, F.col("label") == F.col("of")).where("others > 0")
    anchors = materialize(anchors.select(F.col("id").alias("anchor"), "label", "v", F.least("others", F.lit(positives)).alias("wanted")), "anchors")
    blocks = max(1, -(-anchors.count() // BLOCK_ANCHORS))
    nothing = {"edges": F.lit(None).cast("binary"), "scores": F.lit(None).cast("array<long>")}
    best = _two_rounds(index, dealt, anchors.withColumns(nothing), blocks, budget, positives, low, high)
    # A window above a negative score is empty.
    edges = best.where("score >= 0").groupBy("anchor").agg(F.array_sort(F.collect_set("score")).alias("scores"))  # at most ``positives``

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = [np.array(x, np.int64).tobytes() for x in batch.column("scores").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edges, pa.binary())], ["anchor", "label", "v", "wanted", "scores", "edges"])

    state = anchors.drop("wanted").join(edges, "anchor").select("anchor", "label", "v", F.lit(negatives).alias("wanted"), "scores")
    state = materialize(state.mapInArrow(pack, "anchor long, label long, v binary, wanted int, scores array<long>, edges binary"), "state")
    hard = _two_rounds(index, dealt, state, blocks, budget, negatives, low, high)
    pairs = best.select(F.col("anchor").alias("anchor_id"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    same = (F.col("anchor_id") == F.col("anchor")) & (F.col("positive_score") == F.col("edge"))
    return pairs.join(hard, same).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                                         F.col("score").alias("negative_score"))
