"""Periodic runs of words, by longest common extensions over a difference cover.

A run is a longest stretch of words that repeats with a smallest period ``q``, at least
``EXPONENT`` times and over ``LEAST`` words.

*Enumeration.*  Within a run of period ``q`` at least ``(EXPONENT - 1) * q`` consecutive
places hold the same word as the place ``q`` further on.  So a grid with that step has a
point in every run of the period; over all periods the grids have a harmonic sum of points,
about ``n log n``.  At each grid point the common extension of the places ``i`` and
``i + q`` to the right and to the left gives the whole run.  The same stretch found with
several periods keeps the smallest.

*Common extensions.*  ``COVER`` is a difference cover modulo ``MODULUS``: for any two places
there is a shift below the modulus that brings both onto sampled places.  The words up to
there are compared directly, which settles most pairs.  Only for documents with a pair left,
the suffixes at sampled places are sorted (by their first ``MODULUS`` words, then by doubled
ranks along the places one modulus apart), neighbours' common prefixes go into a sparse
table, and the rest of an extension is one range minimum.  Extensions to the left are the
same over the words in reverse.

*As a Spark job.*  A document is judged by itself, so there is no shuffle: Arrow batches are
cut into blocks of ``BLOCK_BYTES`` and all documents of a block are handled at once.  Memory
grows with the block, or with the longest text; grid points are taken in portions.

A null text has no words.  Every row is judged by itself, so repeated rows get equal
results and a null id is returned as it is.  Ties cannot arise: a stretch is one run.  An
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from lodestat.llm.common import in_blocks, rows_with

EXPONENT = 4
LEAST = 6
ROOT = 8
MODULUS = ROOT * ROOT
#: Every difference is a multiple of ROOT less a number below ROOT, so these places cover all differences.
COVER = np.unique(np.concatenate([np.arange(ROOT), ROOT * np.arange(1, ROOT)]))
#: So many words are compared at least before samples are asked for: few pairs without a run get so far.
COMPARED = 8
BLOCK_BYTES = 1 << 20
GRID_POINTS = 1 << 20


def _shifts() -> np.ndarray:
    """For every pair of residues, the least shift from ``COMPARED`` on that brings both into the cover."""
    inside = np.zeros(MODULUS, bool)
    inside[COVER] = True
    places = np.arange(MODULUS)
    moved = inside[(places[:, None] + COMPARED + places[None, :]) % MODULUS]  # residue, shift
    return COMPARED + (moved[:, None, :] & moved[None, :, :]).argmax(axis=2)


SHIFT = _shifts()


def _refine(rank: np.ndarray, at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Split the groups of equal rank at the entries ``at`` by ``key``; entries still in a group of several are returned.

    A rank is the number of entries of smaller groups, so groups keep their ranks when others split.
    """
    order = at[np.lexsort((key, rank[at]))]
    key_of = np.empty(len(rank), key.dtype)
    key_of[at] = key
    group, part = rank[order], key_of[order]
    new_group = np.ones(len(order), bool)
    new_group[1:] = group[1:] != group[:-1]
    new_part = new_group.copy()
    new_part[1:] |= part[1:] != part[:-1]
    place = np.arange(len(order))
    group_start = np.maximum.accumulate(np.where(new_group, place, 0))
    part_start = np.maximum.accumulate(np.where(new_part, place, 0))
    rank[order] = group + part_start - group_start
    last = np.ones(len(order), bool)
    last[:-1] = new_part[1:]
    return order[~(new_part & last)]


class Extensions:
    """How many words two places of one document have in common, to the right.

    ``words`` are numbers from 1, documents one after the other, each followed by a zero;
    ``owner`` numbers the document of every place.
    """

    def __init__(self, words: np.ndarray, owner: np.ndarray) -> None:
        self.n = len(words)
        self.words = np.concatenate([words, np.zeros(MODULUS + 1, words.dtype)])
        self.owner = owner
        self.sorted = np.zeros(int(owner[-1]) + 1 if len(owner) else 0, bool)

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        shift = SHIFT[i % MODULUS, j % MODULUS]
        common = np.zeros(len(i), np.int64)
        alive = np.arange(len(i))
        step = 0
        rest = []
        while len(alive):
            there = shift[alive] == step
            if there.any():
                rest.append(alive[there])
                alive = alive[~there]
            a = self.words[i[alive] + step]
            alive = alive[(a == self.words[j[alive] + step]) & (a > 0)]
            step += 1
            common[alive] = step
        rest = np.concatenate(rest) if rest else alive
        if len(rest):
            common[rest] += self._sampled(i[rest] + shift[rest], j[rest] + shift[rest])
        return common

    def _sampled(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rest of the extension of sampled places (or places at the end of the document)."""
        asked = self.owner[a]
        if not self.sorted[asked].all():
            self.sorted[asked] = True
            self._sort(self.sorted)
        x, y = self.order_of[self.slot[a]], self.order_of[self.slot[b]]
        low, high = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        return np.minimum(self.least[level, low], self.least[level, high - (1 << level)])

    def _sort(self, chosen: np.ndarray) -> None:
        """Order the sampled suffixes of the ``chosen`` documents and tabulate the common prefixes of neighbours."""
        place = (np.arange(0, self.n, MODULUS)[:, None] + COVER).ravel()
        place = place[place < self.n]
        place = place[chosen[self.owner[place]]]
        self.slot = np.full(self.n + MODULUS + 1, -1, np.int32)
        self.slot[place] = np.arange(len(place))
        owner = self.owner[place]
        rank = np.searchsorted(owner, owner).astype(np.int32)  # at first the documents are the groups
        open_ = np.arange(len(place))
        bits = max(1, int(self.words.max()).bit_length())
        pack = max(1, min(MODULUS, 62 // bits))
        for step in range(0, MODULUS, pack):
            if not len(open_):
                break
            key = np.zeros(len(open_), np.int64)
            for k in range(step, min(step + pack, MODULUS)):
                key = key << bits | self.words[np.minimum(place[open_] + k, self.n)]
            open_ = _refine(rank, open_, key)
        follow = self.slot[place + MODULUS]
        follow[(follow >= 0) & (owner[follow] != owner)] = -1
        levels = []
        while len(open_):  # the groups left are equal through MODULUS << len(levels) words
            levels.append((rank.copy(), follow))
            ahead = follow[open_]
            open_ = _refine(rank, open_, np.where(ahead >= 0, rank[ahead], -1))
            follow = np.where(follow >= 0, follow[follow], -1)
        order = np.argsort(rank)
        self.order_of = rank  # all ranks differ now
        least = self._neighbours(place, owner, order, levels)
        height = max(1, int(len(least)).bit_length())
        self.least = np.zeros((height, len(least) + 1), np.int32)
        self.least[0, : len(least)] = least
        for k in range(1, height):
            half, size = 1 << (k - 1), len(least) - (1 << k) + 1
            if size > 0:
                self.least[k, :size] = np.minimum(self.least[k - 1, :size], self.least[k - 1, half: half + size])

    def _neighbours(self, place: np.ndarray, owner: np.ndarray, order: np.ndarray, levels: list) -> np.ndarray:
        """Words in common of each suffix with the one before it in order (0 across documents)."""
        common = np.zeros(len(order), np.int64)
        if len(order) < 2:
            return common
        a, b = order[:-1].copy(), order[1:].copy()
        same = owner[a] == owner[b]
        for k in range(len(levels) - 1, -1, -1):
            rank, follow = levels[k]
            equal = same & (a >= 0) & (b >= 0)
            equal[equal] = rank[a[equal]] == rank[b[equal]]
            common[1:][equal] += MODULUS << k
            a[equal], b[equal] = follow[a[equal]], follow[b[equal]]
        alive = np.flatnonzero(same)
        step = common[1:].copy()
        for _ in range(MODULUS):
            x = self.words[np.minimum(place[order[alive]] + step[alive], self.n)]
            y = self.words[np.minimum(place[order[alive + 1]] + step[alive], self.n)]
            alive = alive[(x == y) & (x > 0)]
            if not len(alive):
                break
            step[alive] += 1
        common[1:] = np.where(same, step, 0)
        return common


def _grid(sizes: np.ndarray, exponent: int, least: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Grid points (document, place, period) in portions of about ``GRID_POINTS``."""
    most = np.where(sizes >= least, sizes // exponent, 0)  # the largest period a document can have
    begin = np.cumsum(most) - most
    total = int(most.sum())
    at = 0
    while at < total:
        pairs = np.arange(at, min(at + GRID_POINTS // 4, total))
        document = np.searchsorted(begin, pairs, side="right") - 1
        period = pairs - begin[document] + 1
        step = (exponent - 1) * period
        many = (sizes[document] - period + step - 1) // step
        ends = np.cumsum(many)
        cut = max(1, int(np.searchsorted(ends, GRID_POINTS, side="right")))
        document, period, step, many = document[:cut], period[:cut], step[:cut], many[:cut]
        at += cut
        for low in range(0, int(many.max()), GRID_POINTS):  # one period of one long document can be a portion of its own
            part = np.minimum(many - low, GRID_POINTS).clip(0)
            turn = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + low
            yield np.repeat(document, part), turn * np.repeat(step, part), np.repeat(period, part)


def _smallest(start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct stretches in order, each with its smallest period."""
    order = np.lexsort((period, stop, start))
    start, stop, period = start[order], stop[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return start[new], stop[new], period[new]


def find_runs(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, exponent: int = EXPONENT,
              least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, stop and period of all runs, by start, in several documents at once.

    ``words`` are numbers from 1; the document of ``sizes[d]`` words begins at ``starts[d]`` and is
    followed by a zero.  Places are those of ``words``.
    """
    n = len(words)
    numbers = np.arange(len(sizes), dtype=np.int32)
    right = Extensions(words, np.repeat(numbers, sizes + 1))
    # In reverse, a document is followed by the zero that parts it from the one before.
    left = Extensions(np.concatenate([words[: n - 1][::-1], words[n - 1:]]), np.repeat(numbers, sizes[::-1] + 1))
    found = [np.empty((3, 0), np.int64)]
    for document, place, period in _grid(sizes, exponent, least):
        i = starts[document] + place
        equal = words[i] == words[i + period]
        i, period = i[equal], period[equal]
        stop = i + period + right(i, i + period)
        inner = i > 0  # at place 0 nothing lies to the left
        back = np.zeros(len(i), np.int64)
        back[inner] = left(n - 2 - (i[inner] - 1), n - 2 - (i[inner] + period[inner] - 1))
        start = i - back
        long = stop - start >= np.maximum(least, exponent * period)
        found.append(np.stack(_smallest(start[long], stop[long], period[long])))
    return _smallest(*np.concatenate(found, axis=1))


def _kept(n: int, start: np.ndarray, stop: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The places that no run contains after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, stop, -1)
    return np.cumsum(change[:n]) == 0


def _judge(block: pa.Table, reorder: Callable | None, exponent: int, least: int) -> pa.RecordBatch:
    texts = pc.fill_null(block.column(1).combine_chunks(), "")
    lists = pc.ascii_split_whitespace(texts)  # exactly the white space of words
    flat = lists.flatten()
    full = np.asarray(pc.greater(pc.binary_length(flat), 0))
    offsets = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
    sums = np.concatenate([[0], np.cumsum(full)])
    sizes = np.diff(sums[offsets])
    flat = flat.filter(pa.array(full))
    ids = block.column(0).to_pylist()
    if reorder is not None:
        firsts = np.cumsum(sizes) - sizes
        taken = [None] * len(sizes)
        changed = False
        for d, (key, size) in enumerate(zip(ids, sizes.tolist(), strict=True)):
            places = reorder(key, size) if size else None
            changed |= places is not None
            taken[d] = firsts[d] + (np.arange(size) if places is None else places)
        if changed:
            flat = flat.take(pa.array(np.concatenate(taken).astype(np.int64)))
    codes = flat.dictionary_encode().indices.to_numpy() + np.int32(1)
    starts = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int((sizes + 1).sum()), np.int32)
    within = np.ones(len(words), bool)
    within[starts + sizes] = False
    words[within] = codes
    start, stop, period = find_runs(words, starts, sizes, exponent, least)
    kept = _kept(len(words), start, stop, period)[within]
    owner = np.searchsorted(starts, start, side="right") - 1
    runs = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(owner, np.arange(len(sizes) + 1)).astype(np.int32)),
        pa.StructArray.from_arrays([pa.array(x) for x in (start - starts[owner], stop - start, period)], ["start", "length", "period"]))
    left = np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(sizes)])]
    lists = pa.ListArray.from_arrays(pa.array(left.astype(np.int32)), flat.filter(pa.array(kept)))
    return pa.RecordBatch.from_arrays(
        [block.column(0).combine_chunks(), pa.array(sizes), runs, pc.binary_join(lists, " ").cast(pa.string())],
        ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST,
                  reorder: Callable[[object, int], np.ndarray | None] | None = None) -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (start, length and period, by start and period) and ``collapsed`` of every row.

    ``collapsed`` is the text, words parted by one space, in which each run is left with its
    first period.  ``reorder``, if given, says for an id and a number of words which word stands
    at each place (None: the text's own order); runs and ``collapsed`` are those of that order.
    ``exponent`` is at least 2.
    """
    if exponent < 2:
        raise ValueError("a run repeats its period at least twice")
    rows = rows_with(docs, doc_id=id_col, text=text_col)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in in_blocks(batches, lambda b: b.column(1).nbytes, BLOCK_BYTES):
            yield _judge(block, reorder, exponent, least)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(judge, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
