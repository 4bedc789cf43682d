"""Asking all blocks of documents about keys: who else has this hash?

Documents are dealt into blocks.  In a round every block sends each of its distinct keys once,
however often it occurs there, as packed arrays dealt out by the keys' leading bits; a task
judges one digit value at a time and sends every block a bit for each of its keys.  So a key
in every document reaches a task once per block, and its replies are as small.  A block computes
its keys anew in the next round, in the same order, and reads the bits off; what it must remember
travels with its own row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.common import give_back, power_of_two, spread

#: Bytes of text in a block, and in one piece of a long text.
BLOCK_BYTES = 2 << 20
PIECE_BYTES = 1 << 20
#: Bytes of text for each digit value of a round.
DIGIT_BYTES = 8 << 20
#: A null id is larger than any.
NO_ID = 2**63 - 1
#: Kinds of rows: is a name in several documents?  has a smaller document this stretch or window?  has a symbol several stretches?
NAMES, STRETCHES, ANCHORS, WINDOWS, STATE = range(5)
_ENTRY = "part int, block int, kind int, a binary, b binary, c binary"
_LOW = 14  # bits of the lower table of powers


# --- hashes ---------------------------------------------------------------------------------------------------


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Powers:
    """Powers of a number modulo 2^64, as products from two short tables."""

    def __init__(self, base: int, n: int) -> None:
        self.low, self.high = self._row(base, 1 << _LOW), self._row(pow(base, 1 << _LOW, 1 << 64), (n >> _LOW) + 1)

    @staticmethod
    def _row(base: int, n: int) -> np.ndarray:
        factors = np.full(n, np.uint64(base))
        factors[0] = 1
        return np.cumprod(factors, dtype=np.uint64)

    def __call__(self, at: np.ndarray) -> np.ndarray:
        return self.high[at >> _LOW] * self.low[at & ((1 << _LOW) - 1)]

    def first(self, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """The powers 0 .. n - 1 in rows, with the place of each row."""
        for k in range(-(-n >> _LOW) if n else 0):
            yield k << _LOW, (self.high[k] * self.low)[: n - (k << _LOW)]


class SpanHash:
    """Hashes of any spans of ``values``, from prefix sums of weighted values; 8 bytes of memory for each value."""

    def __init__(self, values: np.ndarray, base: int, table: np.ndarray | None = None) -> None:
        n = len(values)
        self.scale = Powers(base, n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        for at, powers in Powers(pow(base, -1, 1 << 64), n).first(n):
            part = values[at: at + len(powers)]
            np.cumsum((part if table is None else table[part]) * powers, out=self.sums[at + 1: at + 1 + len(part)])
            self.sums[at + 1: at + 1 + len(part)] += self.sums[at]

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.scale(start) + (stop - start).astype(np.uint64))

    def all(self, length: int) -> np.ndarray:
        """Of every span of ``length`` values."""
        n = max(0, len(self.sums) - length)
        found = self.sums[length:] - self.sums[:n]
        for at, powers in self.scale.first(n):
            found[at: at + len(powers)] *= powers
        found += np.uint64(length)
        return mixed(found)


# --- packed arrays --------------------------------------------------------------------------------------------


def begin_of(*sorted_columns: np.ndarray) -> np.ndarray:
    """Start of each run of equal rows."""
    new = np.zeros(len(sorted_columns[0]), bool)
    new[:1] = True
    for c in sorted_columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def planes(values: np.ndarray) -> bytes:
    """Byte planes, so that the usual zero bytes of integers stand together and compress."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T).tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def from_bits(data: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)


def spans_of(flags: np.ndarray) -> np.ndarray:
    """Start and stop of each run of set flags, in turn."""
    edge = np.zeros(len(flags) + 2, np.int8)
    edge[1:-1] = flags
    return np.flatnonzero(np.diff(edge))


def covered(n: int, first: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Which of ``n`` places lie in a span."""
    depth = np.zeros(n + 1, np.int32)
    np.add.at(depth, first, 1)
    np.add.at(depth, stop, -1)
    return np.cumsum(depth, out=depth)[:-1] > 0


def rows_of(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 3
    columns = list(zip(*rows, strict=True)) or [()] * 6
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["part", "block", "kind", "a", "b", "c"])


# --- what a block sends ---------------------------------------------------------------------------------------


class Keys:
    """Distinct keys of a block in order: a hash, a check, and the smallest and largest of a value.

    ``of`` is the place of each given row's key among them.
    """

    def __init__(self, key: np.ndarray, check: np.ndarray, value: np.ndarray) -> None:
        order = np.lexsort((value, check, key))
        begin = begin_of(key[order], check[order])
        self.key, self.check = key[order][begin], check[order][begin]
        end = np.append(begin, len(order))[1:]
        self.least, self.most = value[order][begin], value[order][end - 1]
        self.of = np.empty(len(key), np.int64)
        self.of[order] = np.repeat(np.arange(len(begin)), end - begin)

    def slices(self, digits: int) -> list[tuple[int, int, int]]:
        """(digit, from, to): the leading bits of the key deal it out."""
        if not len(self.key):
            return []
        digit = (self.key >> np.uint64(65 - digits.bit_length())).astype(np.int64) if digits > 1 else np.zeros(len(self.key), np.int64)
        begin = begin_of(digit)
        return list(zip(digit[begin].tolist(), begin.tolist(), [*begin[1:].tolist(), len(digit)], strict=True))


def named(key: np.ndarray, value: np.ndarray) -> Keys:
    """Keys that need no check: taking two for one costs work, never a result."""
    return Keys(key, np.zeros(len(key), np.uint32), value)


def send(block: int, kind: int, keys: Keys, digits: int) -> list[tuple]:
    out = []
    for digit, a, b in keys.slices(digits):
        if kind in (NAMES, ANCHORS):  # 32 bits after the digit; whether the block has several values, and for an anchor, which one
            low = ((keys.key[a:b] >> np.uint64(33 - digits.bit_length())) & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            several = bits(keys.least[a:b] != keys.most[a:b])
            out.append((digit, block, kind, planes(low), several, planes(keys.least[a:b]) if kind == ANCHORS else None))
        else:  # the smallest document with the stretch or window
            out.append((digit, block, kind, planes(keys.key[a:b]), planes(keys.check[a:b]), planes(keys.least[a:b])))
    return out


def state(block: int, digits: int, *flags: np.ndarray) -> tuple:
    """What the block itself needs in the next round: at most three sets of places."""
    packed = [planes(spans_of(x).astype(np.uint32)) for x in flags]
    return block % digits, block, STATE, *packed, *[None] * (3 - len(packed))


def judge(table: pa.Table) -> pa.Table:
    """A bit for every key a block sent: names and symbols that several have, stretches and windows that a smaller document has."""
    rows = []
    all_kinds = np.asarray(table.column("kind"))
    for kind in np.unique(all_kinds).tolist():
        own = table.filter(pa.array(all_kinds == kind))
        blocks, parts = own.column("block").to_pylist(), own.column("part").to_pylist()
        a, b, c = (own.column(x).to_pylist() for x in "abc")
        if kind == STATE:
            rows += [(-1, x, kind, *y) for x, *y in zip(blocks, a, b, c, strict=True)]
            continue
        key = [from_planes(x, np.uint32 if kind in (NAMES, ANCHORS) else np.uint64) for x in a]
        sizes = [len(x) for x in key]
        key = np.concatenate(key)
        if kind == NAMES:
            order = np.argsort(key, kind="stable")
        elif kind == ANCHORS:
            value = np.concatenate([from_planes(x, np.uint64) for x in c])
            order = np.lexsort((value, key))
        else:
            check = np.concatenate([from_planes(x, np.uint32) for x in b])
            value = np.concatenate([from_planes(x, np.int64) for x in c])
            order = np.lexsort((value, check, key))
        begin = begin_of(key[order]) if kind in (NAMES, ANCHORS) else begin_of(key[order], check[order])
        many = np.diff(np.append(begin, len(key)))
        if kind in (NAMES, ANCHORS):
            several = np.logical_or.reduceat(np.concatenate([from_bits(x, n) for x, n in zip(b, sizes, strict=True)])[order], begin)
            # A block sends a name once, so two entries come from two blocks.
            found = several | (many > 1 if kind == NAMES else value[order][begin] != value[order][begin + many - 1])
            found = np.repeat(found, many)
        else:
            found = value[order] > np.repeat(value[order][begin], many)
        verdict = np.empty(len(key), bool)
        verdict[order] = found
        at = 0
        for block, part, n in zip(blocks, parts, sizes, strict=True):
            own_bits = verdict[at: at + n]
            at += n
            if own_bits.any():
                rows.append((part, block, kind, bits(own_bits), None, None))
    return rows_of(rows)


class Replies:
    """What came back to a block."""

    def __init__(self, table: pa.Table) -> None:
        names = ("kind", "part", "a", "b", "c")
        self.rows = {(k, p): x for k, p, *x in zip(*(table.column(c).to_pylist() for c in names), strict=True)}

    def state(self, n: int) -> list[np.ndarray]:
        found = []
        for data in self.rows[STATE, -1]:
            if data is not None:
                edges = from_planes(data, np.uint32).astype(np.int64)
                found.append(covered(n, edges[::2], edges[1::2]))
        return found

    def bits(self, kind: int, keys: Keys, digits: int) -> np.ndarray:
        out = np.zeros(len(keys.key), bool)
        for digit, a, b in keys.slices(digits):
            if (kind, digit) in self.rows:
                out[a:b] = from_bits(self.rows[kind, digit][0], b - a)
        return out


# --- documents, pieces and rounds -----------------------------------------------------------------------------


class Layout:
    """The documents (or pieces) of a block, in one order in every round."""

    def __init__(self, table: pa.Table) -> None:
        self.order = pc.sort_indices(table.select(["number", "piece"]), [("number", "ascending"), ("piece", "ascending")])
        self.table = table.select(["id", "block", "text"]).take(self.order)
        self.number = self.table.column("block")[0].as_py()
        self.ids = pc.fill_null(self.table.column("id"), NO_ID).to_numpy()

    def place(self, sizes: np.ndarray) -> None:
        self.sizes = sizes
        self.end = np.cumsum(sizes)
        self.begin = self.end - sizes
        self.n = int(sizes.sum())


def _in_pieces(cuts: Callable[[bytes, int], list[tuple[int, int]]], piece_bytes: int):
    names = ["number", "id", "row", "text", "piece", "pieces"]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, ids, row, text = batch.columns
            size = pc.binary_length(text).to_numpy()
            short = pa.array(np.flatnonzero(size <= piece_bytes))
            if len(short):
                one = np.ones(len(short), np.int32)
                yield pa.RecordBatch.from_arrays([*(c.take(short) for c in (number, ids, row, text)), pa.array(one - 1), pa.array(one)], names)
            for i in np.flatnonzero(size > piece_bytes).tolist():
                data = text[i].as_py()
                found = cuts(data, piece_bytes)
                for k, (a, b) in enumerate(found):  # the row's columns go with the first
                    yield pa.RecordBatch.from_arrays(
                        [number.slice(i, 1), ids.slice(i, 1), row.slice(i, 1) if k == 0 else pa.nulls(1, row.type), pa.array([data[a:b]], pa.binary()),
                         pa.array([k], pa.int32()), pa.array([len(found)], pa.int32())], names)
    return split


def dealt(rows: DataFrame, size: int, cuts: Callable[[bytes, int], list[tuple[int, int]]]) -> tuple[DataFrame, int]:
    """``rows`` (number, id, row, text as bytes) in blocks, and the digit values of a round.

    Texts of over ``PIECE_BYTES`` are cut into pieces, numbered by ``piece`` of ``pieces``, which have blocks of their
    own.  Rows equal in id and text are spread as well, as any block may hold rows of any id.
    """
    blocks = power_of_two(max(64, size // BLOCK_BYTES))
    digits = min(power_of_two(max(64, size // DIGIT_BYTES)), 1 << 31)
    fields = [*rows.schema.fields, T.StructField("piece", T.IntegerType()), T.StructField("pieces", T.IntegerType())]
    fields[2] = T.StructField("row", rows.schema["row"].dataType, True)
    pieces = rows.mapInArrow(_in_pieces(cuts, PIECE_BYTES), T.StructType(fields))
    block = block_of(F.col("piece"), blocks)
    return pieces.withColumn("block", F.when(F.col("pieces") > 1, block + blocks).otherwise(block)), digits


def block_of(piece: Column, blocks: int) -> Column:
    return spread("id", F.xxhash64("text"), "number", piece, over=blocks)


def rounds(by_block, first: Callable, later: list[Callable]) -> DataFrame:
    """The replies to the last round.  ``first`` takes a block's texts, each of ``later`` also the replies to the round before."""
    answers = by_block.applyInArrow(first, _ENTRY).groupBy("part").applyInArrow(judge, _ENTRY)
    for step in later:
        answers = by_block.cogroup(answers.groupBy("block")).applyInArrow(_asked(step), _ENTRY).groupBy("part").applyInArrow(judge, _ENTRY)
    return answers


def _asked(step: Callable):
    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        found = step(texts, Replies(answers)) if texts.num_rows else rows_of([])
        give_back()
        return found
    return run
