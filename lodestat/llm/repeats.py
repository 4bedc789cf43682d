"""Repeated passages by a depth-limited radix sort of suffixes.

Two suffixes share a repeated window exactly when they are equal through ``DEPTH`` bytes,
so suffixes are ordered by that many bytes only, most significant digit first, and a group
is dropped as soon as it lies in one document.

*Which suffixes.*  A window of 50 bytes holds 21 substrings of 30 bytes; the one with the
smallest hash (the leftmost of equals) is the window's head.  It depends on the window's
bytes alone, so equal windows have equal heads wherever they occur, and it is enough to
order the suffixes at heads: about one in eleven.  Neighbouring windows with one head
form a stretch.

*The passes.*  First digit: the head.  Heads in one document only are dropped; that leaves
little.  Second digit: the whole stretch.  A stretch also found in a smaller document is
removed with all its windows.  Last digit: the windows themselves, sent only for heads
with different stretches, and only from each stretch's smallest document.  A window then
goes if its group holds a smaller document: equal groups are exactly the repeated windows.
Bytes are compared as hashes: 32 bits and the digit at the head, 96 bits at the stretch and the window.

*As a Spark job.*  See ``exchange``: documents are dealt into blocks, a block sends each distinct
head, stretch or window once, and gets a bit for each back.  Stretches are dealt out by their own
hash, so a phrase that is in every document in unlike surroundings fills no task; that its head
has several stretches shows in one row per block.  A text of over a piece's bytes is cut into
pieces that overlap by a window less one byte.  A block's bytes are hashed in slices, so
it needs some tens of bytes of memory for each of a slice, and about twenty for each of its own.
The texts are shuffled once; all passes read that exchange.  The input should be a written
table: its rows need the same numbers when a lost task reads them again.

A null text counts as empty.  A null id is larger than any id: such a document never
makes another one lose bytes.  Rows with one id are one document and do not remove each
other's bytes.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm import exchange
from lodestat.llm.common import total_bytes
from lodestat.llm.exchange import (
    ANCHORS, NAMES, STRETCHES, WINDOWS, Keys, Layout, Replies, SpanHash, covered, mixed, named, rows_of, send, spans_of, state,
)

DEPTH = 50
HEAD = 30
#: Bytes of a block that are hashed at a time.
SLICE_BYTES = 1 << 18


def _byte_values(seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**64 - 1, 256, dtype=np.uint64)


class Block(Layout):
    """The documents (or pieces) of a block, one after the other."""

    def __init__(self, table: pa.Table) -> None:
        super().__init__(table)
        text = self.table.column("text").combine_chunks()
        self.place(pc.binary_length(text).to_numpy().astype(np.int64))
        self.data = np.frombuffer(b"".join(text.to_pylist()), np.uint8)

    def owners(self, positions: np.ndarray) -> np.ndarray:
        """The id of the document at each position."""
        return self.ids[np.searchsorted(self.end, positions, side="right")]

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last window of each stretch, and the hash of its head."""
        base = 0xD1342543DE82EF95
        found = []
        for a in range(0, max(0, self.n - DEPTH + 1), SLICE_BYTES):
            b = min(a + SLICE_BYTES, self.n - DEPTH + 1)  # windows from a to b
            exact = SpanHash(self.data[a: b + DEPTH - 1], base, _byte_values(8)).all(HEAD)
            low, wide, have = exact & ~np.uint64(63), DEPTH - HEAD + 1, 1
            while have * 2 <= wide:  # least hash, with its offset in the low bits, of 1, 2, 4, ... substrings
                low = np.minimum(low[:-have], low[have:] + np.uint64(have))
                have *= 2
            if rest := wide - have:
                low = np.minimum(low[:-rest], low[rest:] + np.uint64(rest))
            window = np.arange(b - a)
            at = window + (low & np.uint64(63)).astype(np.int64)
            # Only windows that lie in one document; a stretch ends with its document.
            near = np.arange(np.searchsorted(self.end, a, side="right"), np.searchsorted(self.end, b - 1, side="right") + 1)
            owner = np.repeat(near, np.minimum(self.end[near], b) - np.maximum(self.begin[near], a))
            window = np.flatnonzero(window + a + DEPTH <= self.end[owner])
            if not len(window):
                continue
            head, owner = at[window], owner[window]
            new = np.ones(len(window), bool)
            new[1:] = (head[1:] != head[:-1]) | (owner[1:] != owner[:-1])
            begin = np.flatnonzero(new)
            last = np.append(begin, len(window))[1:] - 1
            found.append((window[begin] + a, window[last] + a, exact[head[begin]], head[begin] + a))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        first, last, head, at = (np.concatenate(x) for x in zip(*found, strict=True))
        new = np.ones(len(first), bool)  # a stretch may go on in the next slice
        new[1:] = (at[1:] != at[:-1]) | (first[1:] != last[:-1] + 1)
        begin = np.flatnonzero(new)
        # The least of many hashes is a small one; mixed again, heads spread evenly over the digits.
        return first[begin], last[np.append(begin, len(first))[1:] - 1], mixed(head[begin] + np.uint64(1))

    def spans(self, start: np.ndarray, stop: np.ndarray) -> Keys:
        """Keys of the given stretches of bytes, with their documents' ids."""
        key = SpanHash(self.data, 0xAF251AF3B0F025B5, _byte_values(9))(start, stop)
        check = (SpanHash(self.data, 0xD1342543DE82EF95, _byte_values(8))(start, stop) >> np.uint64(32)).astype(np.uint32)
        return Keys(key, check, self.owners(start))


def _window_keys(block: Block, asked: np.ndarray) -> tuple[np.ndarray, Keys]:
    at = np.flatnonzero(asked)
    return at, block.spans(at, at + DEPTH)


def _shared(block: Block, shared: np.ndarray, stretches: tuple) -> tuple[np.ndarray, np.ndarray, Keys, Keys]:
    """First and last window of the stretches at shared heads, their keys, and the heads with the stretches' hashes."""
    first, last, head = (x[shared] for x in stretches)
    keys = block.spans(first, last + DEPTH)
    return first, last, keys, named(head, keys.key[keys.of])


def _dropped(block: Block, at: np.ndarray, keys: Keys, there: np.ndarray) -> np.ndarray:
    """Which rows go: a smaller document has the key, in this block or, as the reply says, elsewhere."""
    return (block.owners(at) > keys.least[keys.of]) | there[keys.of]


# --- the passes ---------------------------------------------------------------------------------------------------


def _send_heads(digits: int):
    def heads(texts: pa.Table) -> pa.Table:
        block = Block(texts)
        first, _, head = block.stretches()
        return rows_of(send(block.number, NAMES, named(head, block.owners(first)), digits))
    return heads


def _send_stretches(digits: int):
    def stretches(texts: pa.Table, replies: Replies) -> pa.Table:
        block = Block(texts)
        found = block.stretches()
        heads = named(found[2], block.owners(found[0]))
        shared = replies.bits(NAMES, heads, digits)[heads.of]
        _, _, keys, hung = _shared(block, shared, found)
        return rows_of([state(block.number, digits, shared), *send(block.number, STRETCHES, keys, digits), *send(block.number, ANCHORS, hung, digits)])
    return stretches


def _send_windows(digits: int):
    def windows(texts: pa.Table, replies: Replies) -> pa.Table:
        block = Block(texts)
        found = block.stretches()
        first, last, keys, hung = _shared(block, replies.state(len(found[0]))[0], found)
        dropped = _dropped(block, first, keys, replies.bits(STRETCHES, keys, digits))
        ask = ~dropped & replies.bits(ANCHORS, hung, digits)[hung.of]
        asked = covered(block.n, first[ask], last[ask] + 1)
        gone = covered(block.n, first[dropped], last[dropped] + DEPTH)
        return rows_of([state(block.number, digits, asked, gone), *send(block.number, WINDOWS, _window_keys(block, asked)[1], digits)])
    return windows


def _removed(block: Block, replies: Replies, digits: int) -> np.ndarray:
    asked, gone = replies.state(block.n)
    at, keys = _window_keys(block, asked)
    dropped = at[_dropped(block, at, keys, replies.bits(WINDOWS, keys, digits))]
    return gone | covered(block.n, dropped, dropped + DEPTH)


_CUT = ["number", "piece", "row", "n_bytes", "spans", "kept"]


def _without(data: bytes, spans: list[int]) -> bytes:
    left, done = [], 0
    for a, b in zip(spans[::2], spans[1::2], strict=True):
        left.append(data[done:a])
        done = b
    return b"".join([*left, data[done:]])


def _cut(digits: int, split: bool):
    """The documents of a block with the removed spans (start, stop in the text's bytes) and the bytes that are left.

    Of the pieces of long texts (``split``) all bytes, as the neighbouring piece may remove some.
    """
    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or (texts.column("pieces")[0].as_py() > 1) != split:
            kinds = [pa.int64(), pa.int32(), texts.schema.field("row").type, pa.int64(), pa.list_(pa.int64()), pa.binary()]
            return pa.table([pa.array([], k) for k in kinds], names=_CUT)
        block = Block(texts)
        gone = _removed(block, Replies(answers), digits)
        spans, kept = [], []
        for a, b, data in zip(block.begin.tolist(), block.end.tolist(), block.table.column("text").to_pylist(), strict=True):
            spans.append(spans_of(gone[a:b]).tolist())
            kept.append(data if split else _without(data, spans[-1]))
        own = texts.select(["number", "piece", "row"]).take(block.order)
        return pa.table([*own.columns, pa.array(block.sizes), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())], names=_CUT)
    return cut


def _joined(table: pa.Table) -> pa.Table:
    """The pieces of one document put together; a byte goes if either piece that has it removes it."""
    order = np.argsort(np.asarray(table.column("piece"))).tolist()
    parts, first, stop, size = [], [], [], 0
    for k in order:
        own = table.column("kept")[k].as_py()
        shared = DEPTH - 1 if parts else 0
        spans = np.array(table.column("spans")[k].as_py(), np.int64) + size - shared
        first.append(spans[::2])
        stop.append(spans[1::2])
        parts.append(own[shared:])
        size += len(own) - shared
    spans = spans_of(covered(size, np.concatenate(first), np.concatenate(stop))).tolist()
    return pa.table({"row": table.column("row").take(pa.array(order[:1])), "n_bytes": pa.array([size], pa.int64()),
                     "spans": pa.array([spans], pa.list_(pa.int64())), "kept": pa.array([_without(b"".join(parts), spans)], pa.binary())})


def _cuts(data: bytes, size: int) -> list[tuple[int, int]]:
    """Begin and end of the pieces of a long text, which overlap by a window less one byte."""
    size = max(size, 2 * DEPTH)
    begin = range(0, max(1, len(data) - DEPTH + 1), size - DEPTH + 1)
    return [(a, min(a + size, len(data))) for a in begin]


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Every row without the bytes covered by windows of ``DEPTH`` bytes that also start in a document of smaller id.

    Returns ``row`` (a struct of the id and the columns in ``keep``), ``n_bytes``, ``spans``
    (start and stop of each removed run, in turn) and ``kept``, the remaining bytes.
    Ids are integers.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, *keep])])
    rows = docs.select(F.monotonically_increasing_id().alias("number"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       carried.alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    texts, digits = exchange.dealt(rows, total_bytes(docs, text_col), _cuts)
    by_block = texts.groupBy("block")
    answers = exchange.rounds(by_block, _send_heads(digits), [_send_stretches(digits), _send_windows(digits)]).groupBy("block")
    result = T.StructType([texts.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
                           T.StructField("kept", T.BinaryType())])
    out = T.StructType([texts.schema["number"], texts.schema["piece"], *result.fields])
    whole = by_block.cogroup(answers).applyInArrow(_cut(digits, False), out)
    split = texts.where("pieces > 1").groupBy("block").cogroup(answers).applyInArrow(_cut(digits, True), out)
    return whole.select(*result.names).unionByName(split.groupBy("number").applyInArrow(_joined, result))


def cut_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated bytes cut out of the texts; rows of which nothing is left go, rows empty before stay.

    Bytes of a character that was cut in half are dropped.  ``chars_col``, if there is one, counts the text anew.
    """
    others = [c for c in docs.columns if c != text_col]
    marked = docs.withColumn("__lacks", F.col(f"`{text_col}`").isNull())  # the text itself travels once
    cut = cut_repeats(marked, id_col, text_col, [*others, "__lacks"]).where((F.octet_length("kept") > 0) | (F.col("n_bytes") == 0))
    text = F.col("kept").cast("string")
    text = F.when(F.is_valid_utf8(text), text).otherwise(F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit("")))
    text = F.when(F.col("row.__lacks"), F.lit(None)).otherwise(text)
    fields = {c: F.col(f"row.`{c}`") if c != text_col else text for c in docs.columns}
    if chars_col in fields:
        fields[chars_col] = F.when(text.isNull(), fields[chars_col]).otherwise(F.length(text).cast(docs.schema[chars_col].dataType))
    return cut.select(*[value.alias(name) for name, value in fields.items()])
