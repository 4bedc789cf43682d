"""Repeated passages of words by recompression.

*Names.*  The words of a text are symbols.  A round first names runs (a symbol and how often it
stands in a row) and then pairs (a symbol of the round's left side before one of its right side;
a symbol's side is a bit of a hash of its name and the round).  Names are 64-bit hashes of what
they stand for, so a run or pair has one name in every text, and a passage gets the same symbols
wherever it occurs but for a few at its borders.  With each symbol goes its context, the words
that decide that it is there: a symbol whose context lies inside a passage is in every copy of it.

*Spark rounds.*  At the levels in ``CENSUS`` every block sends its distinct names; a name comes back
as shared or not by several documents.  A window of ``WINDOW`` words that holds the context of a
symbol of one document only cannot be repeated, so it is dropped with all its names, and later
rounds see little but repeats.  Then each window left is hung on one symbol inside it, the highest,
of those the one of smallest hash: equal windows hang on equal symbols.  Windows in a row that
hang on one symbol are a stretch.  Equal stretches are found by name, and all but those of the
smallest document are removed.  Symbols with unlike stretches remain; their windows are compared.
Stretches and windows are verified by 96 bits of hash over their words.

*As a Spark job.*  Documents are dealt into blocks by a hash of id, text and the row's number, so
that equal rows fill many blocks; the input should be a written table, whose rows have the same
numbers when a lost task reads them again.  A long text is cut into pieces that
overlap by a window less one word: every window lies in one piece, and symbols depend on words
inside a window only.  In every round a block sends each distinct key once, however often it
occurs there, as packed arrays, and gets a bit for each key back.  So a passage in every
document reaches a task once per block.  The texts are shuffled once; all rounds read that exchange.

A null text has no words.  A null id is larger than any id: such a document never makes another
one lose words.  Rows with one id are one document and do not remove each other's words.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm import exchange
from lodestat.llm.common import total_bytes
from lodestat.llm.exchange import ANCHORS, NAMES, STRETCHES, WINDOWS, Keys, Layout, Replies, SpanHash, bits, covered, from_bits, mixed, named, rows_of, send, state

WINDOW = 50
#: Rounds of naming before each census; symbols of later rounds seldom lie inside a window with their context.
CENSUS = (3,)
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _named(a: np.ndarray, b: np.ndarray, kind: int) -> np.ndarray:
    return mixed(a * np.uint64(0xD1342543DE82EF95) + mixed(b + np.uint64(kind)))


# --- naming ---------------------------------------------------------------------------------------------------


class Symbols:
    """One level of a block: ``name``, document and context (first word, word after the last) of every symbol."""

    def __init__(self, name: np.ndarray, document: np.ndarray, begin: np.ndarray, end: np.ndarray,
                 low: np.ndarray, high: np.ndarray) -> None:
        self.name, self.document, self.begin, self.end, self.low, self.high = name, document, begin, end, low, high

    def _sides(self, at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Context's beginning with the symbol before ``at``, and its end with the one at ``after``.

        At the border of a document the context reaches beyond it, as another copy may go on there.
        """
        n, document = len(self.name), self.document[at]
        before, next_ = np.maximum(at - 1, 0), np.minimum(after, n - 1)
        low = np.where((at > 0) & (self.document[before] == document), self.low[before], self.begin[document] - 1)
        high = np.where((after < n) & (self.document[next_] == document), self.high[next_], self.end[document] + 1)
        return low, high

    def _of(self, name: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> Symbols:
        return Symbols(name, self.document[at], self.begin, self.end, low, high)

    def runs_named(self) -> Symbols:
        if not len(self.name):
            return self
        new = np.ones(len(self.name), bool)
        new[1:] = (self.name[1:] != self.name[:-1]) | (self.document[1:] != self.document[:-1])
        at = np.flatnonzero(new)
        after = np.append(at[1:], len(self.name))
        many = after - at
        name = np.where(many > 1, _named(self.name[at], many.astype(np.uint64), 1), self.name[at])
        return self._of(name, at, *self._sides(at, after))

    def pairs_named(self, turn: int) -> Symbols:
        if not len(self.name):
            return self
        right = (mixed(self.name + np.uint64(0x632BE59BD9B4E019 + turn)) & np.uint64(1)).astype(bool)
        pair = np.zeros(len(self.name) + 1, bool)  # of the symbol and its next
        pair[:-2] = ~right[:-1] & right[1:]
        pair[:-2] &= self.document[1:] == self.document[:-1]
        at = np.flatnonzero(~np.concatenate([[False], pair[:-2]]) if len(self.name) > 1 else np.ones(1, bool))
        paired = pair[at]
        next_ = np.minimum(at + 1, len(self.name) - 1)
        name = np.where(paired, _named(self.name[at], self.name[next_], 2), self.name[at])
        low, high = self._sides(at, at + 1)
        # A left symbol is decided by the symbol after it, a right one by the symbol before it.
        return self._of(name, at, np.where(right[at], low, self.low[at]), np.where(right[at], self.high[at], high))


def levels(words: Symbols, census: Sequence[int]) -> list[Symbols]:
    """The symbols after each number of rounds in ``census``."""
    out, symbols = [], words
    for turn in range(1, max(census) + 1):
        symbols = symbols.runs_named().pairs_named(turn)
        if turn in census:
            out.append(symbols)
    return out


# --- a block --------------------------------------------------------------------------------------------------


class Block(Layout):
    """The words of the documents (or pieces) of a block, one after the other."""

    def __init__(self, table: pa.Table) -> None:
        super().__init__(table)
        lists = pc.ascii_split_whitespace(self.table.column("text").combine_chunks().cast(pa.string()))
        flat = lists.flatten()
        full = np.asarray(pc.greater(pc.binary_length(flat), 0))
        offsets = np.asarray(lists.offsets).astype(np.int64) - lists.offsets[0].as_py()
        self.place(np.diff(np.concatenate([[0], np.cumsum(full)])[offsets]))
        self.words = flat.filter(pa.array(full))
        self.document = np.repeat(np.arange(len(self.sizes)), self.sizes)
        coded = self.words.dictionary_encode()
        digest = b"".join([xxhash.xxh3_128_digest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()])
        digest = np.frombuffer(digest, np.uint64).reshape(-1, 2)[coded.indices.to_numpy()]
        self.name, self.other = mixed(digest[:, 0]), digest[:, 1]

    def whole(self) -> np.ndarray:
        """Which places begin a window."""
        return np.arange(self.n) + WINDOW <= self.end[self.document]

    def symbols(self) -> Symbols:
        place = np.arange(self.n)
        return Symbols(self.name, self.document, self.begin, self.end, place, place + 1)

    def spans(self, start: np.ndarray, stop: np.ndarray, document: np.ndarray) -> Keys:
        """Keys of the given stretches of words, with their documents' ids."""
        one, two = SpanHash(self.name, 0xD1342543DE82EF95), SpanHash(self.other, 0xAF251AF3B0F025B5)
        return Keys(one(start, stop), (two(start, stop) >> np.uint64(32)).astype(np.uint32), self.ids[document])


def _windows_of(symbols: Symbols) -> tuple[np.ndarray, np.ndarray]:
    """First and last window that holds each symbol's context (last before first: none)."""
    return np.maximum(symbols.high - WINDOW, 0), symbols.low


def _in_live(symbols: Symbols, live: np.ndarray) -> np.ndarray:
    """The symbols whose context lies in a live window."""
    sums = np.concatenate([[0], np.cumsum(live)])
    first, last = _windows_of(symbols)
    inside = (last >= first) & (symbols.high - symbols.low <= WINDOW)
    return np.flatnonzero(inside & (sums[np.maximum(last, first - 1) + 1] > sums[np.minimum(first, len(live))]))


def _without(live: np.ndarray, symbols: Symbols, dead: np.ndarray) -> np.ndarray:
    """``live`` without the windows that hold a ``dead`` symbol's context."""
    first, last = (x[dead] for x in _windows_of(symbols))
    change = np.zeros(len(live) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, last + 1, -1)
    return live & (np.cumsum(change)[:-1] == 0)


def _least(order: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Index of the least value (leftmost of equals) of ``order[low:high]``, none empty."""
    table = [np.arange(len(order))]
    many = high - low
    level = np.frexp(many.astype(np.float64))[1] - 1
    for k in range(int(level.max(initial=0))):
        a, b = table[-1][: -(1 << k)], table[-1][1 << k:]
        table.append(np.where(order[a] <= order[b], a, b))
    out = np.empty(len(low), np.int64)
    for k in np.unique(level).tolist():
        at = np.flatnonzero(level == k)
        a, b = table[k][low[at]], table[k][high[at] - (1 << k)]
        out[at] = np.where(order[a] <= order[b], a, b)
    return out


def _hung(block: Block, all_levels: list[Symbols], live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last window of each stretch, and the name they hang on."""
    window = np.flatnonzero(live)
    where, name = np.full(len(window), -1, np.int64), np.zeros(len(window), np.uint64)
    left = np.arange(len(window))
    for height, symbols in enumerate(reversed([block.symbols(), *all_levels])):
        if not len(left):
            break
        low = np.searchsorted(symbols.low, window[left])
        high = np.searchsorted(symbols.high, window[left] + WINDOW, side="right")
        mine = left[high > low]
        at = _least(mixed(symbols.name), low[high > low], high[high > low])
        where[mine] = at * (len(all_levels) + 1) + height
        name[mine] = _named(symbols.name[at], np.full(len(at), height, np.uint64), 3)
        left = left[high <= low]
    new = np.ones(len(window), bool)
    new[1:] = (where[1:] != where[:-1]) | (window[1:] != window[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin, len(window))[1:] - 1
    return window[begin], window[last], name[begin]


# --- the rounds -----------------------------------------------------------------------------------------------


def _names(block: Block, symbols: Symbols, live: np.ndarray) -> tuple[np.ndarray, Keys]:
    """The symbols inside live windows, and their names with the documents that have them."""
    at = _in_live(symbols, live)
    return at, named(symbols.name[at], block.ids[symbols.document[at]])


def _after_census(block: Block, symbols: Symbols, live: np.ndarray, replies: Replies, digits: int) -> np.ndarray:
    at, keys = _names(block, symbols, live)
    return _without(live, symbols, at[~replies.bits(NAMES, keys, digits)[keys.of]])


def _stretches(block: Block, live: np.ndarray, known: list[Symbols]) -> tuple[np.ndarray, np.ndarray, Keys, Keys]:
    """First and last window of the stretches, their keys, and the symbols they hang on with the stretches' hashes."""
    first, last, name = _hung(block, known, live)
    keys = block.spans(first, last + WINDOW, block.document[first])
    return first, last, keys, named(name, keys.key[keys.of])


def _window_keys(block: Block, asked: np.ndarray) -> tuple[np.ndarray, Keys]:
    at = np.flatnonzero(asked)
    return at, block.spans(at, at + WINDOW, block.document[at])


def _dropped(block: Block, at: np.ndarray, keys: Keys, there: np.ndarray) -> np.ndarray:
    """Which rows go: a smaller document has the key, in this block or, as the reply says, elsewhere."""
    return (block.ids[block.document[at]] > keys.least[keys.of]) | there[keys.of]


def _first_round(digits: int):
    def names(texts: pa.Table) -> pa.Table:
        block = Block(texts)
        live, (low, *_) = block.whole(), levels(block.symbols(), CENSUS[:1])
        return rows_of([state(block.number, digits, live), *send(block.number, NAMES, _names(block, low, live)[1], digits)])
    return names


def _next_round(turn: int, digits: int):
    """After the census ``turn`` - 1: the names of the next level."""
    def names(texts: pa.Table, replies: Replies) -> pa.Table:
        block = Block(texts)
        (live,) = replies.state(block.n)
        known = levels(block.symbols(), CENSUS[: turn + 1])
        live = _after_census(block, known[turn - 1], live, replies, digits)
        return rows_of([state(block.number, digits, live), *send(block.number, NAMES, _names(block, known[turn], live)[1], digits)])
    return names


def _stretch_round(digits: int):
    def stretches(texts: pa.Table, replies: Replies) -> pa.Table:
        block = Block(texts)
        (live,) = replies.state(block.n)
        known = levels(block.symbols(), CENSUS)
        live = _after_census(block, known[-1], live, replies, digits)
        _, _, keys, hung = _stretches(block, live, known)
        return rows_of([state(block.number, digits, live), *send(block.number, STRETCHES, keys, digits), *send(block.number, ANCHORS, hung, digits)])
    return stretches


def _window_round(digits: int):
    def windows(texts: pa.Table, replies: Replies) -> pa.Table:
        block = Block(texts)
        (live,) = replies.state(block.n)
        first, last, keys, hung = _stretches(block, live, levels(block.symbols(), CENSUS))
        dropped = _dropped(block, first, keys, replies.bits(STRETCHES, keys, digits))
        ask = ~dropped & replies.bits(ANCHORS, hung, digits)[hung.of]
        asked = covered(block.n, first[ask], last[ask] + 1)
        gone = covered(block.n, first[dropped], last[dropped] + WINDOW)
        return rows_of([state(block.number, digits, asked, gone), *send(block.number, WINDOWS, _window_keys(block, asked)[1], digits)])
    return windows


def _removed(block: Block, replies: Replies, digits: int) -> np.ndarray:
    asked, gone = replies.state(block.n)
    at, keys = _window_keys(block, asked)
    dropped = at[_dropped(block, at, keys, replies.bits(WINDOWS, keys, digits))]
    return gone | covered(block.n, dropped, dropped + WINDOW)


_CUT = ["number", "piece", "row", "gone", "words", "n_words", "n_removed"]


def _cut(digits: int, split: bool):
    """Of every document the words that are left, joined by one space, and how many went.

    Of the pieces of long texts (``split``) all words, as the neighbouring piece may remove some, with a bit for each removed.
    """
    def cut(texts: pa.Table, answers: pa.Table) -> pa.Table:
        if not texts.num_rows or (texts.column("pieces")[0].as_py() > 1) != split:
            row = texts.schema.field("row").type
            kinds = [pa.int64(), pa.int32(), row, pa.binary(), pa.string(), pa.int64(), pa.int64()]
            return pa.table([pa.array([], k) for k in kinds], names=_CUT)
        block = Block(texts)
        gone = _removed(block, Replies(answers), digits)
        keep = ~gone | split
        offsets = np.concatenate([[0], np.cumsum(keep)])[np.concatenate([[0], block.end])].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), block.words.filter(pa.array(keep)))
        lost = np.concatenate([[0], np.cumsum(gone)])
        marks = [bits(gone[a:b]) if split else None for a, b in zip(block.begin.tolist(), block.end.tolist(), strict=True)]
        texts = texts.select(["number", "piece", "row"]).take(block.order)
        return pa.table([*texts.columns, pa.array(marks, pa.binary()), pc.binary_join(lists, " "), pa.array(block.sizes),
                         pa.array(lost[block.end] - lost[block.begin])], names=_CUT)
    return cut


def _joined(table: pa.Table) -> pa.Table:
    """The pieces of one document put together; a word goes if either piece that has it removes it."""
    order = np.argsort(np.asarray(table.column("piece")))
    words, gone = [], np.zeros(0, bool)
    for k in order.tolist():
        own = table.column("words")[k].as_py()
        own = own.split(" ") if own else []
        marks = from_bits(table.column("gone")[k].as_py(), len(own))
        shared = min(WINDOW - 1, len(words)) if k != order[0] else 0
        gone[len(gone) - shared:] |= marks[:shared]
        words += own[shared:]
        gone = np.concatenate([gone, marks[shared:]])
    kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
    return pa.table({"row": table.column("row").take(pa.array(order[:1])), "n_words": pa.array([len(words)], pa.int64()),
                     "n_removed": pa.array([int(gone.sum())], pa.int64()), "kept": pa.array([" ".join(kept)])})


def _cuts(data: bytes, size: int) -> list[tuple[int, int]]:
    """Begin and end of the pieces of a long text, which overlap by a window less one word."""
    cuts, ahead, start = [], [], 0
    for word in _WORD.finditer(data):
        ahead.append(word.start())
        if len(ahead) >= WINDOW and word.end() - start > size:
            cuts.append((start, word.end()))
            start = ahead[-(WINDOW - 1)]
        ahead = ahead[-WINDOW:]
    return [*cuts, (start, len(data))]


def cut_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Every row without the words covered by windows of ``WINDOW`` words that also start in a document of smaller id.

    Returns ``row`` (a struct of the id and the columns in ``keep``), ``n_words``, ``n_removed`` and
    ``kept``, the words left with one space between.  Ids are integers.
    """
    carried = F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys([id_col, *keep])])
    rows = docs.select(F.monotonically_increasing_id().alias("number"), F.col(f"`{id_col}`").cast("long").alias("id"),
                       carried.alias("row"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("text"))
    texts, digits = exchange.dealt(rows, total_bytes(docs, text_col), _cuts)
    by_block = texts.groupBy("block")
    later = [_next_round(turn, digits) for turn in range(1, len(CENSUS))] + [_stretch_round(digits), _window_round(digits)]
    answers = exchange.rounds(by_block, _first_round(digits), later).groupBy("block")
    row = texts.schema["row"]
    out = T.StructType([texts.schema["number"], texts.schema["piece"], row, T.StructField("gone", T.BinaryType()), T.StructField("words", T.StringType()),
                        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())])
    result = T.StructType([row, out["n_words"], out["n_removed"], T.StructField("kept", T.StringType())])
    whole = by_block.cogroup(answers).applyInArrow(_cut(digits, False), out)
    split = texts.where("pieces > 1").groupBy("block").cogroup(answers).applyInArrow(_cut(digits, True), out)
    return whole.select("row", "n_words", "n_removed", F.col("words").alias("kept")).unionByName(
        split.groupBy("number").applyInArrow(_joined, result))
