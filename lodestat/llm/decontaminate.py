"""Benchmark decontamination by template windows.

Words are canonicalised: numbers, names (capitalised words inside a sentence) and units
(after a number, by dimension) become typed placeholders, other words their lower-case
letters and digits.  Every window of ``WINDOW`` canonical words is hashed; windows of the
documents are hash-joined with those of the benchmark items.  A question whose numbers or
names were changed still has the same templates.  A capitalised word that begins a sentence
may be a name or not, so windows are hashed in both readings of each such word, on both sides.

An item that has no window of ``LITERAL`` literal words, as it is short or dense in numbers,
is one window as a whole, whatever its literals; documents are read in windows of such
lengths too.  Items of fewer than ``WHOLE`` words are not looked for, as their words meet by chance
in any text; ``short_items`` lists them.  Beyond ``WINDOW`` words these have two readings only, all words that begin
sentences as names and none.  If a whole window has no literal word, only equal values match.

Matches on one diagonal (document position minus item position) are one occurrence.  Its
slots must be consistent: the document may hold other values than the item, but where the
item repeats a value the document must repeat its own.  Windows that read no beginning of a
sentence as a name are judged, and counted, alone first; the others help where these do not
suffice or, being inconsistent, are left out.  An item leaks into a document when
consistent windows cover enough of it.

Null and empty texts have no windows.  Equal items are each reported.  A document row is known by id and text hash, so
rows sharing an id are judged each by its text.  Empty tables give an empty result;
further columns are ignored.  Very long texts are read in portions of windows; a text's words are held as numbers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import give_back, power_of_two, rows_with
from lodestat.operators.fitted import join_fitted
from lodestat.session import materialize

WINDOW = 8
#: Words of a window that must not be placeholders.
LITERAL = 4
#: Words of an item that is one window as a whole, at least.
WHOLE = 5
#: Share of an item's windows, or number of them, that a document must show.
COVERAGE = 0.4
LONG_RUN = 12
#: Windows whose readings are made at a time, and words of documents that are read at once.
READ = 1 << 14
GROUP_WORDS = 1 << 15
#: Benchmark windows in one bit map, by which documents are filtered before the join; more are taken in several parts.
MARKED = 2_000_000
#: Benchmark windows up to which the join is a broadcast.
SMALL = 400_000

# Units by dimension.
UNITS = {
    "length": "mm cm m km inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers kilometre kilometres",
    "mass": "mg g kg gram grams kilogram kilograms ton tons tonne tonnes pound pounds lb lbs ounce ounces oz",
    "time": "ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years",
    "money": "dollar dollars euro euros cent cents usd eur gbp pence rupees yen",
    "volume": "ml l liter liters litre litres gallon gallons cup cups",
    "share": "percent percentage",
    "speed": "mph kmh kph",
    "temperature": "degree degrees celsius fahrenheit kelvin",
}
_DIMENSION = {u: d for d, units in UNITS.items() for u in units.split()}
#: Words that a task remembers; beyond, it starts anew.
KNOWN = 100_000
_NUMBER = re.compile(r"[$€£]?[+-]?\d[\d.,:/]*%?")
_GLUED = re.compile(r"([+-]?\d[\d.,]*)([^\W\d_]+)")
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLOSING = "\"')]»”’*#$%&|"
_ENDS = (".", "!", "?", ":", ";")


def _code(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode(), 11)


_NUM, _NAME = 0x9AE16A3B2F90404F, 0xC949C7DEFD8E4B55
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Lexicon(dict):
    """Raw words as rows of a table: canonical code, slot value, unit code, kind, whether a sentence ends.

    Kinds: 0 nothing left of the word, 1 literal, 2 number, 3 possible name, 4 number with its unit.
    """

    def __init__(self) -> None:
        super().__init__()
        self.codes, self.kinds = np.zeros((1024, 3), np.uint64), np.zeros((1024, 2), np.int8)

    def rows(self, words: list[str]) -> np.ndarray:
        if len(self) > KNOWN:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def __missing__(self, word: str) -> int:
        at = len(self)
        if at == len(self.codes):
            self.codes, self.kinds = (np.concatenate([x, np.zeros_like(x)]) for x in (self.codes, self.kinds))
        code, value, kind, ends, unit = self.describe(word)
        self.codes[at] = code, value, unit
        self.kinds[at] = kind, ends
        self[word] = at
        return at

    @staticmethod
    def describe(word: str) -> tuple[int, int, int, bool, int]:
        core = word.strip(_SIGNS)
        if core.isalpha():  # the usual word needs no patterns
            low = core.lower()
            code = _code(low)
            ends = not word[-1].isalpha() and word.rstrip(_CLOSING)[-1:] in _ENDS
            name = len(core) > 1 and core[0].isupper() and core[1:].islower()
            return code, code, 3 if name else 1, ends, _code(f"<{_DIMENSION[low]}>") if low in _DIMENSION else 0
        core = _EDGE.sub("", word)
        ends = word.rstrip(_CLOSING)[-1:] in _ENDS
        low = core.lower()
        if not core:
            found = (0, 0, 0, ends, 0)
        elif _NUMBER.fullmatch(core):
            found = (_NUM, _code(low), 2, ends, 0)
        elif (m := _GLUED.fullmatch(low)) and m[2] in _DIMENSION:
            found = (_code("<number " + _DIMENSION[m[2]] + ">"), _code(low), 4, ends, 0)
        else:
            unit = _code(f"<{_DIMENSION[low]}>") if low in _DIMENSION else 0
            name = len(core) > 1 and core[0].isupper() and core[1:].islower()
            code = _code(low)
            found = (code, code, 3 if name else 1, ends, unit)
        return found


def canonical(text: str | None, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Codes and slot values (0 for a literal) of the text's words."""
    return readable(text, lexicon)[:2]


def readable(text: str | None, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes and slot values (0 for a literal) of the text's words, and which literals may be names, their code then the value."""
    return read_all([text], lexicon)[:3]


def read_all(texts: list[str | None], lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As ``readable``, one text after the other, and how many words each has."""
    parts = [(text or "").split() for text in texts]
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    words = lexicon.rows([word for part in parts for word in part])
    code, value, unit = lexicon.codes[words].T.copy()
    kind, ends = lexicon.kinds[words].T
    first = np.zeros(len(code) + 1, bool)
    first[np.cumsum(sizes) - sizes] = True  # the place after the last word stands for empty texts at the end
    start = first[:-1].copy()
    start[1:] |= ends[:-1] != 0
    there = kind > 0
    owner = np.repeat(np.arange(len(sizes)), sizes)[there]
    code, value, kind, unit, start = code[there], value[there], kind[there], unit[there], start[there]
    name = (kind == 3) & ~start
    code[name] = _NAME
    measured = np.zeros(len(code), bool)
    measured[1:] = (kind[:-1] == 2) & (unit[1:] != 0) & (owner[1:] == owner[:-1])
    code[measured] = unit[measured]
    value[~(name | measured | (kind == 2) | (kind == 4))] = 0
    return code, value, (kind == 3) & start & ~measured, np.bincount(owner, minlength=len(sizes))


def _totals(code: np.ndarray, size: int, total: int = 0) -> np.ndarray:
    n = len(code) - size + 1
    totals = np.full(n, total, np.uint64)
    for m in range(size):
        totals = totals * _STEP + code[m: m + n]
    return totals


def _mixed(total: np.ndarray) -> np.ndarray:
    total = total ^ (total >> np.uint64(31))
    total = total * np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(29))


def _literals(value: np.ndarray) -> np.ndarray:
    before = np.concatenate([[0], np.cumsum(value == 0)])
    return before[WINDOW:] - before[:-WINDOW]


def window_hashes(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows with enough literal words."""
    if len(code) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at = np.flatnonzero(_literals(value) >= LITERAL)
    return at, _mixed(_totals(code, WINDOW)[at])


def _readings(at: np.ndarray, total: np.ndarray, spare: np.ndarray, code: np.ndarray, maybe: np.ndarray,
              size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Further readings of windows of ``size`` (up to ``WINDOW``) words: places, totals and a bit for each word read as a name.

    Of the words that may be names, every choice of at most ``spare`` is read so.
    """
    places, totals, left, masks = at[:0], total[:0], spare[:0], np.empty(0, np.uint8)
    index = np.full(len(code), -1)
    index[at] = np.arange(len(at))
    names = np.flatnonzero(maybe)
    change, power = np.uint64(_NAME) - code, 1
    for m in reversed(range(size)):
        by = change * np.uint64(power)
        own = index[names[names >= m] - m]
        own = own[own >= 0]
        own = own[spare[own] > 0]
        more = np.flatnonzero(maybe[places + m] & (left > 0))
        new = [(at[own], total[own], spare[own], np.zeros(len(own), np.uint8)), (places[more], totals[more], left[more], masks[more])]
        new = [(a, t + by[a + m], s - 1, k | np.uint8(1 << m)) for a, t, s, k in new if len(a)]
        if new:
            places, totals, left, masks = (np.concatenate(x) for x in zip((places, totals, left, masks), *new, strict=True))
        power = power * int(_STEP) & (1 << 64) - 1
    return places, totals, masks


def all_readings(code: np.ndarray, value: np.ndarray, maybe: np.ndarray, every: np.ndarray, size: int = 0) -> Iterator[tuple[np.ndarray, ...]]:
    """Places, hashes and words read as names (a bit each, or 1 for all) of windows in their readings, some windows at a time.

    The windows are those that begin at ``every``: with a ``size``, of so many words whatever their literals, else the usual ones.
    """
    long = size or WINDOW
    if not len(every):
        return
    totals = _totals(code, long, _code(f"<whole {size}>") if size else 0)
    spare = np.full(len(totals), long) if size else _literals(value) - LITERAL
    if long > WINDOW:
        named = np.where(maybe, np.uint64(_NAME), code)
        others = _totals(named, long, _code(f"<whole {size}>"))
    for begin in range(0, len(every), READ):
        at = every[begin: begin + READ]
        yield at, _mixed(totals[at]), np.zeros(len(at), np.uint8)
        if not maybe[at[0]: at[-1] + long].any():
            continue
        if long > WINDOW:
            at = at[others[at] != totals[at]]
            yield at, _mixed(others[at]), np.ones(len(at), np.uint8)
        else:
            # Places count from the first window, so that the work depends on these windows only.
            first, last = at[0], at[-1] + long
            place, found, mask = _readings(at - first, totals[at], spare[at], code[first:last], maybe[first:last], long)
            yield place + first, _mixed(found), mask


def _slots(code: np.ndarray, value: np.ndarray, maybe: np.ndarray, place: np.ndarray, mask: np.ndarray, size: int) -> np.ndarray:
    """Rows of the windows' slot values in their readings."""
    at = place[:, None] + np.arange(size)
    named = (mask[:, None] >> np.arange(size, dtype=np.uint8) & 1).astype(bool) if size <= WINDOW else maybe[at] & (mask[:, None] != 0)
    return np.where(named, code[at], value[at])


_WINDOWS = "id {kind}, print long, at int, windows int, hash long, slots array<long>, named boolean, size int"


def _usual(code: np.ndarray, value: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Begins of the windows that lie in one text (``end`` is that of each word's text) and have enough literal words."""
    if len(code) < WINDOW:
        return np.empty(0, np.int64)
    return np.flatnonzero((_literals(value) >= LITERAL) & (np.arange(len(code) - WINDOW + 1) + WINDOW <= end[: len(code) - WINDOW + 1]))


def _of_size(end: np.ndarray, size: int) -> np.ndarray:
    """Begins of all windows of ``size`` words that lie in one text."""
    return np.flatnonzero(np.arange(len(end)) + size <= end)


def windows(rows: DataFrame, marks: bytes | None = None, sizes: tuple[int, ...] | None = None) -> DataFrame:
    """One row per window and reading of ``rows`` (``id``, ``text``); with a bit map, only windows whose hash is marked in it.

    ``sizes``: also the windows of so many words, whatever their literals.  None: of a row without usual windows the whole
    text, if it has ``WHOLE`` words.
    """

    def group(ids: pa.Array, texts: list[str], lexicon: Lexicon) -> pa.RecordBatch | None:
        code, value, maybe, many = read_all(texts, lexicon)
        stop = np.cumsum(many)
        owner = np.repeat(np.arange(len(many)), many)
        end = stop[owner]
        usual = _usual(code, value, end)
        total = np.bincount(owner[usual], minlength=len(many))
        asked = [(0, usual)]
        if sizes is None:
            alone = np.flatnonzero((total == 0) & (many >= WHOLE))
            asked += [(n, (stop - many)[alone[many[alone] == n]]) for n in np.unique(many[alone]).tolist()]
        else:
            asked += [(n, _of_size(end, n)) for n in sizes]
        columns, slots = [], []
        for size, every in asked:
            for place, found, mask in all_readings(code, value, maybe, every, size):
                if marks is not None:
                    keep = _marked(marks, found)
                    place, found, mask = place[keep], found[keep], mask[keep]
                if len(place):
                    i = owner[place]
                    columns.append((i, place - (stop - many)[i], total[i] if not size else np.ones(len(i), np.int64), found.view(np.int64), mask != 0,
                                    np.full(len(i), size)))
                    slots.append(_slots(code, value, maybe, place, mask, size or WINDOW))
        if not columns:
            return None
        i, place, many, found, named, size = (np.concatenate(c) for c in zip(*columns, strict=True))
        marked = {k: xxhash.xxh64_intdigest(texts[k].encode(), 42) for k in np.unique(i).tolist()}
        mark = np.array([marked[k] for k in i.tolist()], np.uint64).view(np.int64)
        ends = np.cumsum(np.concatenate([np.full(len(x), x.shape[1]) for x in slots]))
        flat = np.concatenate([x.ravel() for x in slots]).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(i)), pa.array(mark), pa.array(place.astype(np.int32)), pa.array(many.astype(np.int32)), pa.array(found),
             pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(flat)), pa.array(named),
             pa.array(size.astype(np.int32))], ["id", "print", "at", "windows", "hash", "slots", "named", "size"])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            size = pc.binary_length(batch.column(1)).to_numpy()
            cut = np.flatnonzero(np.diff(np.cumsum(size) // (GROUP_WORDS * 6), prepend=-1))  # about six bytes a word
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), batch.num_rows], strict=True):
                part = batch.slice(a, b - a)
                found = group(part.column(0), part.column(1).to_pylist(), lexicon)
                if found is not None:
                    yield found
        del lexicon
        give_back()

    return rows.mapInArrow(compute, _WINDOWS.format(kind=rows.schema["id"].dataType.simpleString()))


def _marked(marks: bytes, found: np.ndarray) -> np.ndarray:
    """Whether the bit of each hash is set in the map, whose length is a power of two."""
    place = found & np.uint64(len(marks) * 8 - 1)
    return (np.frombuffer(marks, np.uint8)[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _bit_map(hashes: np.ndarray) -> bytes:
    bits = power_of_two(max(1 << 20, 32 * len(hashes)))
    marks = np.zeros(bits // 8, np.uint8)
    place = hashes.view(np.uint64) & np.uint64(bits - 1)
    np.bitwise_or.at(marks, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return marks.tobytes()


def short_items(benchmark: DataFrame, item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id`` and ``words`` of the items that are not looked for: null, or of fewer than ``WHOLE`` words without a usual window."""
    rows = rows_with(benchmark, id=item_col, text=item_text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon()
        for batch in batches:
            many = read_all(batch.column(1).to_pylist(), lexicon)[3]
            at = pa.array(np.flatnonzero(many < WHOLE))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), pa.array(many).take(at)], ["item_id", "words"])

    return rows.mapInArrow(judge, f"item_id {rows.schema['id'].dataType.simpleString()}, words long")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          item_text: str = "text") -> DataFrame:
    """One row per document and leaked item: ``doc_id``, ``print`` (XXH64 of the text), ``item_id``, ``matched`` windows,
    ``coverage`` of the item, ``first_word`` of the occurrence among the document's canonical words, ``changed`` slots."""
    items = windows(rows_with(benchmark, id=item_col, text=item_text).where("text IS NOT NULL")).select(
        F.col("id").alias("item_id"), F.col("print").alias("item_print"), F.col("at").alias("item_at"),
        F.col("windows").alias("item_windows"), F.col("hash").alias("item_hash"), F.col("slots").alias("item_slots"), "size",
        F.col("named").alias("item_named"), F.expr("size > 0 AND forall(slots, x -> x != 0)").alias("exact"))
    items = materialize(items, "items")
    size = items.count()
    sizes = tuple(sorted(r["size"] for r in items.where("size > 0").select("size").distinct().collect()))  # lengths of whole items
    rows = rows_with(docs, id=id_col, text=text_col).where("text IS NOT NULL")
    found = None
    parts = max(1, -(-size // MARKED))
    for part in range(parts):  # each reads the documents; one part holds every usual benchmark
        hashes = items.where(F.pmod(F.xxhash64("item_hash"), F.lit(parts)) == part).select("item_hash").distinct().toArrow()
        own = windows(rows, _bit_map(hashes.column(0).to_numpy()), sizes)
        found = own if found is None else found.unionByName(own)
    if parts > 1:
        found = found.distinct()  # a window may be marked by chance in several parts
    found = found.drop("size")
    items = items.drop("size")
    hits = found.join(F.broadcast(items) if size <= SMALL else items, F.col("hash") == F.col("item_hash"))
    # Slots of the window as (item's value, document's value), for placeholders only.
    pairs = F.expr("filter(arrays_zip(item_slots, slots), x -> x.item_slots != 0)")
    hits = hits.select("id", "print", "item_id", "item_print", "item_windows", "item_at", "at", (F.col("at") - F.col("item_at")).alias("diagonal"),
                       pairs.alias("pairs"), F.expr("named OR item_named").alias("named"), "exact")
    hits = hits.where("NOT exact OR forall(pairs, x -> x.item_slots = x.slots)")

    def of(rows: Column) -> Column:
        ats, first = F.collect_set(F.when(rows, F.col("item_at"))), F.min(F.when(rows, F.col("at")))
        pairs = F.array_distinct(F.flatten(F.collect_set(F.when(rows, F.col("pairs")))))
        return F.struct(ats.alias("ats"), first.alias("first"), pairs.alias("pairs"))

    def consistent(run: str) -> Column:
        return F.size(f"{run}.pairs") == F.size(F.array_distinct(F.transform(f"{run}.pairs", lambda x: x["item_slots"])))

    runs = hits.groupBy("id", "print", "item_id", "item_print", "item_windows", "diagonal").agg(
        of(F.lit(True)).alias("all"), of(~F.col("named")).alias("plain"))
    runs = runs.withColumns({
        "all": F.when(consistent("all"), F.col("all")).when(consistent("plain"), F.col("plain")),
        "plain": F.when(consistent("plain"), F.col("plain"))})

    def occurrence(run: str) -> Column:
        matched = F.size(F.array_distinct(F.flatten(F.collect_list(f"{run}.ats"))))
        changed = F.max(F.size(F.filter(f"{run}.pairs", lambda x: x["item_slots"] != x["slots"])))
        return F.struct(matched.alias("matched"), (matched / F.col("item_windows")).alias("coverage"),
                        F.min(f"{run}.first").alias("first_word"), changed.alias("changed"))

    def enough(of: str) -> Column:
        return (F.col(f"{of}.coverage") >= COVERAGE) | (F.col(f"{of}.matched") >= LONG_RUN)

    kept = runs.groupBy("id", "print", "item_id", "item_print", "item_windows").agg(
        occurrence("all").alias("all"), occurrence("plain").alias("plain"))
    kept = kept.withColumn("run", F.when(enough("plain"), F.col("plain")).when(enough("all"), F.col("all"))).where("run IS NOT NULL")
    return kept.select(F.col("id").alias("doc_id"), "print", "item_id", "run.*")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows into which an item leaks."""
    bad = leaks(docs, benchmark, id_col, text_col).select(F.col("doc_id").alias("__of"), F.col("print").alias("__print")).distinct()
    same = F.col(f"`{id_col}`").eqNullSafe(F.col("__of")) & (F.xxhash64(F.col(f"`{text_col}`")) == F.col("__print"))
    # The leaks are broadcast once their number and size are checked; a larger table is joined by shuffle.
    return join_fitted(docs, bad, same, "left_anti")
