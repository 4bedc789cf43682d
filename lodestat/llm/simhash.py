"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints have 64 bits over word shingles.  Two that differ in at most ``r`` bits agree
in all but ``r`` of any ``p`` parts of the bits, so each distinct fingerprint is sent once
for every choice of ``p - r`` parts, and only fingerprints equal on the chosen parts are
compared.  With 8 parts of 8 bits and radius 2 such a bucket holds at most 2^16 distinct
fingerprints, whatever the corpus.

A task stores its fingerprints vertically: bit plane ``j`` holds bit ``j`` of all of them,
64 to a machine word.  Comparing each fingerprint with the ``s``-th next one is then an XOR
of shifted planes, and the differing bits are added up for 64 pairs at a time with
carry-save counters.  Words in which all 64 pairs have exceeded the radius are abandoned.

Linked fingerprints leave a task as a forest (who belongs together), not as all pairs;
``components`` joins the forests.  Copies are one fingerprint from the start, so a group of
copies, however large, is one row in the search.

A null or wordless text has fingerprint zero and links like any other.  Rows that share an
id or a whole text are each returned; a null id is never a component's id unless all its
ids are null.  An empty table gives an empty result; further columns are ignored.  A very long
text is one list of its words in its task, its shingles are counted some thousands at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import give_back, power_of_two, rows_with
from lodestat.llm.components import components
from lodestat.session import materialize

SHINGLE = 3
RADIUS = 2
SEED = 42
PARTS = 8
#: Rows of the search in one task's group, about.
GROUP_ROWS = 100_000
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


# --- fingerprints -------------------------------------------------------------------------------------------------


def shingle_hashes(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every shingle of the text's words, in order, repeats included."""
    words = text.translate(_LOWER).split()  # bytes split at the white space of words
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    digest = xxhash.xxh64_intdigest
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    pairs = zip(starts[: len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist(), strict=True)
    return np.array([digest(joined[a:b], seed) for a, b in pairs], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at: at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp``, the fingerprint as a signed long, of every row."""
    rows = rows_with(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")).cast("binary"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [majority(shingle_hashes(t.as_py(), shingle)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])
        give_back()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, fp long")


def as_hex(fp: str) -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


# --- bit-sliced search --------------------------------------------------------------------------------------------


def bit_planes(values: np.ndarray) -> np.ndarray:
    """64 rows; bit ``i`` of row ``j`` is bit ``j`` of ``values[i]``.  Lanes are padded to whole words."""
    bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits.T, axis=1, bitorder="little")
    words = -(-len(values) // 64)
    out = np.zeros((64, words * 8), np.uint8)
    out[:, : packed.shape[1]] = packed
    return out.view("<u8")


def _pack(lanes: np.ndarray) -> np.ndarray:
    """Booleans as words of 64 lanes."""
    packed = np.packbits(lanes, bitorder="little")
    out = np.zeros(-(-len(lanes) // 64) * 8, np.uint8)
    out[: len(packed)] = packed
    return out.view("<u8")


def within_radius(left: np.ndarray, right: np.ndarray, asked: np.ndarray, radius: int) -> np.ndarray:
    """Lanes, of those asked for, whose columns of the two sets of planes differ in at most ``radius`` bits.

    ``asked`` and the result are words of 64 lanes.  ``levels[k]`` is the bit ``2^k`` of the
    lanes' counters; a carry out of the last level sets ``over``.  After every eight planes
    the words without a lane still in question are abandoned.
    """
    height = radius.bit_length()
    limit = 1 << height  # counters hold 0 .. limit - 1
    result = np.zeros_like(asked)
    at = np.flatnonzero(asked)
    alive = asked[at]
    levels = [np.zeros(len(at), np.uint64) for _ in range(height)]
    over = np.zeros(len(at), np.uint64)
    for j in range(64):
        carry = left[j, at] ^ right[j, at]
        for k in range(height):
            levels[k], carry = levels[k] ^ carry, levels[k] & carry
        over |= carry
        if j % 8 == 7:
            exceeded = over.copy()
            for value in range(radius + 1, limit):  # counter values above the radius that fit the counters
                same = ~np.uint64(0)
                for k in range(height):
                    same = same & (levels[k] if value >> k & 1 else ~levels[k])
                exceeded |= same
            open_lanes = alive & ~exceeded
            keep = open_lanes != 0
            if not keep.all():
                at, alive, over = at[keep], open_lanes[keep], over[keep]
                levels = [x[keep] for x in levels]
            else:
                alive = open_lanes
            if not len(at):
                return result
    result[at] = alive
    return result


def _union(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining the trees of ``a[i]`` and ``b[i]``; a root is its tree's smallest index."""
    while len(a):
        x, y = roots[a], roots[b]
        differ = x != y
        if not differ.any():
            break
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(roots, np.maximum(x, y), np.minimum(x, y))
        while True:
            higher = roots[roots]
            if np.array_equal(higher, roots):
                break
            roots = higher
    return roots


def link_sorted(values: np.ndarray, keys: np.ndarray, radius: int) -> np.ndarray:
    """For values sorted by key: the index of each one's smallest linked value within its key's bucket."""
    n = len(values)
    roots = np.arange(n)
    _, first, size = np.unique(keys, return_index=True, return_counts=True)
    first, size = first[size > 1], size[size > 1]  # the buckets still searched
    shift = 1
    while len(first):
        total = int(size.sum())
        begin = np.cumsum(size) - size
        places = np.repeat(first - begin, size) + np.arange(total)
        ends = np.repeat(begin + size, size)
        planes = bit_planes(values[places])
        refresh = shift + max(1, min(shift, 32))  # planes are rebuilt for the buckets still open, now and then
        while shift < refresh:
            asked = np.arange(total) + shift < ends
            if not asked.any():
                first = first[:0]
                break
            moved = _shifted(planes, shift)
            hits = within_radius(planes, moved, _pack(asked), radius)
            lanes = np.flatnonzero(np.unpackbits(hits.view(np.uint8), bitorder="little")[:total])
            if len(lanes):
                roots = _union(roots, places[lanes], places[lanes + shift])
            shift += 1
        if len(first):
            # A bucket is done when all shifts are made or all its values are one tree already.
            low = np.minimum.reduceat(roots[places], begin)
            high = np.maximum.reduceat(roots[places], begin)
            keep = (size > shift) & (low != high)
            first, size = first[keep], size[keep]
    return roots


def _shifted(planes: np.ndarray, lanes: int) -> np.ndarray:
    """The planes with lane ``i + lanes`` in lane ``i``."""
    words, bits = divmod(lanes, 64)
    out = np.zeros_like(planes)
    if words < planes.shape[1]:
        out[:, : planes.shape[1] - words] = planes[:, words:]
    if bits:
        carried = np.zeros_like(out)
        carried[:, :-1] = out[:, 1:] << np.uint64(64 - bits)
        out = (out >> np.uint64(bits)) | carried
    return out


def _masks(radius: int) -> list[int]:
    """The bits on which fingerprints must agree, for every choice of parts that may differ."""
    width = 64 // PARTS
    part = [((1 << width) - 1) << (width * i) for i in range(PARTS)]
    every = (1 << 64) - 1
    return [every & ~sum(part[i] for i in free) for free in combinations(range(PARTS), radius)]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges ``a``, ``b`` that connect the fingerprints ``fp`` (distinct longs) within the radius."""
    masks = _masks(radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    count = distinct.count()
    groups = power_of_two(max(64, count * len(masks) // GROUP_ROWS))
    sent = distinct.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("choice", "mask"))
    sent = sent.select(
        F.pmod(F.xxhash64("choice", F.col("fp").bitwiseAND(F.col("mask"))), F.lit(groups)).cast("int").alias("part"),
        F.col("choice").cast("short").alias("choice"), "fp")

    def search(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        choice = table.column("choice").to_numpy()
        a, b = [], []
        for c in np.unique(choice):
            own = fps[choice == c]
            keys = own & np.uint64(masks[c])
            order = np.lexsort((own, keys))
            own, keys = own[order], keys[order]
            roots = link_sorted(own, keys, radius)
            hung = np.flatnonzero(roots != np.arange(len(roots)))
            a.append(own[hung])
            b.append(own[roots[hung]])
        return pa.table({"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)})

    return sent.groupBy("part").applyInArrow(search, "a long, b long").distinct()


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """``doc_id`` and ``fp`` of every row; of every distinct ``fp`` the ``least`` id and the ``root`` of its component."""
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    rooted = components(links(distinct.select("fp"), radius))
    return marked, distinct.join(rooted, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``doc_id``, ``fp`` and ``component_id`` (the smallest id linked, directly or not) of every row."""
    marked, joined = _rooted(docs, id_col, text_col, shingle, radius)
    ids = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = joined.join(ids, "root").select(F.col("fp").alias("of"), "component_id")
    return marked.join(named, F.col("fp") == F.col("of")).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS) -> DataFrame:
    """``docs`` without all but one row of each component: the one of smallest id, then text hash, then hash of the row.

    Rows with one id and unlike texts are of different components.  Rows without an id are not compared and stay.
    """
    of = F.col(f"`{id_col}`")
    rows = docs.where(of.isNotNull()).withColumns({
        "__print": F.xxhash64(f"`{text_col}`"), "__row": F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))})
    keyed = rows.withColumn("__key", F.struct(of.alias("id"), F.col("__print").alias("print"), F.col("__row").alias("row")))
    _, rooted = _rooted(keyed, "__key", text_col, shingle, radius)
    chosen = rooted.groupBy("root").agg(F.min("least").alias("key")).select(*[F.col(f"key.{c}").alias(f"__of_{c}") for c in ("id", "print", "row")])
    # Equal rows are reduced where they are read; the join then finds the rows dealt out by its own key.
    single = rows.dropDuplicates([id_col, "__print", "__row"])
    same = (of == F.col("__of_id")) & (F.col("__print") == F.col("__of_print")) & (F.col("__row") == F.col("__of_row"))
    kept = single.join(chosen, same, "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.unionByName(docs.where(of.isNull()))
