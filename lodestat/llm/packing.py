"""Packing of token sequences: shortest-pack-first over the length histogram.

Every document is tokenised and cut into pieces of the sequence length and a rest.
The histogram of piece lengths, at most ``SEQUENCE`` numbers however large the corpus, is
all that the packing looks at: lengths are placed longest first, each time into the shortest
packs, those with the most room, and packs of the same make-up are one pattern
with a count.  A pattern says how many packs hold which lengths, so the pieces of a length,
counted off by rank, find their pack, and their place in it, by a join on length and rank.

Pieces are ranked within (length, bucket), buckets being hashes of the piece, and the ranks
are shifted by the sizes of the buckets before: a length that a third of all pieces share
is ranked by many tasks.

A null or empty text is a document with the end token alone.  Repeated rows are packed
each by itself.  An empty table gives no sequences.  Further columns can be carried along.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestat.llm.common import give_back, in_blocks
from lodestat.session import materialize

SEQUENCE = 2048
END = 1
#: Text tokenised at a time.
BATCH_BYTES = 2 << 20
#: Word pieces whose ids a task remembers from one batch to the next; beyond, it starts anew.
KNOWN = 50_000
#: Ranks of a length are counted in so many parts.
BUCKETS = 512


# --- tokens -------------------------------------------------------------------------------------------------------


def _byte_characters() -> list[str]:
    """The character that stands for each byte in the vocabulary: itself if it is printable, else the next from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordTokenizer:
    """Token ids of many texts at once, each distinct word tokenised once.

    The tokenizer never joins characters across a space or line feed, so a text's ids are
    those of its parts between them, in order.  Parts of plain Latin letters, digits and
    signs go straight to the merge model, as that is most of the time; any other part, and
    one with the name of a special token, goes through the whole tokenizer.
    """

    def __init__(self, path: str) -> None:
        import regex

        # A task has one core; the library's own threads would each keep memory.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.inner = Tokenizer.from_file(path)
        self.model = self.inner.model
        self.plain = regex.compile(r"[\x21-\x7e\xa1-\u012f\u0131-\u017f]*")
        self.pieces = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")  # fixed value: the file's own pattern
        self.bytes = _byte_characters()
        self.known: dict[str, list[int]] = {}

    def _model_ids(self, piece: str) -> list[int]:
        if not piece.isascii():
            piece = "".join([self.bytes[b] for b in piece.encode()])
        return [t.id for t in self.model.tokenize(piece)]

    def words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids one word after the other, and the number of ids of each word."""
        ids, size, known = [], [], self.known
        if len(known) > KNOWN:
            known.clear()
        odd = [i for i, w in enumerate(words) if "<|" in w or not self.plain.fullmatch(w)]
        whole = {i: e.ids for i, e in zip(odd, self.inner.encode_batch([words[i] for i in odd], add_special_tokens=False), strict=True)}
        find = self.pieces.findall
        for i, word in enumerate(words):
            before = len(ids)
            if i in whole:
                ids += whole[i]
            else:
                for piece in find(word.lower()):
                    found = known.get(piece)
                    if found is None:
                        found = known[piece] = self._model_ids(piece)
                    ids += found
            size.append(len(ids) - before)
        return np.array(ids, np.uint32), np.array(size, np.int64)

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        parts = pc.split_pattern(pc.replace_substring(texts.fill_null("").cast(pa.large_string()), "\n", " "), " ")
        offsets = parts.offsets.to_numpy().astype(np.int64)
        flat = parts.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
        offsets = offsets - offsets[0]
        ids, size = self.words(flat.dictionary.to_pylist())
        begin = np.cumsum(size) - size
        code = flat.indices.to_numpy(zero_copy_only=False)
        many = size[code]
        total = np.concatenate([[0], np.cumsum(many)])
        out = np.repeat(begin[code] - total[:-1], many) + np.arange(total[-1])
        lengths = total[offsets[1:]] - total[offsets[:-1]]
        return np.insert(ids[out], total[offsets[1:]], END), lengths + 1


def token_pieces(docs: DataFrame, tokenizer: str, text_col: str = "text", keep: Sequence[str] = ("doc_id",),
                 sequence: int = SEQUENCE) -> DataFrame:
    """One row per piece: ``row`` (a struct of ``keep``), ``start``, ``length``, ``doc_tokens`` and ``ids``.

    ``ids`` are little-endian unsigned 32-bit numbers; ``tokenizer`` is the file's path on the executors.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    out = T.StructType([rows.schema["row"], *(T.StructField(n, T.LongType()) for n in ("start", "length", "doc_tokens")),
                        T.StructField("ids", T.BinaryType())])

    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = None
        for block in in_blocks(batches, lambda b: b.column(1).nbytes, BATCH_BYTES):
            model = model or WordTokenizer(tokenizer)
            ids, lengths = model.texts(block.column("text").combine_chunks())
            ids = ids.astype("<u4")
            stops = np.cumsum(lengths)
            pieces = -(-lengths // sequence)
            owner = np.repeat(np.arange(len(lengths)), pieces)
            start = (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * sequence
            length = np.minimum(sequence, lengths[owner] - start)
            begin = (stops - lengths)[owner] + start
            data = [ids[a: a + n].tobytes() for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            yield from pa.table({
                "row": block.column("row").take(pa.array(owner)), "start": start, "length": length,
                "doc_tokens": lengths[owner], "ids": pa.array(data, pa.binary()),
            }).to_batches(max_chunksize=2000)
        del model
        give_back()

    return rows.mapInArrow(tokenise, out)


# --- patterns -----------------------------------------------------------------------------------------------------


def pack_histogram(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns: (number of packs, [(length, copies in each pack), ...]).

    Only counts of patterns are kept.  A length takes one copy per pack in the shortest packs
    that have room, or as many as fit if there are more pieces than packs; a pattern of
    which only some packs are used is split in two.  So a length adds few patterns.
    """
    by_room: dict[int, list[list]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for room in [r for r in sorted(by_room, reverse=True) if r >= length]:
            kept, waiting = [], by_room.pop(room)
            for count, made in waiting:
                copies = room // length
                if left >= count * copies:
                    used, each = count, copies
                else:
                    each = max(1, min(copies, -(-left // count)))
                    used = left // each
                if used:
                    by_room.setdefault(room - each * length, []).append([used, [*made, (length, each)]])
                    left -= used * each
                if count > used:
                    if rest := min(left, copies):  # the last few pieces share one pack
                        by_room.setdefault(room - rest * length, []).append([1, [*made, (length, rest)]])
                        left -= rest
                        count -= 1
                    if count > used:
                        kept.append([count - used, made])
            if kept:
                by_room.setdefault(room, []).extend(kept)
            if not left:
                break
        if left:
            copies = sequence // length
            if full := left // copies:
                by_room.setdefault(sequence - copies * length, []).append([full, [(length, copies)]])
            if rest := left % copies:
                by_room.setdefault(sequence - rest * length, []).append([1, [(length, rest)]])
    return [(count, made) for room in sorted(by_room) for count, made in by_room[room]]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, one past the last, copies in a pack, first sequence, offset) for every part of a pattern."""
    out, ranks, first = [], {}, 0
    for count, made in patterns:
        offset = 0
        for length, copies in made:
            rank = ranks.get(length, 0)
            out.append((length, rank, rank + count * copies, copies, first, offset))
            ranks[length] = rank + count * copies
            offset += length * copies
        first += count
    return out


def ranked(pieces: DataFrame, key: Sequence[str]) -> DataFrame:
    """``rank`` of every piece among those of its length, from 0, in parts that any number of tasks can count."""
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int"))
    sizes = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("of"), F.col("bucket").alias("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    within = Window.partitionBy("length", "bucket").orderBy(*key)
    counted = pieces.withColumn("turn", F.row_number().over(within) - 1)
    joined = counted.join(sizes, (F.col("length") == F.col("of")) & (F.col("bucket") == F.col("part")))
    return joined.withColumn("rank", F.col("turn") + F.col("shift")).drop("bucket", "of", "part", "turn", "shift")


def pack(pieces: DataFrame, key: Sequence[str], sequence: int = SEQUENCE) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``pieces`` has a ``length`` from 1 to ``sequence``; it is read more than once, so it should be a written table.
    """
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `sequence` rows
    slots = places(pack_histogram(histogram, sequence))
    schema = "of long, low long, high long, copies long, first long, at long"
    where = pieces.sparkSession.createDataFrame(slots, schema)  # a few per length, whatever the number of pieces
    joined = ranked(pieces, key).join(
        F.broadcast(where), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high")))
    index = F.col("rank") - F.col("low")
    return joined.withColumns({
        "sequence_id": F.col("first") + F.floor(index / F.col("copies")).cast("long"),
        "offset": F.col("at") + F.pmod(index, F.col("copies")) * F.col("length"),
    }).drop("of", "low", "high", "copies", "first", "at", "rank")


def pack_documents(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
                   sequence: int = SEQUENCE) -> DataFrame:
    """Every piece of every document with its place; ``ids`` too unless only their checksum is wanted."""
    pieces = token_pieces(docs, tokenizer, text_col, [id_col], sequence).select(
        F.monotonically_increasing_id().alias("piece"), F.col(f"row.`{id_col}`").alias("doc_id"), "start", "length",
        F.crc32("ids").alias("ids_crc32"), "doc_tokens", *(["ids"] if with_ids else []))
    pieces = materialize(pieces, "pieces")  # so a piece keeps its number
    placed = pack(pieces.drop("ids"), ["piece"], sequence)
    if with_ids:  # the ids take no part in the ranking
        placed = placed.join(pieces.select("piece", "ids"), "piece")
    return placed.drop("piece")


def padding(filled: int, sequence: int = SEQUENCE) -> int:
    """Tokens added to a sequence: none at a power of two, else up to the sequence length."""
    return 0 if filled & (filled - 1) == 0 else sequence - filled


def read_ids(data: bytes) -> tuple[int, ...]:
    return struct.unpack(f"<{len(data) // 4}I", data)
