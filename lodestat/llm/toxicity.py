"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on passages of toxic documents and one on
ordinary text.  A window of text that compresses to fewer bytes with the toxic dictionary
than with the ordinary one resembles toxic text; the difference, in bytes, is the window's
distance.  A document's evidence is made of its largest window distances, and calibrated
thresholds (a logistic curve fitted to training documents) turn evidence into a score.

Training works on a bounded sample of labelled documents (``TRAIN_DOCS`` of each label, the
smallest by a hash of the id) on the driver, of a long text on passages from all over it.
Toxic documents are mostly ordinary text, so the passages that train the toxic dictionary
are picked around words that toxic documents use far more often; its other content is that
of the ordinary one.  Half of the sample trains the dictionaries, the other half calibrates, as
documents that a dictionary has seen would look more extreme than new ones.

Scoring is one pass over whole texts, whatever their length, word by word.  A null or empty
text has no windows and the score of no evidence.  Repeated rows are scored alike.  An id that
is labelled both ways teaches nothing.  Further columns of the input are ignored.
Without labelled documents of both kinds every score is 0.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestat.llm.common import give_back, passages, rows_with

#: Labelled documents of each label that training may use.
TRAIN_DOCS = 3000
#: Training takes so many passages of so many characters from all over a longer text (scoring reads all of it).
PASSAGES, PASSAGE_CHARS = 20, 1000
ORDINARY_BYTES = 12 << 10
TOXIC_BYTES = 4 << 10
LEVEL = 3
#: Distances, in bytes, from which a window counts towards each threshold.
THRESHOLDS = (3, 4, 5, 6, 7)
#: A window is a word between two carriers that both dictionaries hold.  Without them a frame's fixed cost, and the last
#: bytes, where zstandard starts no match, would hide the difference that a short word makes.
CARRIER = b"|0123456789=0123456789=01234567|"
TAIL = CARRIER[:16]
#: Words whose distance a task remembers; beyond, it starts anew.
KNOWN = 100_000
#: Lengths of beginnings of words that count like words.
STEMS = (4, 5, 6)
_WORD = re.compile(r"[^\W\d_]+")


def windows(text: str | None) -> list[str]:
    """The whole text as windows of one word each, in lower case."""
    return (text or "").lower().split()


class Distance:
    """Bytes that a window is smaller with the toxic dictionary than with the ordinary one."""

    def __init__(self, toxic: bytes, ordinary: bytes) -> None:
        self.sizes = [self._compressor(d + CARRIER) for d in (toxic, ordinary)]
        self.known: dict[str, int] = {}

    @staticmethod
    def _compressor(dictionary: bytes):
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        data.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_checksum=False, write_dict_id=False)

    def __call__(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= KNOWN:
                self.known.clear()
            window = CARRIER + f" {word} ".encode() + TAIL
            toxic, ordinary = (len(c.compress(window)) for c in self.sizes)
            found = self.known[word] = ordinary - toxic
        return found

    def evidence(self, text: str | None) -> list[int]:
        """The number of windows, and how many reach each threshold."""
        words = windows(text)
        near = [d for d in map(self, words) if d >= THRESHOLDS[0]]
        return [len(words), *[sum(d >= t for d in near) for t in THRESHOLDS]]


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """The most useful segments of the samples, by zstandard's own training; all of a small sample."""
    total = sum(map(len, samples))
    if total <= size:
        return b"".join(samples)
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few or too uniform samples to train on
        return b"".join(samples)[-size:]


def _distinct(texts: list[str]) -> list[list[str]]:
    """The words of each text, without texts of which half the word triples were seen before: copies add no knowledge."""
    seen, out = set(), []
    for text in texts:
        words = text.lower().split()
        triples = set(zip(words, words[1:], words[2:], strict=False))
        if triples and 2 * len(triples & seen) > len(triples):
            continue
        seen |= triples
        out.append(words)
    return out


def _stems(words: list[str]) -> set[str]:
    """Each word's letters, and beginnings of it that a family of words may share."""
    found = set()
    for word in set(words):
        for letters in _WORD.findall(word):
            found.add(letters + " ")
            found.update(letters[:k] for k in STEMS if len(letters) > k)
    return found


def toxic_words(toxic: list[list[str]], ordinary: list[list[str]]) -> list[str]:
    """Words and beginnings of words that toxic documents hold far more often, the most telling last."""
    has, lacks = Counter(), Counter()
    for words in toxic:
        has.update(_stems(words))
    for words in ordinary:
        lacks.update(_stems(words))
    scale = max(1, len(toxic)) / max(1, len(ordinary))
    least = max(3, len(toxic) // 200)
    gain = {w: n * np.log(n / (scale * lacks[w] + 0.5)) for w, n in has.items() if n >= least and n > 10 * scale * lacks[w] + 1}
    return sorted(gain, key=lambda w: (gain[w], w))


class Model:
    """Two dictionaries and the calibrated curve."""

    def __init__(self, toxic: bytes, ordinary: bytes, weights: np.ndarray) -> None:
        self.toxic, self.ordinary, self.weights = toxic, ordinary, weights

    def scorer(self):
        distance = Distance(self.toxic, self.ordinary)
        return lambda text: float(_curve(_features(np.array([distance.evidence(text)])), self.weights)[0])


def _features(found: np.ndarray) -> np.ndarray:
    """Counts at each threshold and their rates, with the text's length."""
    n, counts = found[:, :1], found[:, 1:]
    return np.hstack([np.log1p(counts), np.log1p(100 * counts / np.maximum(n, 1)), np.log1p(n), np.ones((len(found), 1))])


def _curve(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))


def _fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps with a little ridge."""
    weights = np.zeros(x.shape[1])
    for _ in range(50):
        p = _curve(x, weights)
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(x.shape[1])
        step = np.linalg.solve(h, x.T @ (y - p) - 1e-3 * weights)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(toxic: list[str], ordinary: list[str]) -> Model | None:
    """A model from texts of the two kinds; none if either is missing."""
    if not toxic or not ordinary:
        return None
    # Even places train, odd places calibrate; with a handful of documents both do both.
    few = min(len(toxic), len(ordinary)) < 8
    learn = [_distinct(x if few else x[::2]) for x in (toxic, ordinary)]
    test = [x if few else x[1::2] for x in (toxic, ordinary)]
    plain = [f" {' '.join(words[i: i + 4])} ".encode() for words in learn[1] for i in range(0, len(words), 4)]
    base = _dictionary(plain[:: max(1, len(plain) // 40_000)], ORDINARY_BYTES)
    telling = toxic_words(*learn)
    known = {w.strip() for w in telling}
    passages = []
    for words in learn[0]:
        for word in words:
            letters = "".join(_WORD.findall(word))
            if letters in known or any(letters[:k] in known for k in STEMS):
                passages.append(f" {letters} ".encode())
    passages = passages or [f" {w} ".encode() for words in learn[0] for w in words]
    common = [w for w, _ in sorted(Counter(passages).items(), key=lambda x: (x[1], x[0]))]  # the most frequent last, where matches are cheapest
    # Toxic documents are ordinary text as well, so the ordinary content comes first in their dictionary.
    special = b"".join(common)[-TOXIC_BYTES:] if len(b"".join(common)) <= TOXIC_BYTES else _dictionary(passages, TOXIC_BYTES)
    distance = Distance(base + special, base)
    found = np.array([distance.evidence(t) for t in [*test[0], *test[1]]])
    y = np.repeat([1.0, 0.0], [len(test[0]), len(test[1])])
    return Model(base + special, base, _fit_curve(_features(found), y))


def training_texts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   label_id: str = "doc_id") -> tuple[list[str], list[str]]:
    """At most ``TRAIN_DOCS`` texts of each label, chosen by a hash of the id."""
    marked = rows_with(labels, of=label_id, label=label_col).where("label IS NOT NULL AND of IS NOT NULL")
    marked = marked.groupBy("of").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    chosen = None
    for value in (0, 1):
        part = marked.where(F.col("label") == value).orderBy(F.xxhash64("of"), "of").limit(TRAIN_DOCS)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = rows_with(docs, id=id_col, text=text_col).where("text IS NOT NULL").join(F.broadcast(chosen), F.col("id") == F.col("of"))
    # Rows that repeat an id, however many, are reduced to the least text before any come to the driver.
    rows = texts.groupBy("id", "label").agg(F.min(passages("text", PASSAGES, PASSAGE_CHARS)).alias("text")).collect()
    rows = sorted(rows, key=lambda r: r["id"])
    return [r["text"] for r in rows if r["label"] == 1], [r["text"] for r in rows if r["label"] == 0]


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every row; whole texts are read."""
    rows = rows_with(docs, doc_id=id_col, text=text_col)
    if model is None:
        return rows.select("doc_id", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or model.scorer()
            values = np.array([scorer(t.as_py()) for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), pa.array((values >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(compute, f"doc_id {kind}, score double, predicted int")


def without_toxic(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is predicted toxic; rows are dropped where they are read."""
    if model is None:
        return docs

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = model.scorer()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            yield batch.filter(pa.array([scorer(t.as_py()) < 0.5 for t in texts], pa.bool_()))
        del scorer
        give_back()

    return docs.mapInArrow(keep, docs.schema)
