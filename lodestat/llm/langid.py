"""Language identification by a bidirectional gated recurrent network over bytes.

Each byte has an input vector; a light gated unit (one update gate, no reset gate) reads the
text forwards, another backwards, and the two states label every position with language
probabilities.  A document's probabilities are the mean of its letters' positions.  The
network is trained in numpy by backpropagation through time.

Training takes a bounded sample of labelled documents on the driver: for each language
``PER_LANGUAGE`` documents, the smallest by a hash of id and text, of each ``TRAIN_BYTES`` bytes
from places all over the text.  The number of languages is that of the distinct labels.

Prediction reads whole texts.  A text is cut into lanes of ``LANE`` bytes, each with a margin of
the same text's bytes to warm the states up, and thousands of lanes are stepped together; gates
are piecewise linear, so that a step is a few matrix and vector operations.  Where a lane's
text has not begun yet the state is held at zero, so a text is read alike among any others.

A null text, or one without a letter, is ``und`` with score 0.  Scores are rounded to
``DIGITS`` digits, within which sums in another order agree; of equal probabilities the
first language counts.  Repeated rows are predicted alike.  Very long texts are more lanes, stepped
some at a time.  Further columns are ignored; without labelled documents everything is ``und``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestat.llm.common import in_blocks, passages, rows_with

PER_LANGUAGE = 400
TRAIN_BYTES = 1024
#: Training takes so many passages of so many characters from all over a longer text.
PASSAGES = 16
PASSAGE_CHARS = 256
#: Documents are chosen by a hash into so many turns, with this many times as many candidates as are wanted.
TURNS = 1 << 40
SPARE = 2
HIDDEN = 8
STEPS = 64
UPDATES = 400
BATCH = 192
RATE = 0.02
LANE = 256
MARGIN = 16
#: Stands for "no byte"; lanes stepped together.
NOTHING = 256
LANES = 2048
DIGITS = 5
#: Bytes predicted at a time.
BATCH_BYTES = 2 << 20
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def _gate(x: np.ndarray) -> np.ndarray:
    """Piecewise linear sigmoid, in place."""
    x *= np.float32(0.25)
    x += np.float32(0.5)
    return np.clip(x, 0, 1, out=x)


class Direction:
    """One gated unit: input vectors of the 256 bytes, and the weights of the state."""

    def __init__(self, rng: np.random.Generator, hidden: int) -> None:
        self.input = rng.normal(0, 0.3, (256, 2 * hidden)).astype(np.float32)
        self.state = (rng.normal(0, 0.5, (hidden, 2 * hidden)) / np.sqrt(hidden)).astype(np.float32)
        self.input[:, :hidden] += 0.5  # gates start open for memory

    def held(self) -> np.ndarray:
        """The input vectors with one more that holds a zero state at zero: a shut gate and no candidate."""
        none = np.zeros((1, self.input.shape[1]), self.input.dtype)
        none[0, : none.shape[1] // 2] = -100
        return np.concatenate([self.input, none])


class Network:
    def __init__(self, languages: list[str], seed: int = 5, hidden: int = HIDDEN) -> None:
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.ahead, self.back = Direction(rng, hidden), Direction(rng, hidden)
        self.out = rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32)
        self.bias = np.zeros(len(languages), np.float32)

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.input, self.ahead.state, self.back.input, self.back.state, self.out, self.bias]

    # h' = z h + (1 - z) c,  z = gate(x_z + h U_z),  c = clip(x_c + h U_c, -1, 1)

    def _walk(self, unit: Direction, data: np.ndarray, keep: bool):
        """States after every step of ``data`` (steps, lanes); with the gates if they are kept for learning."""
        steps, lanes = data.shape
        n = self.hidden
        states = np.empty((steps, lanes, n), np.float32)
        h = np.zeros((lanes, n), np.float32)
        kept = []
        table = unit.input if keep else unit.held()
        for t in range(steps):
            raw = table[data[t]]
            raw += h @ unit.state
            z, c = raw[:, :n], raw[:, n:]
            if keep:
                slope_z, slope_c = (np.abs(z) < 2), (np.abs(c) < 1)
                z, c = _gate(z.copy()), np.clip(c, -1, 1)
                kept.append((h, z, c, slope_z, slope_c))
            else:
                z = _gate(z)
                np.clip(c, -1, 1, out=c)
            h = h - c
            h *= z
            h += c
            states[t] = h
        return states, kept

    def _learn_unit(self, unit: Direction, data: np.ndarray, kept: list, gradient: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backpropagation through time: gradients of the unit's weights from those of its states."""
        n = self.hidden
        d_input, d_state = np.zeros_like(unit.input), np.zeros_like(unit.state)
        d_h = np.zeros_like(gradient[0])
        for t in range(len(data) - 1, -1, -1):
            d_h = d_h + gradient[t]
            h, z, c, slope_z, slope_c = kept[t]
            d_raw = np.concatenate([d_h * (h - c) * slope_z * 0.25, d_h * (1 - z) * slope_c], axis=1)
            np.add.at(d_input, data[t], d_raw)
            d_state += h.T @ d_raw
            d_h = d_h * z + d_raw @ unit.state.T
        return d_input, d_state

    def probabilities(self, data: np.ndarray, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        n = self.hidden
        logits = ahead @ self.out[:n]
        logits += back @ self.out[n:]
        logits += self.bias
        logits -= logits.max(axis=-1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=-1, keepdims=True)
        return logits

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean loss over all positions, and the gradients of all weights."""
        n = self.hidden
        turned = data[::-1]
        ahead, kept_ahead = self._walk(self.ahead, data, True)
        back, kept_back = self._walk(self.back, turned, True)
        back = back[::-1]
        p = self.probabilities(data, ahead, back)
        lanes = np.arange(data.shape[1])
        loss = -float(np.log(np.maximum(p[:, lanes, label], 1e-9)).mean())
        p[:, lanes, label] -= 1
        p /= data.size
        flat = p.reshape(-1, p.shape[-1])
        d_out = np.concatenate([ahead.reshape(-1, n).T @ flat, back.reshape(-1, n).T @ flat])
        d_ahead = self._learn_unit(self.ahead, data, kept_ahead, p @ self.out[:n].T)
        d_back = self._learn_unit(self.back, turned, kept_back, (p @ self.out[n:].T)[::-1])
        return loss, [*d_ahead, *d_back, d_out, flat.sum(axis=0)]

    def fit(self, pieces: np.ndarray, label: np.ndarray, updates: int = UPDATES, seed: int = 6) -> float:
        """Adam over random batches of ``pieces`` (pieces, steps); returns the last loss."""
        rng = np.random.default_rng(seed)
        mean = [np.zeros_like(w) for w in self.weights()]
        square = [np.zeros_like(w) for w in self.weights()]
        loss = 0.0
        for step in range(1, updates + 1):
            pick = rng.integers(0, len(pieces), BATCH)
            loss, gradients = self.gradients(np.ascontiguousarray(pieces[pick].T), label[pick])
            rate = RATE * min(1.0, 2 * (1 - step / (updates + 1)))
            for w, g, m, v in zip(self.weights(), gradients, mean, square, strict=True):
                g = np.clip(g, -1, 1)
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-6)).astype(np.float32)
        return loss

    def pooled(self, parts: list[bytes]) -> np.ndarray:
        """Mean language probabilities at the letters of each text."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        lanes = -(-sizes // LANE)
        room = lanes * LANE + 2 * MARGIN
        begin = np.cumsum(room) - room
        data = np.full(int(room.sum()), NOTHING, np.uint16)
        inside = np.arange(int(sizes.sum())) + np.repeat(begin + MARGIN - (np.cumsum(sizes) - sizes), sizes)
        data[inside] = np.frombuffer(b"".join(parts), np.uint8)
        owner = np.repeat(np.arange(len(parts)), lanes)
        turn = np.arange(len(owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        start = begin[owner] + turn * LANE
        used = np.minimum(LANE, sizes[owner] - turn * LANE)
        sums, letters = np.zeros((len(owner), len(self.languages))), np.zeros(len(owner))
        order = np.argsort(-used, kind="stable")  # lanes of one length together, so that few steps are idle
        for at in range(0, len(order), LANES):
            own = order[at: at + LANES]
            steps = int(used[own[0]])
            part = data[start[own] + np.arange(steps + 2 * MARGIN)[:, None]]
            ahead = self._walk(self.ahead, part[: steps + MARGIN], False)[0][MARGIN:]
            back = self._walk(self.back, part[MARGIN:][::-1], False)[0][::-1][:steps]
            core = part[MARGIN: MARGIN + steps]
            letter = ((core >= 128) & (core < NOTHING)) | ((core >= 97) & (core <= 122))
            sums[own] = np.einsum("slk,sl->lk", self.probabilities(core, ahead, back), letter.astype(np.float32))
            letters[own] = letter.sum(axis=0)
        first = np.cumsum(lanes) - lanes
        return np.add.reduceat(sums, first, axis=0) / np.maximum(np.add.reduceat(letters, first), 1)[:, None]

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and probability of each text."""
        known = [bool(t) and _LETTER.search(t) is not None for t in texts]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        chosen = [i for i, k in enumerate(known) if k]
        if not chosen or not self.languages:
            return names, scores
        mean = self.pooled([b" " + texts[i].lower().encode("utf-8", "replace") + b" " for i in chosen]).round(DIGITS)
        best = mean.argmax(axis=1)
        for row, i in enumerate(chosen):
            names[i] = self.languages[best[row]]
            scores[i] = min(1.0, float(mean[row, best[row]]))
        return names, scores


def train(rows: list[tuple[str, str]], updates: int = UPDATES) -> Network:
    """A network from (language, text) pairs."""
    languages = sorted({lang for lang, _ in rows})
    network = Network(languages)
    pieces, label = [], []
    for lang, text in rows:
        data = text.lower().encode()
        step = max(STEPS, len(data) // (TRAIN_BYTES // STEPS))
        for a in range(0, len(data), step):
            part = data[a: a + STEPS]
            if len(part) == STEPS or a == 0:
                pieces.append(np.frombuffer(part.ljust(STEPS), np.uint8))
                label.append(languages.index(lang))
    if len(languages) > 1:
        label = np.array(label)
        # Languages weigh alike, whatever their share of the sample.
        most = np.bincount(label).max()
        even = np.concatenate([np.resize(np.flatnonzero(label == k), most) for k in range(len(languages))])
        network.fit(np.array(pieces)[even], label[even], updates)
    return network


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> list[tuple[str, str]]:
    """At most ``PER_LANGUAGE`` texts with letters of each language, chosen by a hash of id and text."""
    rows = rows_with(docs, id=id_col, text=text_col, lang=lang_col).where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    # Equal rows have one key, and so have copies without an id: they count, and are chosen, once.
    rows = rows.withColumn("key", F.xxhash64("id", "text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("key").alias("n")).collect()}  # one row per language
    # A share of each language by hash, about SPARE times the wanted rows, so that only those are shuffled.
    turn = F.pmod(F.xxhash64("key"), F.lit(TURNS))
    limit = F.lit(0)
    for lang, n in sizes.items():
        limit = F.when(F.col("lang") == lang, F.lit(min(TURNS, TURNS * SPARE * PER_LANGUAGE // n + 1))).otherwise(limit)
    part = rows.where(turn < limit).select("lang", turn.alias("turn"), "key", passages("text", PASSAGES, PASSAGE_CHARS).alias("text"))
    part = part.groupBy("lang", "turn", "key").agg(F.min("text").alias("text"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("turn", "key"))
    found = part.withColumn("place", place).where(F.col("place") <= PER_LANGUAGE).collect()
    return [(r["lang"], r["text"]) for r in sorted(found, key=lambda r: (r["turn"], r["key"], r["lang"]))]


def identify(docs: DataFrame, network: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row; whole texts are read."""
    rows = rows_with(docs, doc_id=id_col, text=text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in in_blocks(batches, lambda b: b.column(1).nbytes, BATCH_BYTES):
            names, scores = network.predict(block.column("text").to_pylist())
            yield from pa.table({"doc_id": block.column("doc_id"), "lang_pred": names, "score": scores}).to_batches()

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
