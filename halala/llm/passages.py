"""Document quality by attention over passages: every passage is encoded, none is skipped.

A text is cut into passages of `PASSAGE` words. A passage is encoded by how its byte classes follow
each other and how its words repeat, within itself and within the document. A gated attention
network, fitted on document labels alone, weighs the passages of a document; the weighted sum of
their hidden vectors is scored.

Edge cases: null, empty and blank texts are one passage without words and get a score like any
other. Repeated rows are scored alike. Without labels of both values every document gets the share
of 1 among the labels, or 1 when there are none. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.fitting import FIT_BYTES, Adam, fold, sample, sigmoid
from halala.llm.shared import over_texts
from halala.llm.text import FIRST, SMALL, WHITE, Texts, as_texts, ranges, run_starts, slices

PASSAGE = 64  # words
FIT_ROWS = 3000
HIDDEN, GATE, EPOCHS = 24, 12, 60

# Classes of bytes: lower case, upper case, digit, white space, sentence marks, other marks, beyond ASCII, control.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[33:127] = 5
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, *range(9, 14)]] = 3
_CLASS[[ord(c) for c in ".,;:?'\"()-"]] = 4
_CLASS[128:] = 6
CLASSES = 8
FEATURES = CLASSES * CLASSES + CLASSES + 8


def _means(values: np.ndarray, passage: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    return np.bincount(passage, values, n) / np.maximum(sizes, 1)


def encode(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Feature rows of all passages, and the first passage of each text."""
    words = texts.words(~WHITE)
    counts = words.counts()
    parts = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(parts)])
    n = int(first[-1])
    rows = words.rows()
    place = np.arange(len(rows)) - words.first[rows]
    own = first[rows] + place // PASSAGE  # passage of each word
    sizes = np.bincount(own, minlength=n)
    out = np.zeros((n, FEATURES), np.float32)
    if len(own):
        kinds = _CLASS[texts.data]
        # Bytes from a word's start to the next word's start, in the passage of the word.
        ends = np.append(words.starts[1:], len(kinds))
        ends = np.minimum(ends, texts.offsets[rows + 1])
        length = ends - words.starts
        to = np.cumsum(length)
        at = np.repeat(words.starts - (to - length), length) + np.arange(int(to[-1]))
        of = np.repeat(own, length)
        here = kinds[at].astype(np.int64)
        follow = np.append(here[1:], 3)
        follow[np.append(of[1:] != of[:-1], True)] = 3
        total = np.bincount(of, minlength=n)[:, None]
        pairs = np.bincount(of * 64 + here * 8 + follow, minlength=n * 64).reshape(n, 64)
        out[:, :64] = pairs / np.maximum(total, 1)
        out[:, 64:72] = pairs.reshape(n, 8, 8).sum(axis=2) / np.maximum(total, 1)
        hashes = words.hashes()
        size = (words.ends - words.starts).astype(np.float64)
        before = np.zeros(len(rows), bool)
        before[1:] = (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])
        out[:, 72] = _means(np.minimum(size, 40), own, n, sizes) / 10
        out[:, 73] = _means(np.minimum(size, 40) ** 2, own, n, sizes) / 100
        out[:, 74] = _means(before, own, n, sizes)
        seen = np.zeros(len(rows), bool)  # the word was in this document before
        order = np.lexsort((hashes, rows))
        seen[order[1:]] = (hashes[order][1:] == hashes[order][:-1]) & (rows[order][1:] == rows[order][:-1])
        out[:, 75] = _means(seen, own, n, sizes)
        runs = run_starts(words, 3)
        threes = FIRST.runs(hashes, runs, runs + 3)
        again = np.zeros(len(rows), bool)  # the three words from here were
        order = np.lexsort((threes, rows[runs]))
        again[runs[order[1:]]] = (threes[order][1:] == threes[order][:-1]) & (rows[runs][order][1:] == rows[runs][order][:-1])
        out[:, 76] = _means(again, own, n, sizes)
        letter = np.concatenate([[0], np.cumsum((kinds <= 1) | (kinds == 6))])
        bare = (letter[words.ends] - letter[words.starts]) == 0
        out[:, 77] = _means(bare, own, n, sizes)
        out[:, 78] = np.log1p(sizes) / 4
    out[:, 79] = np.repeat(np.log1p(counts), parts) / 8
    return out, first


@dataclass
class Attention:
    """Gated attention over a bag of passages, and a score of the weighted hidden vector."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]
    constant: float | None = None

    def forward(self, x: np.ndarray, first: np.ndarray):
        w = self.weights
        h = np.tanh(x @ w["hidden"] + w["hidden0"])
        v, u = np.tanh(h @ w["value"]), sigmoid(h @ w["gate"])
        e = (v * u) @ w["attend"]
        e = np.exp(e - np.maximum.reduceat(e, first[:-1]).repeat(np.diff(first)))
        a = e / np.add.reduceat(e, first[:-1]).repeat(np.diff(first))
        z = np.add.reduceat(a[:, None] * h, first[:-1], axis=0)
        return h, v, u, a, z, z @ w["out"] + w["out0"]

    def scores(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return sigmoid(self.forward((x - self.mean) / self.scale, first)[-1])

    def gradients(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        h, v, u, a, z, s = self.forward(x, first)
        sizes = np.diff(first)
        d = (sigmoid(s) - y) / len(y)
        dz = np.repeat(d[:, None] * w["out"], sizes, axis=0)
        da = (dz * h).sum(axis=1)
        de = a * (da - np.add.reduceat(a * da, first[:-1]).repeat(sizes))
        dv, du = de[:, None] * w["attend"] * u * (1 - v * v), de[:, None] * w["attend"] * v * u * (1 - u)
        dh = (a[:, None] * dz + dv @ w["value"].T + du @ w["gate"].T) * (1 - h * h)
        found = {"hidden": x.T @ dh, "hidden0": dh.sum(axis=0), "value": h.T @ dv, "gate": h.T @ du, "attend": (v * u).T @ de, "out": z.T @ d, "out0": d.sum()}
        return {k: np.asarray(g) + 1e-4 * w[k] for k, g in found.items()}

    @classmethod
    def fit(cls, bags: list[np.ndarray], labels: np.ndarray, epochs: int = EPOCHS) -> Attention:
        return cls.fit_rows(np.concatenate([np.zeros((0, FEATURES), np.float32), *bags]).astype(np.float32), np.array([len(b) for b in bags]), labels, epochs)

    @classmethod
    def fit_rows(cls, x: np.ndarray, sizes: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS) -> Attention:
        """Fit on the passages of all bags, one bag after the other; x is scaled in place, not copied."""
        if len(set(labels.tolist())) < 2:
            return cls(np.zeros(FEATURES), np.ones(FEATURES), {}, float(labels.mean()) if len(labels) else 1.0)
        start = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        mean = x.mean(axis=0, dtype=np.float64)
        scale = x.std(axis=0, dtype=np.float64) + 1e-3
        x -= mean.astype(np.float32)
        x /= scale.astype(np.float32)
        draw = np.random.default_rng(7)
        size = {"hidden": (FEATURES, HIDDEN), "hidden0": (HIDDEN,), "value": (HIDDEN, GATE), "gate": (HIDDEN, GATE), "attend": (GATE,), "out": (HIDDEN,), "out0": ()}
        model = cls(mean, scale, {k: np.array(draw.normal(0, (1 / s[0]) ** 0.5 if s else 0.1, s)) for k, s in size.items()})
        adam = Adam(model.weights, 0.01)
        rounds = max(epochs, min(1500, 60 * 400 // max(1, len(sizes))))
        for epoch in range(rounds):
            adam.rate = 0.01 * (1 - epoch / rounds) + 1e-4
            order = draw.permutation(len(sizes))
            for a in range(0, len(order), 64):
                some = order[a : a + 64]
                first = np.concatenate([[0], np.cumsum(sizes[some])])
                adam.step(model.gradients(x[np.repeat(start[some], sizes[some]) + ranges(sizes[some])].astype(np.float64), first, labels[some]))
        return model


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for piece in slices(batches, limit=SMALL):
        x, first = encode(as_texts(piece.column("text")))
        raw = [x[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)]
        yield pa.RecordBatch.from_arrays([pa.array(raw, pa.binary()), piece.column("label")], names=["bag", "label"])


def fitted(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS, size: int = FIT_BYTES) -> Attention:
    """A model of labels(doc_id, label) over docs(doc_id, text); passages are encoded by the tasks."""
    got = over_texts(sample(docs, labels, label, rows, size), _encoded, "bag binary, label int").toArrow()
    known = got.column("label").to_numpy().astype(np.float64)
    sizes = pc.binary_length(got.column("bag")).to_numpy().astype(np.int64) // (4 * FEATURES)
    raw = bytearray()
    for bag in got.column("bag"):
        raw += bag.as_buffer()
    del got
    return Attention.fit_rows(np.frombuffer(raw, np.float32).reshape(-1, FEATURES), sizes, known)


def _scores(sent):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for piece in slices(batches, limit=SMALL):
            score = model.scores(*encode(as_texts(piece.column("text"))))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    return of_batches


def scored(docs: DataFrame, model: Attention) -> DataFrame:
    """(doc_id, score) of every row of docs(doc_id, text, …); higher is better."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return over_texts(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), _scores(sent), "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, parts: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted); the fold 0 of `parts` by crc32 of the id is never fitted on."""
    model = fitted(docs, labels.where(fold("doc_id", parts) != 0))
    held_out = F.coalesce(fold("doc_id", parts) == 0, F.lit(False))
    return scored(docs, model).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _filter(sent, threshold: float):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for piece in slices(batches, limit=SMALL):
            yield piece.filter(pa.array(model.scores(*encode(as_texts(piece.column("text")))) >= threshold))

    return of_batches


def kept(docs: DataFrame, model: Attention, threshold: float) -> DataFrame:
    """The rows of docs whose score reaches the threshold; nothing is shuffled."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return over_texts(docs, _filter(sent, threshold), docs.schema)
