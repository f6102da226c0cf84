"""Mixing documents to target weights of domains: soft memberships, and rates by projected gradient.

A classifier fitted on labelled documents gives every document a probability per domain; nothing is
assigned hard. With n words and probabilities p of document i, its rate r is the number of times it
is to be seen. The rates minimise

    sum over domains d of (sum_i r_i n_i p_id - target_d)**2 / (sum_i n_i p_id),   r_i >= low,

by projected gradient from r = 1. A step changes a rate by the document's probabilities times the
domains' residuals, so a rate follows from the residuals of all steps and the document's own row: a
round is one pass over the table of probabilities that sums one number per domain, and no rates are
stored between rounds.

Edge cases: null and blank texts have no words; they have the probabilities of a text without
features, no weight, and keep the rate 1. Domains without a labelled document cannot be
recognised and are left out of the targets, whose shares are scaled to sum to 1. Without labelled
documents all rates are 1 and the domain is null. Repeated rows are mixed alike. Extra columns are
ignored.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.llm.fitting import FIT_BYTES, Adam, of_each_class
from halala.llm.shared import over_texts, written
from halala.llm.text import LOWER, SMALL, WHITE, Texts, as_texts, mix, slices

SLOTS = 1024
FIT_EACH, FIT_ROWS, FIT_STEPS = 1000, 8000, 120  # documents of each domain, about, and of all
ROUNDS, CLOSE = 40, 1e-4
MEMBERS = "doc_id bigint, rank bigint, n_words bigint, p array<double>"


def trigrams(texts: Texts) -> np.ndarray:
    """Square roots of the shares of hashed byte trigrams, A-Z lower-cased, in `SLOTS` slots."""
    n = len(texts)
    codes = LOWER[texts.data].astype(np.uint64)
    row = np.repeat(np.arange(n), np.diff(texts.offsets))
    if len(codes) < 3:
        return np.zeros((n, SLOTS), np.float32)
    key = mix(codes[:-2] | codes[1:-1] << np.uint64(8) | codes[2:] << np.uint64(16))
    slot = (key >> np.uint64(54)).astype(np.int64)
    inside = row[:-2] == row[2:]
    found = np.bincount((row[:-2] * SLOTS + slot)[inside], minlength=n * SLOTS).reshape(n, SLOTS)
    return np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1)).astype(np.float32)


@dataclass
class Softmax:
    domains: list[str]
    weights: dict[str, np.ndarray]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        s = (x @ self.weights["w"] + self.weights["b"]).astype(np.float64)
        s = np.exp(s - s.max(axis=1, keepdims=True))
        return s / s.sum(axis=1, keepdims=True)


def train(texts: pa.ChunkedArray | pa.Array, labels: list[str], steps: int = FIT_STEPS, at_once: int = 200) -> Softmax:
    domains = sorted(set(labels))
    model = Softmax(domains, {"w": np.zeros((SLOTS, len(domains))), "b": np.zeros(len(domains))})
    if len(domains) < 2:
        return model
    x = np.concatenate([trigrams(as_texts(texts.slice(a, at_once))) for a in range(0, len(texts), at_once)])
    y = np.array([domains.index(v) for v in labels])
    adam = Adam(model.weights, 0.3)
    for i in range(steps):
        adam.rate = 0.3 * (1 - 0.9 * i / steps)
        d = model.probabilities(x)
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        adam.step({"w": x.T @ d + 1e-5 * model.weights["w"], "b": d.sum(axis=0)})
    return model


def fitted(docs: DataFrame, labelled: DataFrame, each: int = FIT_EACH, rows: int = FIT_ROWS, size: int = FIT_BYTES) -> Softmax:
    """A classifier from labelled(doc_id, domain): about `each` rows of every domain, chosen by a hash of the id.

    A domain with fewer rows is used whole; of long documents the first `size` characters are fitted on.
    """
    known = labelled.select(F.col("doc_id").alias("id"), "domain").where("id is not null and domain is not null").distinct()
    few = of_each_class(known, "domain", ["id"], each, rows)
    texts = docs.select(F.col("doc_id").alias("id"), F.substring("text", 1, size).alias("text")).where("text is not null")
    got = texts.join(F.broadcast(few), "id").orderBy(F.xxhash64("id"), "id", "domain", "text").select("text", "domain").toArrow()
    return train(got.column("text"), got.column("domain").to_pylist())


def _members(sent):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for piece in slices(batches, limit=SMALL):
            texts = as_texts(piece.column("text"))
            p = model.probabilities(trigrams(texts))
            ends = np.arange(len(texts) + 1, dtype=np.int32) * p.shape[1]
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), piece.column("rank"), pa.array(texts.words(~WHITE).counts()), pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))],
                names=["doc_id", "rank", "n_words", "p"],
            )

    return of_batches


def rates_of(p: np.ndarray, steps: np.ndarray, low: float) -> np.ndarray:
    """Rates after all steps; a step's row holds residual / mass of each domain."""
    r = np.full(len(p), max(1.0, low))
    for step in steps:
        r = np.maximum(low, r - p @ step)
    return r


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _totals(steps: np.ndarray, low: float):
    """Words expected of each domain under the rates, summed per batch."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(steps.shape[1])
        for batch in batches:
            p = _matrix(batch.column("p"), steps.shape[1])
            total += (rates_of(p, steps, low) * batch.column("n_words").to_numpy()) @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["domain", "words"])

    return of_batches


def _rated(domains: list[str], steps: np.ndarray, low: float):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column("p"), len(domains))
            names = pa.array(domains, pa.string()).take(pa.array(p.argmax(axis=1)))
            columns = [batch.column(c) for c in ("doc_id", "rank", "n_words")]
            # Without words a document has no part in any total, and so no gradient.
            rate = np.where(batch.column("n_words").to_numpy() > 0, rates_of(p, steps, low), max(1.0, low))
            yield pa.RecordBatch.from_arrays([*columns, names, pa.array(p.max(axis=1)), pa.array(rate)], names=["doc_id", "rank", "n_words", "domain", "probability", "rate"])

    return of_batches


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], low: float = 0.0, keep_all: bool = False, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, rank, n_words, domain, probability, rate) for every row of docs(doc_id, text, …).

    `targets` are shares of words. The total stays that of the documents; with `keep_all` it is the
    least one at which no domain has to shrink, and no rate is below 1. `rank` is a hash of the text,
    with which repeated ids are told apart. Targets that are not met after `rounds` rounds give a warning that
    names the largest gap.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("rank"), "text")
    model = fitted(docs, labelled)
    if not model.domains:
        words = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))
        blank = [F.lit(None).cast("string").alias("domain"), F.lit(None).cast("double").alias("probability"), F.lit(1.0).alias("rate")]
        return keyed.select("doc_id", "rank", words.cast("bigint").alias("n_words"), *blank)
    members = written(over_texts(keyed, _members(spark.sparkContext.broadcast(model)), MEMBERS))

    def totals(steps: np.ndarray) -> np.ndarray:
        parts = members.select("n_words", "p").mapInArrow(_totals(steps, low), "domain bigint, words double")
        out = np.zeros(len(model.domains))
        for row in parts.groupBy("domain").agg(F.sum("words").alias("words")).collect():  # one row per domain
            out[row["domain"]] = row["words"]
        return out

    if keep_all:
        low = max(low, 1.0)
    steps = np.zeros((0, len(model.domains)))
    now = mass = totals(steps)
    share = np.array([max(0.0, targets.get(d, 0.0)) for d in model.domains])
    share = share / share.sum() if share.sum() else mass / max(mass.sum(), 1e-9)
    whole = mass.sum()
    if keep_all:
        whole = max((m / s for m, s in zip(mass, share, strict=True) if s > 0), default=whole)
    for _ in range(rounds):
        gap = now - share * whole
        if np.abs(gap).max() <= CLOSE * max(whole, 1):
            break
        steps = np.vstack([steps, np.divide(gap, mass, out=np.zeros_like(gap), where=mass > 0)])
        now = totals(steps)
    else:
        gap = now - share * whole
        if np.abs(gap).max() > CLOSE * max(whole, 1):
            worst = int(np.abs(gap).argmax())
            warnings.warn(
                f"mixing: after {rounds} rounds {model.domains[worst]} is off its target by {gap[worst] / max(whole, 1):+.4f} of all words;"
                " the targets may be out of reach of nonnegative rates",
                stacklevel=2,
            )
    kept = "doc_id bigint, rank bigint, n_words bigint, domain string, probability double, rate double"
    return members.mapInArrow(_rated(model.domains, steps, low), kept)


def copies(rate: Column, *key: str) -> Column:
    """A whole number of copies whose mean over documents is the rate; the same for the same key."""
    chance = F.pmod(F.xxhash64(*key, F.lit("mixing")), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (chance < rate - F.floor(rate)).cast("bigint")).cast("int")


def mixed(docs: DataFrame, rated: DataFrame) -> DataFrame:
    """The documents, each as often as its rate says, on average over documents; the columns of docs."""
    times = rated.groupBy("doc_id", "rank").agg(F.max("rate").alias("rate"))
    # The row as one value, so that its columns may have any names.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("place"))
    joined = rows.join(times, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("place") == F.col("rank")))
    often = joined.select("row", copies(F.col("rate"), "id", "place").alias("times")).where("times > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")
