"""Bounded samples of labelled documents to fit classifiers on, and small pieces of numpy training."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FIT_ROWS = 3000  # labelled documents of each class that a fit reads, about, at most
FIT_BYTES = 16384  # longer texts are scored like all others, but not fitted on


def fold(doc_id: str, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of parts."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))


def about(rows: DataFrame, wanted: int, *key: str) -> DataFrame:
    """All rows when there are at most `wanted`, else about so many, chosen by a hash of the key.

    The rows are counted and then filtered, so nothing is sorted or gathered to choose them.
    """
    count = rows.count()
    if count <= wanted:
        return rows
    place = F.pmod(F.xxhash64(*key, F.lit("fit")), F.lit(1 << 40))
    return rows.where(place < int(wanted / count * (1 << 40)))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int = FIT_ROWS, size: int = FIT_BYTES) -> DataFrame:
    """(text, label) of about `rows` labelled documents at most per value 0 and 1, chosen by a hash of the id.

    The chosen ids are few, so they are sent to the documents; no text is shuffled but the sample's.
    Ids whose document is missing or longer than `size` bytes are left out.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("label")).where("id is not null").distinct()
    chosen = about(known.where("label = 0"), rows, "id").union(about(known.where("label = 1"), rows, "id"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").where(F.octet_length("text") <= size)
    return texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id", "label", "text").select("text", "label")


def of_each_class(rows: DataFrame, label: str, key: list[str], wanted: int, most: int) -> DataFrame:
    """About `wanted` rows of each value of `label` at most, and all rows of the rarer values, by a hash of the key.

    Counts are taken per class, so a class with few rows is kept whole however large the others are.
    When there are more than most / wanted classes each gets its part of `most`; of more than `most`
    classes the most frequent ones are used.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("n_of_class")).orderBy(F.desc("n_of_class"), label).limit(most)
    few = counts.toArrow()  # at most `most` names
    names, n = few.column(label), few.column("n_of_class").to_pylist()
    each = min(wanted, most // max(1, len(names)))
    whole = 1 << 40
    if not len(names):
        return rows.limit(0)
    shares = pa.array([int(min(1.0, each / count) * whole) for count in n], pa.int64())
    # From Arrow, a local table needs no Python workers of its own, which would stay beside those of the texts.
    chosen = rows.sparkSession.createDataFrame(pa.table([names, shares], names=["class_name", "share"]))
    place = F.pmod(F.xxhash64(*key, F.lit("fit")), F.lit(whole))
    return rows.join(F.broadcast(chosen), F.col(label) == F.col("class_name")).where(place < F.col("share")).select(*rows.columns)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Adam:
    """Step sizes per weight from running moments of the gradient."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.99**self.t)
            self.weights[k] -= self.rate * m / (np.sqrt(v) + 1e-8)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 30, weight: np.ndarray | None = None) -> np.ndarray:
    """Weights of a logistic regression with a bias as last weight, by Newton steps; rows may be weighted."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = (np.ones(len(x)) if weight is None else weight) / len(x)
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        g = x.T @ (weight * (p - y)) + ridge * w
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-9) * np.eye(len(w))
        w -= np.linalg.solve(h, g)
    return w
