"""Scores of the networks, and the order of fingerprinted documents, against plain loops."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from halala.llm import gru, passages, weighted
from halala.llm.text import as_texts

TEXTS = ["The cat, the CAT!", "é ü 漢字 und so weiter", "x" * 300, "", "12 !!", None, "a b " * 200]


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def plain_language(network, text):
    """Mean probabilities over the letters, byte by byte, in both directions."""
    n, w = gru.HIDDEN, network.weights
    data = [b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()]
    total, letters = np.zeros(len(network.languages)), 0

    def states(side, codes):
        h, out = [0.0] * n, []
        for code in codes:
            x, u = w[side + "x"][code], [sum(h[i] * w[side + "h"][i][j] for i in range(n)) for j in range(3 * n)]
            z = [sigmoid(x[j] + u[j]) for j in range(n)]
            r = [sigmoid(x[n + j] + u[n + j]) for j in range(n)]
            new = [math.tanh(x[2 * n + j] + r[j] * u[2 * n + j]) for j in range(n)]
            h = [new[j] + z[j] * (h[j] - new[j]) for j in range(n)]
            out.append(h)
        return out

    for a in range(0, len(data), gru.STRETCH):
        part = data[a : a + gru.STRETCH]
        forth, back = states("f", part), states("b", part[::-1])[::-1]
        for code, f, b in zip(part, forth, back, strict=True):
            if 97 <= code <= 122 or code >= 128:
                s = [sum(x * w["out"][i][k] for i, x in enumerate([*f, *b])) + w["out0"][k] for k in range(len(network.languages))]
                e = [math.exp(x - max(s)) for x in s]
                total += np.array(e) / sum(e)
                letters += 1
    return total / letters if letters else total


def test_language_scores_equal_plain_loops(spark):
    draw = np.random.default_rng(12)
    network = gru.Network.blank(["de", "en", "fr"])
    for k, v in network.weights.items():
        network.weights[k] = v.astype(np.float64) + draw.normal(0, 0.7, v.shape)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in gru.predicted(df, network).collect()}
    for i, text in enumerate(TEXTS):
        p = plain_language(network, text)
        if not any(c.isalpha() for c in text or ""):
            assert (got[i]["lang_pred"], got[i]["score"]) == (gru.UNKNOWN, 0.0)
            continue
        assert got[i]["lang_pred"] == network.languages[int(p.argmax())]
        assert got[i]["score"] == pytest.approx(p.max(), rel=1e-9)


def plain_quality(model, rows):
    """Gated attention over the passages' features, one number at a time."""
    w = model.weights

    def times(v, m, bias=None):
        return [sum(a * b for a, b in zip(v, col, strict=True)) + (bias[j] if bias is not None else 0.0) for j, col in enumerate(m.T)]

    hidden, wanted = [], []
    for row in rows:
        x = [(float(a) - m) / s for a, m, s in zip(row, model.mean, model.scale, strict=True)]
        h = [math.tanh(v) for v in times(x, w["hidden"], w["hidden0"])]
        gated = [math.tanh(v) * sigmoid(u) for v, u in zip(times(h, w["value"]), times(h, w["gate"]), strict=True)]
        hidden.append(h)
        wanted.append(sum(a * b for a, b in zip(gated, w["attend"], strict=True)))
    share = [math.exp(e - max(wanted)) for e in wanted]
    z = [sum(s * h[j] for s, h in zip(share, hidden, strict=True)) / sum(share) for j in range(len(hidden[0]))]
    return sigmoid(sum(a * b for a, b in zip(z, w["out"], strict=True)) + w["out0"])


def test_quality_scores_equal_plain_loops(spark):
    texts = [" ".join(f"w{(i * j) % 17}." for j in range(1, 40 + 30 * i)) for i in range(6)] + ["!!! $$$ " * (20 + i) for i in range(6)]
    x, first = passages.encode(as_texts(pa.array(texts)))
    model = passages.Attention.fit([x[a:b] for a, b in zip(first, first[1:], strict=False)], np.array([1.0] * 6 + [0.0] * 6), epochs=20)
    df = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in passages.scored(df, model).collect()}
    x, first = passages.encode(as_texts(pa.array([*texts, None, ""])))
    for i, (a, b) in enumerate(zip(first, first[1:], strict=False)):
        assert got[i] == pytest.approx(plain_quality(model, x[a:b]), rel=1e-9)


def test_rows_without_an_id_are_spread_and_follow_each_other(spark, monkeypatch):
    monkeypatch.setattr(weighted, "BUCKET_ROWS", 10)
    rows = [(i % 5 if i % 3 else None, f"text number {i} " + "y" * (i % 13)) for i in range(240)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sizes = weighted._bucketed(df).where("added = 0").groupBy("bucket").count()
    assert sizes.agg(F.max("count")).first()[0] < 60
    ordered = [
        (r["id"], r["text"]) for r in df.select(F.coalesce("doc_id", F.lit(weighted.NO_ID)).alias("id"), "text").orderBy("id", F.xxhash64("text")).collect()
    ]
    wanted = []
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        k = len(text) // 4
        edited = text[: len(text) - k] + after[:k]
        wanted.append((None if i == weighted.NO_ID else i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in weighted.fingerprints(df, 4).collect()]
    assert sorted(got, key=str) == sorted(wanted, key=str)
