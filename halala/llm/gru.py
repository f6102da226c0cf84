"""Language of whole texts by a bidirectional gated recurrent network over bytes.

The bytes of a text, A-Z lower-cased, are read in stretches of `STRETCH`, forwards and backwards;
every byte gets a probability per language, and the document's probabilities are the means over its
letters (bytes of letters and all bytes beyond ASCII). The network is fitted in numpy by
backpropagation through time, on stretches of a bounded sample of documents with a language.

Edge cases: a text that is null or has no letter is "und" with score 0, as is every text when no
document has a language. Ties go to the language that sorts first. Repeated rows are judged alike.
Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.fitting import Adam, fold, of_each_class
from halala.llm.text import LOWER, Texts, as_texts, ranges, slices

UNKNOWN = "und"
HIDDEN, STRETCH = 10, 128
FIT_PER_LANGUAGE, FIT_ROWS = 1000, 20_000  # documents fitted on of each language, about, and of all
FIT_SIZE = 4096  # characters of a document that are fitted on
FIT_STRETCH, FIT_BATCH, FIT_ROUNDS = 48, 384, 180
ROOM = 2048  # stretches at a time

_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_COUNTS = _ASCII_LETTER.copy()
_COUNTS[128:] = True


@dataclass
class Network:
    languages: list[str]
    weights: dict[str, np.ndarray]

    def _run(self, side: str, codes: np.ndarray, keep: bool = False):
        """States after each step for codes (time, stretch); half-angle form, so gates need tanh only."""
        table, inner = self.weights[side + "x"], self.weights[side + "h"]
        n = HIDDEN
        h = np.zeros((codes.shape[1], n), table.dtype)
        states = np.empty((len(codes), codes.shape[1], n), table.dtype)
        kept = []
        for t, code in enumerate(codes):
            x, u = table[code], h @ inner
            gate = np.tanh(0.5 * (x[:, : 2 * n] + u[:, : 2 * n]))
            gate *= 0.5
            gate += 0.5
            z, r = gate[:, :n], gate[:, n:]
            new = np.tanh(x[:, 2 * n :] + r * u[:, 2 * n :])
            before = h
            h = new + z * (h - new)
            states[t] = h
            if keep:
                kept.append((z, r, new, u[:, 2 * n :], before))
        return (states, kept) if keep else states

    def _states(self, side: str, codes: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """What `_run` gives, with each gate in an array of its own, written in place.

        In step t only the first live[t] stretches have a byte: the others' states stay as they are.
        """
        table, inner, n = self.weights[side + "x"], self.weights[side + "h"], HIDDEN
        (tz, iz), (tr, ir), (tn, im) = (
            [np.ascontiguousarray(w[:, k * n : (k + 1) * n] * sign) for w in (table, inner)] for k, sign in ((0, -1), (1, -1), (2, 1))
        )
        live = np.full(len(codes), codes.shape[1]) if live is None else live
        state = np.zeros((codes.shape[1], n), table.dtype)
        states = np.zeros((len(codes), codes.shape[1], n), table.dtype)
        with np.errstate(over="ignore"):  # a gate that is shut: exp is infinite, its inverse 0
            for t, k in enumerate(live.tolist()):
                code, h = codes[t, :k], state[:k]
                z = tz.take(code, axis=0)
                z += h @ iz
                np.exp(z, out=z)
                z += 1
                np.reciprocal(z, out=z)
                new = tr.take(code, axis=0)
                new += h @ ir
                np.exp(new, out=new)
                new += 1
                np.reciprocal(new, out=new)
                new *= h @ im
                new += tn.take(code, axis=0)
                np.tanh(new, out=new)
                h -= new
                h *= z
                h += new
                states[t, :k] = h
        return states

    def probabilities(self, codes: np.ndarray, live: np.ndarray | None = None) -> np.ndarray:
        """(time, stretch, language), where only the first live[t] stretches, the longer ones, have a byte t."""
        forth = self._states("f", codes, live)
        back = self._states("b", codes[::-1], None if live is None else live[::-1])[::-1]
        n = HIDDEN
        score = forth @ self.weights["out"][:n] + back @ self.weights["out"][n:] + self.weights["out0"]
        score = np.exp(score - score.max(axis=2, keepdims=True))
        return score / score.sum(axis=2, keepdims=True)

    def _back(self, side: str, codes: np.ndarray, kept: list, d_states: np.ndarray, found: dict[str, np.ndarray]) -> None:
        n = HIDDEN
        inner = self.weights[side + "h"]
        d_table, d_inner = np.zeros_like(self.weights[side + "x"]), np.zeros_like(inner)
        dh = np.zeros_like(d_states[0])
        for t in range(len(codes) - 1, -1, -1):
            z, r, new, un, before = kept[t]
            dh = dh + d_states[t]
            d_new = dh * (1 - z) * (1 - new * new)
            d_z = dh * (before - new) * z * (1 - z)
            d_r = d_new * un * r * (1 - r)
            d_x = np.concatenate([d_z, d_r, d_new], axis=1)
            d_u = np.concatenate([d_z, d_r, d_new * r], axis=1)
            d_inner += before.T @ d_u
            np.add.at(d_table, codes[t], d_x)
            dh = dh * z + d_u @ inner.T
        found[side + "x"], found[side + "h"] = d_table, d_inner

    def gradients(self, codes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of all positions; `weight` is 0 where nothing is to be learned."""
        n, w = HIDDEN, self.weights
        forth, kept_f = self._run("f", codes, True)
        back, kept_b = self._run("b", codes[::-1], True)
        back = back[::-1]
        score = forth @ w["out"][:n] + back @ w["out"][n:] + w["out0"]
        score = np.exp(score - score.max(axis=2, keepdims=True))
        d = score / score.sum(axis=2, keepdims=True)
        d[:, np.arange(len(labels)), labels] -= 1
        d *= (weight / max(weight.sum(), 1e-9))[:, :, None]
        found = {
            "out": np.concatenate([np.einsum("tbh,tbl->hl", forth, d), np.einsum("tbh,tbl->hl", back, d)]),
            "out0": d.sum(axis=(0, 1)),
        }
        self._back("f", codes, kept_f, d @ w["out"][:n].T, found)
        self._back("b", codes[::-1], kept_b, (d @ w["out"][n:].T)[::-1], found)
        size = np.sqrt(sum(float((g * g).sum()) for g in found.values()))
        return {k: g * min(1, 1 / max(size, 1e-9)) for k, g in found.items()}

    @classmethod
    def blank(cls, languages: list[str]) -> Network:
        draw = np.random.default_rng(21)
        sizes = {s + k: v for s in "fb" for k, v in (("x", (256, 3 * HIDDEN)), ("h", (HIDDEN, 3 * HIDDEN)))}
        sizes |= {"out": (2 * HIDDEN, len(languages))}
        weights = {k: draw.normal(0, 0.3, v).astype(np.float32) for k, v in sizes.items()}
        return cls(languages, weights | {"out0": np.zeros(len(languages), np.float32)})


def train(texts: Texts, languages: list[str], rounds: int = FIT_ROUNDS) -> Network:
    """Fit on random stretches of the texts, each language as often as any other."""
    names = sorted(set(languages))
    network = Network.blank(names)
    sizes = np.diff(texts.offsets)
    label = np.array([names.index(x) for x in languages], np.int64)
    groups = [np.flatnonzero((label == i) & (sizes > 0)) for i in range(len(names))]
    groups = [g for g in groups if len(g)]
    if len(groups) < 2:
        return network
    draw = np.random.default_rng(5)
    data = np.append(LOWER[texts.data], np.zeros(FIT_STRETCH, np.uint8))
    adam = Adam(network.weights, 0.02)
    step = np.arange(FIT_STRETCH)
    for i in range(rounds):
        adam.rate = 0.02 * (1 - 0.9 * i / rounds)
        group = draw.integers(0, len(groups), FIT_BATCH)
        docs = np.array([groups[g][int(x * len(groups[g]))] for g, x in zip(group, draw.random(FIT_BATCH), strict=True)])
        begin = texts.offsets[docs] + (draw.random(FIT_BATCH) * np.maximum(1, sizes[docs] - FIT_STRETCH // 2)).astype(np.int64)
        at = begin[None, :] + step[:, None]
        inside = at < texts.offsets[docs + 1][None, :]
        codes = np.where(inside, data[np.minimum(at, len(data) - 1)], 0)
        weight = (inside & _COUNTS[codes]).astype(np.float32)
        adam.step(network.gradients(codes, label[docs], weight))
        for k, v in network.weights.items():
            network.weights[k] = v.astype(np.float32)
    return network


def pooled(network: Network, texts: Texts) -> np.ndarray:
    """Mean probabilities over the letters of each text; zeros where it has none."""
    n, out = len(texts), np.zeros((len(texts), len(network.languages)))
    sizes = np.diff(texts.offsets)
    parts = -(-sizes // STRETCH)
    row = np.repeat(np.arange(n), parts)
    begin = texts.offsets[:-1][row] + ranges(parts) * STRETCH
    end = np.minimum(begin + STRETCH, texts.offsets[1:][row])
    order = np.argsort(begin - end, kind="stable")  # longest first: little is padded
    data = np.append(LOWER[texts.data], np.zeros(STRETCH, np.uint8))
    for a in range(0, len(order), ROOM):
        some = order[a : a + ROOM]
        at = begin[some][None, :] + np.arange(int((end - begin)[some].max()))[:, None]
        inside = at < end[some][None, :]
        codes = np.where(inside, data[at], 0)
        p = network.probabilities(codes, inside.sum(axis=1))
        p *= (inside & _COUNTS[codes])[:, :, None]
        np.add.at(out, row[some], p.sum(axis=0))
    total = out.sum(axis=1, keepdims=True)
    return np.divide(out, total, out=out, where=total > 0)


def has_letter(texts: Texts) -> np.ndarray:
    plain = np.concatenate([[0], np.cumsum(_ASCII_LETTER[texts.data])])
    found = (plain[texts.offsets[1:]] - plain[texts.offsets[:-1]]) > 0
    for i in np.flatnonzero(~found):
        raw = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode("utf-8")
        found[i] = any(c.isalpha() for c in raw)
    return found


def fitted(docs: DataFrame, each: int = FIT_PER_LANGUAGE, rows: int = FIT_ROWS, size: int = FIT_SIZE) -> Network:
    """A network of docs(doc_id, text, lang): about `each` documents of every language, and the first `size` characters of longer ones.

    A language with fewer documents is used whole, so every language that occurs is learned, whatever the
    size of the table, as long as there are no more than `rows` of them.
    """
    few = of_each_class(docs.select("doc_id", "lang", "text").where("lang is not null and octet_length(text) > 0"), "lang", ["doc_id", "text"], each, rows)
    got = few.orderBy(F.xxhash64("doc_id", "text"), "lang", "text").select(F.substring("text", 1, size).alias("text"), "lang").toArrow()
    return train(as_texts(got.column("text")), got.column("lang").to_pylist())


def _predict(sent):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = sent.value
        for piece in slices(batches):
            texts = as_texts(piece.column("text"))
            known = has_letter(texts) & bool(network.languages)
            p = pooled(network, texts) if network.languages else np.zeros((len(texts), 1))
            best = p.argmax(axis=1)
            names = [network.languages[i] if ok else UNKNOWN for i, ok in zip(best, known, strict=True)]
            score = np.where(known, np.minimum(p.max(axis=1), 1.0), 0.0)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(names, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return of_batches


def predicted(docs: DataFrame, network: Network) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of docs(doc_id, text, …)."""
    sent = docs.sparkSession.sparkContext.broadcast(network)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_predict(sent), "doc_id bigint, lang_pred string, score double")


def languages(docs: DataFrame, parts: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score); the fold `held` of `parts` by crc32 of the id is never fitted on."""
    fit = docs.where(fold("doc_id", parts) != held)
    held_out = F.coalesce(fold("doc_id", parts) == held, F.lit(False))
    return predicted(docs, fitted(fit)).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
