"""Toxicity of whole texts by a support vector machine with a gapped subsequence kernel.

Sentences are cut into units: what lies between white space, lower-cased, without marks inside
("st-up.id" is "stupid"), digits and signs that stand for letters read as those, and letters spelled
out one by one ("s t u p i d") joined. Units longer than `LONG` letters are read in overlapping
pieces. The kernel of two units counts their common subsequences of three letters, a start mark
included, with a weight of DECAY to the power of the letters spanned, up to `REACH` letters; so a
unit with an inserted or left-out letter stays close to the word it hides.

Labels are of documents. The stems that best tell documents of label 1 apart name the sentences'
witnesses; a linear machine with hinge loss is fitted on Nyström features of landmark units. Its
decision is a sum of kernels to landmarks, so it folds into one weight per subsequence and costs a
few table reads per letter. A document's score is that of its worst unit, calibrated on documents.

Edge cases: null, empty and wordless texts have the score of a document without any unit. Repeated
rows are scored alike. Without labels of both values, or without any stem, all scores are the
smoothed share of label 1. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.fitting import FIT_BYTES, fold, logistic, sample, sigmoid
from halala.llm.text import FIRST, Texts, as_texts, mix, ranges, slices

DECAY, REACH = 0.75, 6
SHORT = 0.4  # added to squared norms, so that one or two letters in common do not make units alike
LONG, STRIDE = 24, 12
BITS = 20  # slots of the folded weights
FIT_ROWS = 3000
LANDMARKS, NEGATIVES = 160, 6000
STEM = range(4, 13)  # letters of a stem, with the start mark

_START = ord("^")
# Signs often written for letters.
_LOOKS = {"@": "a", "$": "s", "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}


def _letters() -> np.ndarray:
    """For every code point of the base plane the lower-case letter it stands for, 0 for none, 1 for white space."""
    out = np.zeros(1 << 16, np.uint16)
    for code in range(1 << 16):
        c = chr(code)
        if c.isspace():
            out[code] = 1
        elif c.isalpha():
            low = c.lower()
            out[code] = ord(low) if len(low) == 1 else code
    for sign, letter in _LOOKS.items():
        out[ord(sign)] = ord(letter)
    return out


_LETTER = _letters()
_GAPS = [(a, b) for a in range(1, REACH - 1) for b in range(1, REACH - a)]


@dataclass
class Units:
    """Distinct units of some texts, and which texts hold which."""

    codes: np.ndarray  # letters of all units, each after a start mark
    first: np.ndarray
    rows: np.ndarray  # text of each occurrence
    unit: np.ndarray  # its unit

    def __len__(self) -> int:
        return len(self.first) - 1

    def take(self, which: np.ndarray) -> Units:
        """Some of the units, without their texts."""
        sizes = np.diff(self.first)[which]
        to = np.cumsum(sizes)
        at = np.repeat(self.first[which] - (to - sizes), sizes) + np.arange(int(to[-1]) if len(to) else 0)
        none = np.zeros(0, np.int64)
        return Units(self.codes[at], np.concatenate([[0], to]).astype(np.int64), none, none)

    def hashes(self) -> np.ndarray:
        return FIRST.runs(mix(self.codes.astype(np.uint64)), self.first[:-1], self.first[1:])

    def parts(self, size: int = 1 << 16) -> Iterator[Units]:
        for a in range(0, len(self), size):
            yield self.take(np.arange(a, min(a + size, len(self))))

    def strings(self) -> list[str]:
        text = self.codes.astype("<u4").tobytes().decode("utf-32-le")
        return [text[a + 1 : b] for a, b in zip(self.first, self.first[1:], strict=False)]


def units_of(texts: Texts) -> Units:
    data = texts.data
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    at = np.cumsum(np.concatenate([[0], (data & 0xC0) != 0x80]))[texts.offsets]
    letters = np.where(codes < 1 << 16, _LETTER[np.minimum(codes, (1 << 16) - 1)], codes).astype(np.int64)
    white = letters == 1
    cut = np.zeros(len(codes) + 1, bool)
    cut[at] = True
    token = np.cumsum(white | cut[:-1])  # of each code point
    held = np.flatnonzero(letters > 1)
    letters, token = letters[held], token[held]
    new = np.ones(len(held), bool)
    new[1:] = token[1:] != token[:-1]
    first = np.flatnonzero(new)
    size = np.diff(np.append(first, len(held)))
    row = np.searchsorted(at, held[first], side="right") - 1
    # Single letters one after the other are spelled out: they make one unit.
    alone = np.zeros(len(first), bool)
    alone[1:] = (size[1:] == 1) & (size[:-1] == 1) & (row[1:] == row[:-1])
    first, row = first[~alone], row[~alone]
    size = np.diff(np.append(first, len(held)))
    pieces = np.maximum(1, -(-(size - LONG) // STRIDE) + 1)
    step = ranges(pieces)
    begin = np.repeat(first, pieces) + step * STRIDE
    end = np.minimum(begin + LONG, np.repeat(first + size, pieces))
    row = np.repeat(row, pieces)
    hashes = FIRST.runs(mix(letters.astype(np.uint64)), begin, end)
    _, example, unit = np.unique(hashes, return_index=True, return_inverse=True)
    begin, end = begin[example], end[example]
    size = end - begin + 1
    to = np.cumsum(size)
    flat = letters[np.minimum(np.repeat(begin - 1 - (to - size), size) + np.arange(int(to[-1]) if len(to) else 0), max(len(letters) - 1, 0))]
    if len(flat):
        flat[to - size] = _START
    return Units(flat, np.concatenate([[0], to]), row, unit)


def of_strings(words: list[str]) -> Units:
    codes = np.array([c for w in words for c in (_START, *map(ord, w))], np.int64)
    return Units(codes, np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])]).astype(np.int64), np.arange(len(words)), np.arange(len(words)))


def subsequences(units: Units) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Slots and units of all subsequences of three letters, by the letters spanned."""
    codes = units.codes.astype(np.uint64)
    owner = np.repeat(np.arange(len(units)), np.diff(units.first))
    left = units.first[1:][owner] - np.arange(len(codes))
    for a, b in _GAPS:
        at = np.flatnonzero(left > a + b)
        key = mix((codes[at] << np.uint64(42)) ^ (codes[at + a] << np.uint64(21)) ^ codes[at + a + b])
        yield (key >> np.uint64(64 - BITS)).astype(np.int64), owner[at], DECAY ** (a + b + 1)


def norms(units: Units) -> np.ndarray:
    total = np.zeros(len(units))
    for _, owner, weight in subsequences(units):
        total += np.bincount(owner, minlength=len(units)) * weight * weight
    return np.sqrt(total + SHORT)


def features(units: Units, slots: np.ndarray) -> np.ndarray:
    """Normalised weights of the units in the given sorted slots."""
    out = np.zeros((len(units), len(slots)))
    for key, owner, weight in subsequences(units):
        at = np.minimum(np.searchsorted(slots, key), len(slots) - 1)
        known = slots[at] == key
        np.add.at(out, (owner[known], at[known]), weight)
    return out / norms(units)[:, None]


def projected(units: Units, slots: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """features(units, slots) @ vectors, without the wide matrix."""
    out = np.zeros((len(units), vectors.shape[1]))
    for key, owner, weight in subsequences(units):
        at = np.minimum(np.searchsorted(slots, key), len(slots) - 1)
        known = np.flatnonzero(slots[at] == key)
        if len(known):
            own = owner[known]  # ascending
            start = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[start]] += np.add.reduceat(vectors[at[known]], start, axis=0) * weight
    return out / norms(units)[:, None]


def slots_of(units: Units) -> np.ndarray:
    return np.unique(np.concatenate([key for key, _, _ in subsequences(units)] or [np.zeros(0, np.int64)]))


@dataclass
class Machine:
    """The folded decision, and its calibration to documents."""

    table: np.ndarray
    bias: float
    slope: float
    offset: float

    def decide(self, units: Units) -> np.ndarray:
        out = [np.zeros(0)]
        for part in units.parts():
            total = np.zeros(len(part))
            for key, owner, weight in subsequences(part):
                total += np.bincount(owner, self.table[key] * weight, len(part))
            out.append(total / norms(part) + self.bias)
        return np.concatenate(out)

    def worst(self, texts: Texts) -> tuple[np.ndarray, np.ndarray, Units]:
        """Largest decision of each text, and the unit that has it, or -1."""
        units = units_of(texts)
        values = self.decide(units)
        best, which = np.full(len(texts), -2.0), np.full(len(texts), -1)
        if len(units.rows):
            own = values[units.unit]
            start = np.flatnonzero(np.diff(units.rows, prepend=-1))
            best[units.rows[start]] = np.maximum.reduceat(own, start)
            top = np.flatnonzero(own == best[units.rows])[::-1]
            which[units.rows[top]] = units.unit[top]
        return np.maximum(best, -2.0), which, units

    def probability(self, worst: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * worst + self.offset)


def all_units(texts: list[str], at_once: int = 256) -> Units:
    """Distinct units of many texts; an occurrence for each text and unit once."""
    codes, sizes, hashes, rows = [], [], [], []
    for a in range(0, len(texts), at_once):
        some = units_of(as_texts(pa.array(texts[a : a + at_once], pa.string())))
        own = some.hashes()
        pairs = np.unique(some.rows * len(some) + some.unit) if len(some) else np.zeros(0, np.int64)
        row, unit = np.divmod(pairs, max(len(some), 1))
        codes.append(some.codes.astype(np.uint32))
        sizes.append(np.diff(some.first))
        hashes.append(own)
        rows.append((row + a, own[unit]))
    size = np.concatenate(sizes or [np.zeros(0, np.int64)])
    flat = Units(np.concatenate(codes or [np.zeros(0, np.uint32)]), np.concatenate([[0], np.cumsum(size)]), *[np.zeros(0, np.int64)] * 2)
    known, example = np.unique(np.concatenate(hashes or [np.zeros(0, np.uint64)]), return_index=True)
    units = flat.take(example)
    units.rows = np.concatenate([r for r, _ in rows] or [np.zeros(0, np.int64)])
    units.unit = np.searchsorted(known, np.concatenate([h for _, h in rows] or [np.zeros(0, np.uint64)]))
    return units


def _stem_counts(units: Units, labels: np.ndarray, enough: float, allowed: int) -> dict[str, set[int]]:
    """Texts of label 1 by stem, for stems in enough of them and in at most `allowed` texts of label 0."""
    found: dict[str, set[int]] = {}
    size, codes = np.diff(units.first), mix(units.codes.astype(np.uint64))
    for n in (*STEM, 0):
        if n:
            fit = np.flatnonzero(size >= n)
            key = np.zeros(len(size), np.uint64)
            key[fit] = FIRST.runs(codes, units.first[:-1][fit], units.first[:-1][fit] + n)
            held = size[units.unit] >= n
        else:
            key, held = np.arange(len(size)).astype(np.uint64), np.ones(len(units.unit), bool)
        row, own = units.rows[held], units.unit[held]
        _, once = np.unique(mix(key[own] ^ mix(row.astype(np.uint64))), return_index=True)
        row, own = row[once], own[once]
        _, example, stem = np.unique(key[own], return_index=True, return_inverse=True)
        yes = np.bincount(stem, labels[row])
        no = np.bincount(stem) - yes
        for i in np.flatnonzero((yes >= enough) & (no <= allowed)):
            at = units.first[own[example[i]]]
            text = units.codes[at : at + n if n else units.first[own[example[i]] + 1]].astype("<u4").tobytes().decode("utf-32-le")
            mine = row[stem == i]
            found[text + ("" if n else "$")] = set(mine[labels[mine] > 0].tolist())
    return found


def stems(units: Units, labels: np.ndarray) -> list[str]:
    """Beginnings of units, or whole units ("$" at the end), that cover label 1 and are absent from label 0.

    Greedy: the stem of most documents not yet covered, the longest of equals; at least 3 documents
    and a fiftieth of those of label 1.
    """
    enough, common = max(3.0, 0.02 * float(labels.sum())), max(6.0, 0.05 * float(labels.sum()))
    live = _stem_counts(units, labels, enough, int(0.001 * (len(labels) - labels.sum())))
    chosen: list[str] = []
    covered: Counter[int] = Counter()
    while live:
        # Stems of a twentieth of the documents first; then a document counts until two stems are
        # found in it, since insults seldom come alone.
        best = max(live, key=lambda s: (len(live[s]) >= common, sum(0.5 ** covered[i] for i in live[s] if covered[i] < 2), len(live[s]), len(s)))
        if len(live[best]) < common and sum(covered[i] < 2 for i in live[best]) < enough:
            break
        chosen.append(best)
        covered.update(live[best])
        # Nested stems say the same again.
        live = {s: at for s, at in live.items() if not s.startswith(best.rstrip("$")) and not best.startswith(s)}
    return chosen


def _variants(word: str, draw: np.random.Generator) -> list[str]:
    """The word with a letter doubled, and with a letter put in."""
    if len(word) < 4:
        return []
    i, j = draw.integers(1, len(word), 2)
    letter = "xzqkh"[int(draw.integers(5))]
    return [word[:i] + word[i - 1] + word[i:], word[:j] + letter + word[j:]]


def _hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 250) -> np.ndarray:
    """Squared-hinge machine by accelerated gradient steps; the last weight is the bias."""
    x = np.column_stack([x, np.ones(len(x))])
    sign = 2 * y - 1
    ridge = 1e-4
    steep = 2 * np.linalg.eigvalsh((x * weight[:, None]).T @ x)[-1] + ridge
    w, before = np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(rounds):
        at = w + t / (t + 3) * (w - before)
        slack = np.maximum(0, 1 - sign * (x @ at))
        before, w = w, at - (-2 * x.T @ (weight * sign * slack) + ridge * at) / steep
    return w


def train(texts: list[str], labels: np.ndarray) -> Machine:
    share = float((labels.sum() + 0.5) / (len(labels) + 1)) if len(labels) else 0.05
    constant = Machine(np.zeros(1 << BITS), 0.0, 0.0, float(np.log(share / (1 - share))))
    if len(set(labels.tolist())) < 2:
        return constant
    units = all_units(texts)
    toxic = labels[units.rows] > 0
    in_toxic = np.bincount(units.unit[toxic], minlength=len(units))
    in_others = np.flatnonzero(np.bincount(units.unit[~toxic], minlength=len(units)))
    chosen = stems(units, labels)
    if not chosen:
        return constant
    begin = tuple(s for s in chosen if not s.endswith("$"))
    whole = {s[1:-1] for s in chosen if s.endswith("$")}
    draw = np.random.default_rng(3)
    suspects = np.flatnonzero(in_toxic)
    times = Counter({w: int(in_toxic[i]) for i, w in zip(suspects, units.take(suspects).strings(), strict=True) if w in whole or ("^" + w).startswith(begin)})
    positive = [w for w, _ in times.most_common(1500)]
    # Landmarks: the commonest witnesses, then those of every stem in turn.
    by_stem: dict[str, list[str]] = defaultdict(list)
    for w in positive:
        by_stem[next((s for s in chosen if ("^" + w + "$") == s or ("^" + w).startswith(s)), "")].append(w)
    marks: list[str] = []
    while len(marks) < LANDMARKS * 2 // 3 and any(by_stem.values()):
        marks += [v.pop(0) for v in by_stem.values() if v]
    marks = marks[: LANDMARKS * 2 // 3]
    slots = slots_of(of_strings(marks))
    # The negatives nearest to the landmarks count most, and give the rest of the landmarks.
    z = features(of_strings(marks), slots)
    table = np.zeros(1 << BITS)
    table[slots] = z.max(axis=0)
    others = units.take(in_others)
    near = Machine(table, 0.0, 1.0, 0.0).decide(others)
    order = np.argsort(-near, kind="stable")
    hard = others.take(np.concatenate([order[: NEGATIVES // 2], draw.permutation(order[NEGATIVES // 2 :])[: NEGATIVES // 2]])).strings()
    marks += [v for w in marks[:12] for v in _variants(w, draw)] + hard
    marks = marks[:LANDMARKS]
    slots = slots_of(of_strings(marks))
    z = features(of_strings(marks), slots)
    values, vectors = np.linalg.eigh(z @ z.T)
    used = values > 1e-6
    root = vectors[:, used] / np.sqrt(values[used])
    hidden = [v for w in positive[:600] for v in _variants(w, draw)]
    vectors = z.T @ root

    def nystroem(rows: list[str]) -> np.ndarray:
        return np.concatenate([projected(of_strings(rows[a : a + 1000]), slots, vectors) for a in range(0, len(rows), 1000)])

    positives, against = nystroem(positive + hidden), nystroem(hard)
    for _ in range(3):
        y = np.concatenate([np.ones(len(positives)), np.zeros(len(against))])
        w = _hinge(np.concatenate([positives, against]), y, np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum()))
        folded = np.zeros(1 << BITS)
        folded[slots] = vectors @ w[:-1]
        machine = Machine(folded, float(w[-1]), 1.0, 0.0)
        # Once more with the negatives that this machine gets most wrong.
        now = np.argsort(-machine.decide(others), kind="stable")[: NEGATIVES // 4]
        more = sorted(set(others.take(now).strings()) - set(hard))
        if not more:
            break
        hard += more
        against = np.concatenate([against, nystroem(more)])
    # Hidden insults count as documents too, for a fifth of all documents of label 1.
    worst = np.full(len(texts), -2.0)
    np.maximum.at(worst, units.rows, machine.decide(units)[units.unit])
    own = machine.decide(of_strings(hidden)) if hidden else np.zeros(0)
    x, y = np.concatenate([worst, own]), np.concatenate([labels, np.ones(len(own))]).astype(np.float64)
    weight = np.concatenate([np.ones(len(worst)), np.full(len(own), 0.2 * labels.sum() / max(len(own), 1))])
    fit = logistic(x[:, None], y, 1e-4, weight=weight)
    machine.slope, machine.offset = float(fit[0]), float(fit[1])
    return machine


def fitted(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = FIT_ROWS, size: int = FIT_BYTES) -> Machine:
    got = sample(docs, labels, label, rows, size).toArrow()
    return train(got.column("text").to_pylist(), got.column("label").to_numpy())


def _scores(sent):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        for piece in slices(batches):
            worst, which, units = machine.worst(as_texts(piece.column("text")))
            held = np.unique(which[which >= 0])
            names = {int(i): units.codes[units.first[i] + 1 : units.first[i + 1]].astype("<u4").tobytes().decode("utf-32-le") for i in held}
            yield pa.RecordBatch.from_arrays(
                [piece.column("doc_id"), pa.array(machine.probability(worst)), pa.array([names.get(i) for i in which.tolist()], pa.string())],
                names=["doc_id", "score", "worst"],
            )

    return of_batches


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, score, worst) of every row of docs(doc_id, text, …); `worst` is the unit that decides."""
    sent = docs.sparkSession.sparkContext.broadcast(machine)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(_scores(sent), "doc_id bigint, score double, worst string")


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, parts: int = 5) -> DataFrame:
    """(doc_id, held_out, score, predicted, worst); the fold 0 of `parts` by crc32 of the id is never fitted on."""
    machine = fitted(docs, labels.where(fold("doc_id", parts) != 0))
    held_out = F.coalesce(fold("doc_id", parts) == 0, F.lit(False))
    return scored(docs, machine).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "worst")
