"""Language-model scores of whole texts from n-gram tries whose levels are Elias-Fano sequences.

**Model.** A word's probability after its context is the count-based estimate, smoothed towards that of
the shorter context:

    p(w | c) = (n(c w) + m * p(w | shorter c)) / (n(c) + m),      p(w) = (n(w) + 0.1) / (N + 0.1 (V + 1)).

Every document ends with an end token and is read after beginnings, so each token has a full context.

**Tries.** The n-grams of one order and shard are a trie. Level by level, a node is the number
(parent * words + word), so each level is one increasing sequence; where the children of a node begin is
another. Both are Elias-Fano coded, and the leaves hold quantised logarithms of the smoothed
probabilities (`STEPS` a decade) in two bytes and counts as a third sequence. A query walks down: in each
level it looks for its word's successor among the children of its context. `Trie.open` reads all of it from
a view of bytes, such as a memory-mapped file (`Trie.map`), and copies nothing.

**Scale.** Texts are slices (`numbered`). For each order a slice sends its distinct n-grams, with their
counts among training documents, to the shards of their contexts; the shard sums the counts, builds its
trie and answers the slices from it. Contexts with more than `HOT` occurrences are dealt to several shards
by the word that follows. So all n-grams of all training documents are in the model, nothing is pruned,
and a task holds one slice or one shard.

Edge cases: null, empty and blank texts have the end token only. Documents with a null id are scored, but
not learned from. Repeated rows are learned and scored like others. Without training documents all counts
are 0. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import mmap
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.monotone import EliasFano
from halala.llm.numbered import SLICE, Numbering, answers_of, bucketed, by_number, local, merged, numbers, of_answers, pack, pack_keys, shard_bits, unpack, words_below
from halala.llm.shared import written
from halala.llm.text import WHITE, as_texts, mix, slices

ORDER = 3
STRENGTH = {2: 1.0, 3: 1.0}  # m of each order
STEPS, CODE_BITS = 64, 16
HOT = 1 << 20
GRAMS = 1 << 19  # n-grams that a shard gets, about
ADDED = 0.1
END = np.uint64(0x9E3779B97F4A7C15)  # key of the end token, which is no word's

SLICES = "part string, slice bigint, keys binary, counts binary, n_keys int, tokens binary, sizes binary, ids array<bigint>, held array<boolean>, train array<boolean>, n_tokens bigint, n_train bigint, docs bigint"
SENT = "shard bigint, slice bigint, n int, contexts int, packed binary"
ANSWERS = "slice bigint, shard bigint, n int, packed binary, trie binary"
SCORED = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def code_of(p: np.ndarray) -> np.ndarray:
    """Quantised -log10 of probabilities."""
    return np.clip(np.rint(-STEPS * np.log10(p)), 0, (1 << CODE_BITS) - 1).astype(np.int64)


def value_of(code: np.ndarray) -> np.ndarray:
    return 10.0 ** (code / -STEPS)


@dataclass
class Trie:
    """N-grams of one order, sorted by their words, with a code and a count each."""

    words: int  # more than any word's number
    levels: list[EliasFano]
    pointers: list[EliasFano]  # where the children of each node of a level begin; one fewer than levels
    codes: np.ndarray  # uint16 of each leaf
    sums: EliasFano  # of the counts of all leaves up to each

    @classmethod
    def of(cls, words: int, columns: list[np.ndarray], codes: np.ndarray, counts: np.ndarray) -> Trie:
        """A trie of distinct n-grams, given as columns of words in ascending order."""
        levels, pointers = [], []
        new, node = np.zeros(len(codes), bool), np.zeros(len(codes), np.int64)
        new[:1] = True
        for j, column in enumerate(columns):
            parent = node
            new = new.copy()
            new[1:] |= column[1:] != column[:-1]
            node = np.cumsum(new) - 1
            levels.append(EliasFano.of(parent[new] * words + column[new]))
            if j:
                n = int(parent[-1]) + 1 if len(parent) else 0
                pointers.append(EliasFano.of(np.searchsorted(parent[new], np.arange(n + 1))))
        return cls(words, levels, pointers, codes.astype("<u2"), EliasFano.of(np.cumsum(counts)))

    def raw(self) -> bytes:
        sequences = [*self.levels, *self.pointers, self.sums]
        parts = [np.asarray(self.codes).tobytes()]
        head = struct.pack("<3q", len(self.levels), self.words, len(self.codes))
        for x in sequences:
            own = [bytes(y) for y in (x.low, x.high, x.samples)]
            head += struct.pack("<5q", x.n, x.low_bits, *map(len, own))
            parts += own
        return head + b"".join(part + bytes(-len(part) % 8) for part in parts)

    @classmethod
    def open(cls, view: memoryview) -> Trie:
        depth, words, n = struct.unpack_from("<3q", view)
        heads = [struct.unpack_from("<5q", view, 24 + 40 * i) for i in range(2 * depth)]
        at = 24 + 80 * depth

        def part(size: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(view, np.uint8, size, at)
            at += size + -size % 8
            return found

        codes = part(2 * n).view("<u2")
        made = [EliasFano(k, bits, *(part(size) for size in sizes)) for k, bits, *sizes in heads]
        return cls(words, made[:depth], made[depth:-1], codes, made[-1])

    @classmethod
    def map(cls, path: str) -> Trie:
        """The trie of a file, of which only the pages that queries touch are read."""
        with open(path, "rb") as file:
            return cls.open(memoryview(mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)))

    def find(self, columns: list[np.ndarray]) -> np.ndarray:
        """The leaf of each n-gram, or -1; n-grams are looked up in order, each below its context."""
        place = np.zeros(len(columns[0]), np.int64)
        known = np.ones(len(place), bool)
        for j, column in enumerate(columns):
            level = self.levels[j]
            wanted = place * self.words + column
            if 16 * len(place) >= level.n:  # about as many queries as nodes: read the level once
                values = np.append(level.all(), -1)
                found = np.searchsorted(values[:-1], wanted)
                hit = values[found] == wanted
            else:
                begin = self.pointers[j - 1].select(np.where(known, place, 0)) if j else None
                end = self.pointers[j - 1].select(np.where(known, place, 0) + 1) if j else None
                found = level.successor(wanted, begin, end)
                inside = np.minimum(found, max(level.n - 1, 0))
                hit = (found < level.n) & (level.select(inside) == wanted) if level.n else np.zeros(len(found), bool)
            known &= hit
            place = np.where(known, found, 0)
        return np.where(known, place, -1)

    def counts(self, leaves: np.ndarray) -> np.ndarray:
        if 16 * len(leaves) >= self.sums.n:
            sums = np.concatenate([[0], self.sums.all()])
            return sums[leaves + 1] - sums[leaves]
        before = np.where(leaves > 0, self.sums.select(np.maximum(leaves - 1, 0)), 0)
        return self.sums.select(leaves) - before


def _mapped(raw: bytes) -> Trie:
    """The trie in memory mapped outside Python's heap."""
    held = mmap.mmap(-1, max(1, len(raw)))
    held.write(raw)
    return Trie.open(memoryview(held))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = Numbering()
    for piece in slices(batches, limit=SLICE):
        words = as_texts(piece.column("text"), lower=True).words(~WHITE)
        sizes = words.counts() + 1
        ends = np.cumsum(sizes)
        keys = np.full(int(ends[-1]), END, np.uint64)
        body = np.ones(len(keys), bool)
        body[ends - 1] = False
        keys[body] = words.hashes()
        distinct, _, place = local(keys)
        train = piece.column("train").to_numpy(zero_copy_only=False)
        counts = np.bincount(place[np.repeat(train, sizes)], minlength=len(distinct)).astype(np.int64)
        row = {
            "part": "", "slice": number(), "keys": pack_keys(distinct), "counts": pack(counts), "n_keys": len(distinct), "tokens": pack(place), "sizes": pack(sizes),
            "ids": piece.column("id").to_pylist(), "held": piece.column("held").to_pylist(), "train": train.tolist(),
            "n_tokens": len(keys), "n_train": int(counts.sum()), "docs": int(train.sum()),
        }
        kinds = {"keys": pa.binary(), "counts": pa.binary(), "n_keys": pa.int32(), "tokens": pa.binary(), "sizes": pa.binary(), "ids": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()), "train": pa.list_(pa.bool_())}
        yield pa.RecordBatch.from_arrays([pa.array([v], kinds.get(k)) for k, v in row.items()], names=list(row))


@dataclass
class Totals:
    """Of the whole corpus: training tokens, their distinct words, training documents."""

    tokens: int
    distinct: int
    docs: int
    words: int  # more than any word's number

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1))


class Grams:
    """The n-grams of one slice, order by order.

    `places` number a slice's own distinct n-grams in order; 0 is the beginnings alone.
    """

    def __init__(self, row: dict, totals: Totals, order: int):
        self.totals = totals
        self.sizes = unpack(row["sizes"].as_buffer(), len(row["ids"]))[0].astype(np.int64)
        tokens = unpack(row["tokens"].as_buffer(), int(self.sizes.sum()))[0].astype(np.int64)
        tokens, numbered, self.counts = by_number(tokens, *of_answers(row["numbers"], 2))
        first = np.cumsum(self.sizes + order - 1) - self.sizes - order + 1
        self.starts = first  # of documents, at their first beginning
        self.predicted = np.ones(int((self.sizes + order - 1).sum()), bool)
        for j in range(order - 1):
            self.predicted[first + j] = False
        self.seq = np.zeros(len(self.predicted), np.int64)
        self.seq[self.predicted] = tokens + 1
        self.trained = np.repeat(np.array(row["train"].as_py(), bool), self.sizes + order - 1) & self.predicted
        self.word = np.concatenate([[0], numbered + 1])
        self.order, self.places = 1, self.seq
        # Count and probability by place.
        self.n = self.often = np.concatenate([[totals.docs], self.counts])
        self.p = np.concatenate([[1.0], totals.unigram(self.counts)])

    def extend(self, bits: int) -> None:
        """Go to n-grams of the next order: their words, counts in the slice, and what smoothing needs."""
        before = np.concatenate([[0], self.places[:-1]])
        before[self.starts] = 0
        distinct, first, places = local(before * len(self.word) + self.seq)
        at = first[1:]
        self.order += 1
        own = [self.seq[at - j] for j in range(self.order - 1, -1, -1)]
        self.columns = [self.word[x] for x in own]
        self.context, self.shorter = before[at], self.places[at]  # places in the order before
        self.places, self.distinct = places, len(distinct)
        key = np.zeros(len(at), np.uint64)
        for column in self.columns[:-1]:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + column.astype(np.uint64))
        # A context occurs no more often than its rarest word.
        parts = 1 + np.minimum.reduce([self.often[x] for x in own[:-1]]) // HOT
        self.dealt = parts > 1
        self.frequent = np.minimum.reduce([self.often[x] for x in own]) >= HOT  # will be dealt as contexts
        spread = (mix(self.columns[-1].astype(np.uint64)) >> np.uint64(20)).astype(np.int64) % parts
        shard = (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(at), np.int64)
        self.shard = (shard + spread) & ((1 << bits) - 1)
        self.by_shard = np.argsort(self.shard, kind="stable")

    def sent(self) -> Iterator[tuple[int, int, int, bytes]]:
        """(shard, n-grams, contexts, packed) for each shard."""
        order = self.by_shard
        shard = self.shard[order]
        columns = [c[order] for c in self.columns]
        within = np.bincount(self.places[self.trained], minlength=self.distinct)[1:][order]
        # A context in one shard is counted there.
        context = np.where(self.dealt[order], self.n[self.context[order]], 0)
        shorter = code_of(self.p[self.shorter[order]]) | self.frequent[order].astype(np.int64) << CODE_BITS
        new = np.ones(len(shard), bool)
        new[1:] = shard[1:] != shard[:-1]
        cuts = np.append(np.flatnonzero(new), len(shard))
        for c in columns[:-1]:
            new[1:] |= c[1:] != c[:-1]
        heads = np.flatnonzero(new)
        children = np.diff(np.append(heads, len(shard)))
        head_cuts = np.searchsorted(heads, cuts)
        for a, b, x, y in zip(cuts, cuts[1:], head_cuts, head_cuts[1:], strict=False):
            some = heads[x:y]
            steps = np.diff(columns[0][some], prepend=0)  # ascending
            raw = pack(steps, *(c[some] for c in columns[1:-1]), context[some], children[x:y], columns[-1][a:b], within[a:b], shorter[a:b])
            yield int(shard[a]), int(b - a), int(y - x), raw

    def answered(self, answers: pa.Scalar, last: bool) -> None:
        """Take the answers to what was sent: codes of the n-grams, and their counts unless it was the last order."""
        found = of_answers(answers, 1 if last else 2)
        self.code = np.zeros(len(self.by_shard) + 1, np.int64)
        self.code[self.by_shard + 1] = found[0]
        if not last:
            self.p = value_of(self.code)
            self.n = np.full(len(self.code), self.totals.docs, np.int64)
            self.n[self.by_shard + 1] = found[1]

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Known tokens, base score and score of each document."""
        begin = np.cumsum(self.sizes) - self.sizes
        words = self.seq[self.predicted]
        base = np.log10(self.totals.unigram(self.counts))[words - 1]
        steps = np.add.reduceat(self.code[self.places[self.predicted]], begin)
        return np.add.reduceat((self.often[words] > 0).astype(np.int64), begin), np.add.reduceat(base, begin), steps / -STEPS


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i] for name in batch.schema.names}


def _grams(row: dict, totals: Totals, order: int, bits: int, last: int) -> Grams:
    """The slice's n-grams of one order, after the answers to all orders before it."""
    grams = Grams(row, totals, last)
    for k in range(2, order + 1):
        grams.extend(bits)
        if k < order:
            grams.answered(row[f"order{k}"], last=False)
    return grams


def _send(totals: Totals, order: int, bits: int, last: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            found = list(_grams(row, totals, order, bits, last).sent())
            shard, n, contexts, raw = (list(x) for x in zip(*found, strict=True))
            arrays = [pa.array(shard, pa.int64()), pa.array([row["slice"].as_py()] * len(found), pa.int64()), pa.array(n, pa.int32()), pa.array(contexts, pa.int32()), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["shard", "slice", "n", "contexts", "packed"])

    return of_batches


def _answer(words: int, order: int, last: bool, keep: bool):
    strength = STRENGTH[order]

    def of_shard(rows: pa.Table) -> pa.Table:
        sizes = rows.column("n").to_numpy().astype(np.int64)
        heads = rows.column("contexts").to_numpy().astype(np.int64)
        parts = []
        for raw, n, m in zip(rows.column("packed"), sizes.tolist(), heads.tolist(), strict=True):
            got = [x.astype(np.int64) for x in unpack(raw.as_buffer(), *[m] * (order + 1), n, n, n)]
            got[0] = np.cumsum(got[0])
            children = got[order]
            parts.append([*(np.repeat(x, children) for x in got[:order]), *got[order + 1 :]])
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        del parts
        context, word, within, shorter = columns[order - 1 :]
        columns = [*columns[: order - 1], word]
        first, place = merged(columns)
        total = np.bincount(place, within, len(first)).astype(np.int64)
        columns = [c[first] for c in columns]
        new = np.ones(len(first), bool)
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns[:-1]])
        group = np.cumsum(new) - 1
        inside = np.bincount(group, total).astype(np.int64)[group]
        context = np.where(context[first] > 0, context[first], inside)
        frequent, shorter = shorter[first] >> CODE_BITS > 0, shorter[first] & (1 << CODE_BITS) - 1
        lower = strength * value_of(shorter)
        back = code_of(lower / (context + strength))
        seen = total > 0
        code = code_of((total[seen] + lower[seen]) / (context[seen] + strength))
        raw = Trie.of(words, [c[seen] for c in columns], code, total[seen]).raw()
        trie = _mapped(raw)
        leaf = trie.find(columns)
        hit = leaf >= 0
        found = [np.where(hit, trie.codes[np.maximum(leaf, 0)] if len(trie.codes) else 0, back).astype(np.int64)]
        if not last:
            # Only n-grams that will be dealt as contexts need their counts outside.
            counts = np.zeros(len(leaf), np.int64)
            asked = hit & frequent
            counts[asked] = trie.counts(leaf[asked])
            found.append(counts)
        ends = np.cumsum(sizes)
        packed = [pack(*(x[place[b - n : b]] for x in found)) for b, n in zip(ends, sizes, strict=True)]
        shard = rows.column("shard")[0].as_py()
        return pa.table(
            [
                pa.array([*rows.column("slice").to_pylist(), None], pa.int64()), pa.array([shard] * (len(sizes) + 1), pa.int64()),
                pa.array([*sizes.tolist(), None], pa.int32()), pa.array([*packed, None], pa.binary()), pa.array([None] * len(sizes) + [raw], pa.binary()),
            ],
            names=["slice", "shard", "n", "packed", "trie"],
        ).slice(0, len(sizes) + keep)

    return of_shard


def _score(totals: Totals, bits: int, last: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            grams = Grams(row, totals, last)
            for _ in range(2, last + 1):
                grams.extend(bits)
            grams.answered(row[f"order{last}"], last=True)
            known, base, score = grams.scores()
            arrays = [pa.array(row["ids"].as_py(), pa.int64()), pa.array(row["held"].as_py(), pa.bool_()), pa.array(grams.sizes), pa.array(known), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return of_batches


@dataclass
class Model:
    """The model's tables (shard, trie) of each order, if kept, and what holds for the whole corpus."""

    tries: dict[int, DataFrame]
    totals: Totals


def scored(docs: DataFrame, train: str, held: str, order: int = ORDER, grams: int = GRAMS, keep: bool = False) -> tuple[DataFrame, Model]:
    """Scores of every row of docs(doc_id, text, …), and the model, learned from the rows where `train` holds.

    The scores have doc_id, held_out (`held`), n_tokens, n_known, base_score and score; `train` and `held`
    are SQL conditions on the columns of docs. A shard gets about `grams` n-grams. With `keep` the tries are
    stored, for later use by `Trie.open`; else they go with the tasks that answer from them.
    """
    flags = [F.expr(f"coalesce({condition}, false)").alias(name) for name, condition in (("train", train), ("held", held))]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("id"), *flags, "text")
    sliced = bucketed(rows.mapInArrow(_slices, SLICES), "slice")
    n_train, n_docs, n_tokens = sliced.agg(F.sum("n_train"), F.sum("docs"), F.sum("n_tokens")).first()
    answers, key_bits = numbers(sliced)
    answers = bucketed(answers_of(answers, "numbers", "packed", "known"), "slice")
    distinct = answers.agg(F.sum(F.expr("aggregate(numbers.known, 0L, (a, x) -> a + x)"))).first()[0] or 0
    totals = Totals(n_train or 0, distinct, n_docs or 0, words_below(key_bits) + 1)
    bits = shard_bits(n_tokens or 0, grams)

    mine = sliced.select("slice", "tokens", "sizes", "ids", "held", "train").join(answers, "slice")
    seen, tries = mine, {}
    for k in range(2, order + 1):
        sent = seen.mapInArrow(_send(totals, k, bits, order), SENT)
        found = written(sent.groupBy("shard").applyInArrow(_answer(totals.words, k, k == order, keep), ANSWERS))
        if keep:
            tries[k] = found.where("trie is not null").select("shard", "trie")
        answered = answers_of(found.where("slice is not null"), f"order{k}", "packed")
        seen = seen.join(answered, "slice") if k < order else mine.join(answered, "slice")
    return seen.mapInArrow(_score(totals, bits, order), SCORED), Model(tries, totals)


def language_scores(docs: DataFrame, parts: int = 10, held: int = 0) -> DataFrame:
    """The scores with train_tokens; the fold `held` of `parts` by crc32 of the id is not learned from."""
    place = f"pmod(crc32(cast(cast(doc_id as string) as binary)), {parts})"
    found, model = scored(docs, f"{place} <> {held}", f"{place} = {held}")
    counted = found.withColumn("train_tokens", F.lit(model.totals.tokens).cast("bigint"))
    return counted.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
