"""Benchmark decontamination: Wu-Manber search for word windows of test items in whole documents.

The alphabet is words. For the windows of one length, a shift table over blocks of two words tells
how far a position can move without missing a window; where it cannot move, the bucket of the
block's hash names the windows that end so, the hash of their first words rules most out, and the
words' bytes decide. Many cursors walk one slice of text at a time, each over its own stretch.

Windows are distinct (window, item) pairs in blocks of at most `BLOCK` pairs. One block at a time is
sent to the tasks, so what is broadcast is bounded whatever the benchmark's size; every document is
searched for every block.

Edge cases: null texts have no words and cannot be hit; items without words give no window; an item
with a null id marks words but is not named. Repeated items and windows count once. Repeated
documents are kept and judged alike. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.shared import over_texts, written
from halala.llm.text import FIRST, Texts, Words, as_texts, list_sizes, lists, mix, ranges, run_starts, slices

SPAN = 10  # words of a window
BLOCK = 200_000  # (window, item) pairs searched for at once
STRETCH = 256  # words for one cursor
EXPAND = 1 << 18  # pairs of position and window compared at once

IN_WORD = np.ones(256, bool)
IN_WORD[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

WINDOWS = "item_id bigint, span int, words string"
HITS = "doc_id bigint, rank bigint, n_words bigint, starts array<int>, spans array<int>, items array<bigint>"
JUDGED = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"


def _item_windows(span: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            words = as_texts(piece.column("text"), lower=True).words(IN_WORD)
            counts = words.counts()
            starts = run_starts(words, span)
            short = np.flatnonzero((counts > 0) & (counts < span))
            begin = np.concatenate([starts, words.first[short]])
            size = np.concatenate([np.full(len(starts), span), counts[short]])
            rows = np.concatenate([words.rows()[starts], short])
            raw = words.texts.data.tobytes()
            at = [(raw[a:b] for a, b in zip(words.starts[x : x + n], words.ends[x : x + n], strict=True)) for x, n in zip(begin, size, strict=True)]
            texts = [b" ".join(x).decode() for x in at]
            yield pa.RecordBatch.from_arrays(
                [piece.column("item_id").take(pa.array(rows)), pa.array(size.astype(np.int32)), pa.array(texts, pa.string())], names=["item_id", "span", "words"]
            )

    return of_batches


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


@dataclass
class Tables:
    """Shift table and buckets for the windows of one length."""

    span: int
    shift: np.ndarray
    suffix: np.ndarray  # sorted hashes of the windows' last block
    prefix: np.ndarray  # hash of their first block, in that order
    first: np.ndarray  # first word of each window in `words`
    number: np.ndarray  # of the window among all of the block of pairs
    words: Words

    @classmethod
    def of(cls, span: int, words: Words, first: np.ndarray, number: np.ndarray) -> Tables:
        hashes = words.hashes()
        block = min(2, span)
        ends = first[:, None] + np.arange(block - 1, span)[None, :]
        keys = cls.blocks(hashes, ends.ravel(), block).reshape(ends.shape)
        bits = max(12, int(np.ceil(np.log2(16 * keys.size))))
        shift = np.full(1 << bits, span - block + 1, np.uint8 if span < 256 else np.int64)
        far = np.broadcast_to(np.arange(span - block, -1, -1).astype(shift.dtype), keys.shape)
        np.minimum.at(shift, (keys >> np.uint64(64 - bits)).ravel(), far.ravel())
        order = np.argsort(keys[:, -1], kind="stable")
        return cls(span, shift, keys[order, -1], keys[order, 0], first[order], number[order], words)

    @staticmethod
    def blocks(hashes: np.ndarray, ends: np.ndarray, block: int) -> np.ndarray:
        return _pair(hashes[ends - 1], hashes[ends]) if block == 2 else mix(hashes[ends])

    def stops(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of possible windows and their block hashes: where the shift is 0."""
        block, down = min(2, self.span), np.uint64(64 - int(np.log2(len(self.shift))))
        at = np.arange(0, len(hashes), STRETCH)
        limit = np.minimum(at + STRETCH, len(hashes))
        at = np.maximum(at, self.span - 1)
        stops, keys = [], []
        while len(at):
            live = at < limit
            at, limit = at[live], limit[live]
            key = self.blocks(hashes, at, block)
            step = self.shift[(key >> down).astype(np.int64)].astype(np.int64)
            here = step == 0
            stops.append(at[here])
            keys.append(key[here])
            at = at + np.maximum(step, 1)
        none = np.zeros(0, np.int64)
        return (np.concatenate(stops), np.concatenate(keys)) if stops else (none, none.astype(np.uint64))

    def found(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First words of occurrences, and the numbers of the windows."""
        block = min(2, self.span)
        ends, keys = self.stops(hashes)
        begin = ends - self.span + 1
        inside = begin >= words.first[np.searchsorted(words.first, ends, side="right") - 1]
        begin, keys = begin[inside], keys[inside]
        low, high = np.searchsorted(self.suffix, keys), np.searchsorted(self.suffix, keys, side="right")
        own = self.blocks(hashes, begin + block - 1, block)
        used = high > low
        begin, own, low, high = begin[used], own[used], low[used], high[used]
        part = np.cumsum(high - low) // EXPAND
        for x in np.unique(part):
            some = part == x
            sizes = (high - low)[some]
            window = np.repeat(low[some], sizes) + ranges(sizes)
            alike = self.prefix[window] == np.repeat(own[some], sizes)
            window, at = window[alike], np.repeat(begin[some], sizes)[alike]
            for a in range(0, len(at), 1 << 15):
                w, b = window[a : a + (1 << 15)], at[a : a + (1 << 15)]
                same = self.equal(words, b, self.first[w])
                yield b[same], self.number[w[same]]

    def equal(self, words: Words, at: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Whether the words from `at` are, byte for byte, the window's from `first`."""
        step = np.arange(self.span)
        here, there = (at[:, None] + step), (first[:, None] + step)
        size = words.ends[here] - words.starts[here]
        same = (size == self.words.ends[there] - self.words.starts[there]).all(axis=1)
        size, here, there = size[same].ravel(), here[same].ravel(), there[same].ravel()
        if len(size):
            inner = ranges(size)
            left = words.texts.data[np.repeat(words.starts[here], size) + inner]
            right = self.words.texts.data[np.repeat(self.words.starts[there], size) + inner]
            cut = np.concatenate([[0], np.cumsum(size)[:-1]])[:: self.span]
            same[same] = ~np.logical_or.reduceat(left != right, cut)
        return same


def _tables(windows: pa.Table) -> tuple[list[Tables], pa.Array]:
    """Tables by window length for (span, words, item_id) rows, and the item of each window's number."""
    texts = as_texts(windows.column("words"))
    words = texts.words(IN_WORD)
    spans = windows.column("span").to_numpy()
    made = []
    for span in np.unique(spans):
        number = np.flatnonzero(spans == span)
        made.append(Tables.of(int(span), words, words.first[number], number))
    return made, windows.column("item_id").combine_chunks()


def _search(sent):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables, items = sent.value
        for piece in slices(batches):
            words = as_texts(piece.column("text"), lower=True).words(IN_WORD)
            hashes = words.hashes(FIRST)
            at, span, number = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for table in tables:
                for begin, windows in table.found(words, hashes):
                    at.append(begin)
                    span.append(np.full(len(begin), table.span))
                    number.append(windows)
            begin, size, window = (np.concatenate(x) for x in (at, span, number))
            n = piece.num_rows
            rows = np.searchsorted(words.first, begin, side="right") - 1
            spots = np.unique(np.stack([rows, begin - words.first[rows], size]), axis=1)
            named = items.take(pa.array(window)).to_numpy(zero_copy_only=False)
            known = ~np.isnan(named) if named.dtype.kind == "f" else np.ones(len(named), bool)
            pairs = np.unique(np.stack([rows[known], named[known].astype(np.int64)]), axis=1)
            arrays = [piece.column("doc_id"), piece.column("rank"), pa.array(words.counts())]
            arrays += [lists(spots[1].astype(np.int32), spots[0], n), lists(spots[2].astype(np.int32), spots[0], n), lists(pairs[1], pairs[0], n)]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "rank", "n_words", "starts", "spans", "items"])

    return of_batches


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words covered by any window, and the distinct items, of each document."""
    for batch in batches:
        n = batch.num_rows
        n_words = batch.column("n_words").to_numpy()
        base = np.concatenate([[0], np.cumsum(n_words + 1)])
        rows = np.repeat(np.arange(n), list_sizes(batch.column("starts")))
        start = base[rows] + batch.column("starts").flatten().to_numpy()
        change = np.zeros(int(base[-1]) + 1, np.int32)
        np.add.at(change, start, 1)
        np.add.at(change, start + batch.column("spans").flatten().to_numpy(), -1)
        covered = np.concatenate([[0], np.cumsum(np.cumsum(change) > 0)])
        n_hit = covered[base[1:]] - covered[base[:-1]]
        named = [sorted({str(i) for i in x}) for x in batch.column("items").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in named], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in named], pa.string()), pa.array(n_hit > 0),
            ],
            names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
        )


def _judged(sent):
    """Search and judgement in one worker, for a benchmark of one block."""
    search = _search(sent)
    return lambda batches: _judge(search(batches))


def _blocks(docs: DataFrame, benchmark: DataFrame, span: int, block: int) -> tuple[DataFrame, list]:
    """Documents to search, and the tables of each block of windows as broadcasts."""
    spark = docs.sparkSession
    windows = over_texts(benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text"), _item_windows(span), WINDOWS)
    windows = written(windows.distinct())
    blocks = max(1, -(-windows.count() // block))
    place = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    # Blocks hold about `block` pairs; the driver never has more than one of them.
    sent = [spark.sparkContext.broadcast(_tables(windows.where(place == i).toArrow())) for i in range(blocks)]
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("rank"), "text"), sent


def _hits(read: DataFrame, sent: list) -> DataFrame:
    found = [over_texts(read, _search(x), HITS) for x in sent]
    if len(found) == 1:
        return found[0]
    every = reduce(DataFrame.union, found).groupBy("doc_id", "rank", "n_words")
    merged = every.agg(
        (F.count("*") / len(found)).cast("int").alias("rows"),
        *(F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "spans", "items")),
    )
    one = F.explode(F.sequence(F.lit(1), F.col("rows")))
    return merged.withColumn("row", one).drop("row", "rows")


def hits(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """(doc_id, rank, n_words, starts, spans, items) for every row of docs: where windows occur, and of which items."""
    return _hits(*_blocks(docs, benchmark, span, block))


def _clean(sent):
    search = _search(sent)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            none = pa.nulls(piece.num_rows, pa.int64())
            asked = pa.RecordBatch.from_arrays([none, none, piece.column("text")], names=["doc_id", "rank", "text"])
            hit = [list_sizes(x.column("starts")) for x in search([asked])]
            yield piece.filter(pa.array(np.concatenate(hit) == 0)) if hit else piece

    return of_batches


def clean(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """The rows of docs without any window; each row is judged where it is read, nothing is shuffled."""
    for sent in _blocks(docs, benchmark, span, block)[1]:
        docs = over_texts(docs, _clean(sent), docs.schema)
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = SPAN, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for every row of docs(doc_id, text, …)."""
    read, sent = _blocks(docs, benchmark, span, block)
    if len(sent) == 1:
        return over_texts(read, _judged(sent[0]), JUDGED)
    return _hits(read, sent).drop("rank").mapInArrow(_judge, JUDGED)
