"""Token files: one array of token ids for all documents, with Elias-Fano coded document boundaries.

The ids of all documents, in ascending order of document id, make one long array. It is stored as a
table of blocks; a block holds a run of whole documents:

    ids      the block's ids, little-endian, 2 bytes each while the vocabulary allows it, else 4
    base     ids before the block in the whole array, and `first`, documents before it
    ends     where each of its documents ends, an increasing sequence, Elias-Fano coded
    doc_ids  the documents' ids, coded alike, less the smallest of the block

Such a sequence takes about 2 + log2(u / n) bits a number (`monotone`). Documents are read by `select`,
which finds any document's place without decoding the rest of its block.

Strings that the tokenizer file lists as added tokens become their ids wherever a text holds them, as
the library does by default.

Edge cases: a null text is empty and has the end id only. Repeated ids follow each other, ordered by
a hash of the text. A null id comes after all others. An empty table gives a table without blocks. A document
longer than a block has a block of its own.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.llm.monotone import EliasFano
from halala.llm.shared import over_texts
from halala.llm.text import FIRST, SECOND, Texts, as_texts, slices, strings
from halala.session import scratch_path

BLOCK_IDS, BLOCK_DOCS = 1 << 20, 1 << 16
READ_AT_ONCE = 1 << 16  # documents whose places are selected at once
NO_ID = (1 << 63) - 1

CODED = "struct<n int, low_bits int, low binary, high binary, samples binary, base bigint>"
BLOCKS = f"shard int, block int, base bigint, first bigint, n_ids bigint, width int, ids binary, ends {CODED}, doc_ids {CODED}"
READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
BEFORE = pa.schema([("shard", pa.int32()), ("ids_before", pa.int64()), ("docs_before", pa.int64())])


class Encoder:
    """Ids of texts by a tokenizer file, encoding each distinct piece of a slice once.

    The tokenizer never merges across the pieces that its pattern finds, so a text may be cut between
    pieces before the library sees it: the ids of the parts, one after the other, are its ids.
    """

    KEPT, KEPT_IDS = 1 << 20, 1 << 22  # pieces remembered between slices, and their ids: long pieces have many
    AT_ONCE = 1 << 16  # bytes of new pieces that the library encodes at once

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values() if t.content]
        self._forget()
        self.line = self.library.encode("\n", add_special_tokens=False).ids[0]
        self.white = np.zeros(256, bool)
        self.white[[*range(0x09, 0x0E), 0x20]] = True
        # First bytes of the white-space characters beyond ASCII.
        self.wide = np.zeros(256, bool)
        self.wide[[0xC2, 0xE1, 0xE2, 0xE3]] = True
        self.letter, self.mark = np.zeros(256, bool), np.zeros(256, bool)
        self.letter[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
        self.mark[[ord(c) for c in "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"]] = True

    def _forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)  # of known pieces, sorted
        self.checks = np.zeros(0, np.uint64)  # by another hash
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)  # their ids in `flat`
        self.flat = np.zeros(0, np.uint32)

    def _cuts(self, data: np.ndarray) -> np.ndarray:
        """Places where the tokenizer's pattern starts a new piece, whatever else the text holds.

        Namely before white space that follows another character; behind a single line end or tab
        between others; and between a letter and a mark, in either order, apostrophes excepted. Only
        ASCII and Latin-1 letters are taken for letters; where a byte leaves doubt, nothing is cut.
        """
        if len(data) < 4:
            return np.zeros(0, np.int64)
        white, beyond = self.white[data], data >= 0x80
        latin = np.zeros(len(data), bool)  # first byte of a Latin-1 letter
        latin[:-1] = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)
        begins = self.letter[data] | latin
        ends = self.letter[data]
        ends[1:] |= latin[:-1]
        solid = ~white & ~beyond | ends  # the last byte of something that is no white space
        plain = ~white & ~beyond | latin  # the first byte of it
        mark = self.mark[data]
        cut = np.zeros(len(data), bool)
        cut[1:] = white[1:] & solid[:-1] | ends[:-1] & mark[1:] | mark[:-1] & begins[1:]
        cut[2:] |= white[1:-1] & (data[1:-1] != 0x20) & solid[:-2] & plain[2:]
        return np.flatnonzero(cut)

    def _ids(self, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of the pieces data[at:end], where each has its first and how many.

        A line end is a token of its own between a piece without white space inside and the next one,
        so such pieces are encoded as lines of one text and told apart by that token.
        """
        odd = np.concatenate([[0], np.cumsum(self.white[data] | self.wide[data])])
        spaced = data[at] == 0x20
        plain = (odd[ends] - odd[at + spaced] == 0) & (ends - at > spaced)
        sizes = np.zeros(len(at), np.int64)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        found = []
        some = np.flatnonzero(plain)
        parts = np.cumsum(ends[some] - at[some] + 1) // self.AT_ONCE
        for part in np.split(some, np.flatnonzero(np.diff(parts)) + 1) if len(some) else []:
            text = b"\n".join(data[a:b].tobytes() for a, b in zip(at[part], ends[part], strict=True)).decode()
            ids = np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            line = ids == self.line
            sizes[part] = np.diff(np.concatenate([[-1], np.flatnonzero(line), [len(ids)]])) - 1
            found.append(ids[~line])
        for i in np.flatnonzero(~plain):
            ids = self.library.encode(data[at[i] : ends[i]].tobytes().decode(), add_special_tokens=False).ids
            sizes[i] = len(ids)
            found.append(np.array(ids, np.uint32))
        flat = np.concatenate(found) if found else np.zeros(0, np.uint32)
        first = np.zeros(len(at), np.int64)
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        return flat, first, sizes

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> None:
        """Encode new pieces, given with their sorted hashes."""
        flat, first, sizes = self._ids(data, at, ends)
        place = np.searchsorted(self.hashes, hashes)
        news = ((self.hashes, hashes), (self.checks, checks), (self.first, first + len(self.flat)), (self.size, sizes))
        self.hashes, self.checks, self.first, self.size = (np.insert(old, place, new) for old, new in news)
        self.flat = np.concatenate([self.flat, flat])

    def _each(self, texts: Texts, rows: np.ndarray) -> list[np.ndarray]:
        """Ids of whole rows by the library itself."""
        raw = [texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes().decode() for i in rows]
        return [np.array(self.library.encode(x, add_special_tokens=False).ids, np.uint32) for x in raw]

    def _with_added(self, texts: Texts) -> np.ndarray:
        """Rows that hold the string of an added token, which may not be cut into pieces."""
        raw, found = texts.data.tobytes(), []
        for content in self.added:
            at = raw.find(content)
            while at >= 0:
                row = int(np.searchsorted(texts.offsets, at, side="right")) - 1
                if at + len(content) <= texts.offsets[row + 1]:
                    found.append(row)
                    at = raw.find(content, int(texts.offsets[row + 1]))
                else:
                    at = raw.find(content, at + 1)
        return np.unique(np.array(found, np.int64))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and the number of ids of each row."""
        texts = as_texts(column)
        whole = self._with_added(texts)
        if not len(whole):
            return self._by_pieces(texts)
        keep = np.ones(len(texts), bool)
        keep[whole] = False
        others = np.flatnonzero(keep)
        ids, sizes = self._by_pieces(as_texts(strings(texts.data, texts.offsets).take(pa.array(others))))
        parts: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(texts)
        for i, part in zip(others, np.split(ids, np.cumsum(sizes)[:-1]) if len(others) else [], strict=True):
            parts[i] = part
        for i, part in zip(whole, self._each(texts, whole), strict=True):
            parts[i] = part
        return np.concatenate(parts), np.array([len(x) for x in parts], np.int64)

    def _by_pieces(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = texts.data, texts.offsets
        cut = np.zeros(len(data) + 1, bool)
        cut[self._cuts(data)] = True
        cut[offsets] = True
        cuts = np.flatnonzero(cut[:-1])
        ends = np.append(cuts[1:], len(data))[: len(cuts)]
        hashes, example, back = np.unique(FIRST.bytes(data, cuts, ends), return_index=True, return_inverse=True)
        every = SECOND.bytes(data, cuts, ends)
        checks = every[example]
        if len(self.hashes) > self.KEPT or len(self.flat) > self.KEPT_IDS:
            self._forget()
        place = np.minimum(np.searchsorted(self.hashes, hashes), max(0, len(self.hashes) - 1))
        new = self.hashes[place] != hashes if len(self.hashes) else np.ones(len(hashes), bool)
        alike = (checks[back] == every).all() and (not len(self.hashes) or (self.checks[place] == checks)[~new].all())
        if not alike:  # two pieces share a hash: neither is taken for the other
            found = self._each(texts, np.arange(len(texts)))
            return np.concatenate([np.zeros(0, np.uint32), *found]), np.array([len(x) for x in found], np.int64)
        if new.any():
            at = example[new]
            self._learn(hashes[new], checks[new], data, cuts[at], ends[at])
        piece = np.searchsorted(self.hashes, hashes)[back]
        each = self.size[piece]
        to = np.cumsum(each)
        ids = self.flat[np.repeat(self.first[piece] - (to - each), each) + np.arange(int(to[-1]) if len(to) else 0)]
        totals = np.concatenate([[0], to])
        return ids, np.diff(totals[np.searchsorted(cuts, offsets)])


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    """One encoder per worker process, which keeps its pieces from task to task."""
    return Encoder(path)


def _coded(values: list[EliasFano], bases: list[int]) -> pa.StructArray:
    rows = [{"n": v.n, "low_bits": v.low_bits, "low": v.low, "high": v.high, "samples": v.samples, "base": b} for v, b in zip(values, bases, strict=True)]
    kind = pa.struct([("n", pa.int32()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("samples", pa.binary()), ("base", pa.int64())])
    return pa.array(rows, kind)


def _blocks(path: str, end: int, block_ids: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encoder = _encoder(path)
        width = 2 if encoder.library.get_vocab_size() <= 1 << 16 else 4
        state = {"block": 0, "base": 0, "first": 0}
        ids: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        names: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            flat, sizes, keys = np.concatenate(ids), np.concatenate(counts), np.concatenate(names)
            ends = EliasFano.of(np.cumsum(sizes) - 1)
            least = int(keys[0])
            known = EliasFano.of((keys - least).astype(np.uint64))
            arrays = [pa.array([x]) for x in (np.int32(shard), np.int32(state["block"]), state["base"], state["first"], len(flat), np.int32(width))]
            arrays += [pa.array([flat.astype(f"<u{width}").tobytes()], pa.binary()), _coded([ends], [0]), _coded([known], [least])]
            state["block"] += 1
            state["base"] += len(flat)
            state["first"] += len(sizes)
            for x in (ids, counts, names):
                x.clear()
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "block", "base", "first", "n_ids", "width", "ids", "ends", "doc_ids"])

        for piece in slices(batches):
            found, sizes = encoder.encode(piece.column("text"))
            # The end id after each document.
            flat = np.full(len(found) + len(sizes), end, np.uint32)
            to = np.cumsum(sizes + 1)
            body = np.ones(len(flat), bool)
            body[to - 1] = False
            flat[body] = found
            ids.append(flat)
            counts.append(sizes + 1)
            names.append(piece.column("id").to_numpy())
            if sum(map(len, ids)) >= block_ids or sum(map(len, counts)) >= BLOCK_DOCS:
                yield flush()
        if ids:
            yield flush()

    return of_batches


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Write docs(doc_id, text, …) as a token table at `path`.

    Documents are sorted by ranges of ids, so a block's shard number is its place. `base` and `first`
    count within the shard; the totals of shards, one row each, are added when the table is read.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id")
    placed = docs.select(key, F.xxhash64("text").alias("rank"), "text").repartitionByRange("id", "rank")
    ordered = placed.sortWithinPartitions("id", "rank", "text")
    over_texts(ordered, _blocks(tokenizer, end, block_ids), BLOCKS).write.parquet(path)


def open_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Blocks of the token table with `base` and `first` counted over the whole array."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"), F.sum("ends.n").alias("docs")).orderBy("shard").collect()
    rows, ids, docs = [], 0, 0
    for row in totals:  # as many as partitions of the write
        rows.append({"shard": row["shard"], "ids_before": ids, "docs_before": docs})
        ids, docs = ids + row["n"], docs + row["docs"]
    # From Arrow, a local table needs no Python workers of its own, which would stay beside those of the texts.
    before = spark.createDataFrame(pa.Table.from_pylist(rows, BEFORE))
    joined = blocks.join(F.broadcast(before), "shard")
    return joined.withColumns({"base": F.col("base") + F.col("ids_before"), "first": F.col("first") + F.col("docs_before")}).drop("ids_before", "docs_before")


def _sequence(row: dict) -> EliasFano:
    return EliasFano(row["n"], row["low_bits"], row["low"], row["high"], row["samples"])


def _of_block(row: dict, at: np.ndarray) -> pa.RecordBatch:
    """The documents at the given places of a block, whose ends and ids are selected."""
    ids = np.frombuffer(row["ids"], f"<u{row['width']}")
    coded = _sequence(row["ends"])
    ends = coded.select(at) + 1
    starts = np.where(at > 0, coded.select(np.maximum(at - 1, 0)) + 1, 0)
    sums = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    names = _sequence(row["doc_ids"]).select(at) + row["doc_ids"]["base"]
    return pa.RecordBatch.from_arrays([pa.array(names), pa.array(starts + row["base"]), pa.array(ends - starts), pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])


def _block_rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for i in range(batch.num_rows):
        yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _block_rows(batch):
            for a in range(0, row["ends"]["n"], READ_AT_ONCE):
                yield _of_block(row, np.arange(a, min(a + READ_AT_ONCE, row["ends"]["n"])))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, decoded from the blocks."""
    read = open_tokens(spark, path).mapInArrow(_documents, READ)
    return read.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))


def encoded(docs: DataFrame, tokenizer: str, end: int = 0, block_ids: int = BLOCK_IDS) -> DataFrame:
    """The documents as read back from a new token table in the shared folder."""
    spark = docs.sparkSession
    path = scratch_path(spark)
    write_tokens(docs, path, tokenizer, end, block_ids)
    return read_documents(spark, path)
