"""Texts as numbers that all tasks agree on: slices of texts, and one numbering of their words.

A slice holds the texts of up to `SLICE` bytes as one row: the sorted 64-bit hashes of its distinct words
(keys), and each word of the texts as its place among them. Slices are written once, bucketed, so
whatever is joined to them later does not move them.

Numbers and counts of words come from an exchange: each slice sends its keys with their counts to the
shards of the key space, a shard sums them, numbers its distinct keys, the most frequent first, and
answers. So frequent words have small numbers, which pack well. All that is sent is packed by `pack`,
since rows of single words or phrases would be many times larger. A key appears once a slice in one shard
however often it occurs, so frequent words weigh no more than rare ones.

A part (say, a language) has its own numbering.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.session import scratch_path

SLICE = 1 << 23  # bytes of text
SHARD = 1 << 18  # keys that a shard gets, about
PLACE_BITS = 20  # a shard has far fewer distinct keys than this allows

_ZSTD = pa.Codec("zstd", compression_level=1)

KEYS = "part string, shard bigint, slice bigint, n int, packed binary"
NUMBERS = "part string, shard bigint, slice bigint, n int, packed binary, owned binary, known bigint"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers, each as planes of its least bytes, compressed."""
    out = bytearray()
    for values in arrays:
        width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
        out += bytes([width])
        out += values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return len(out).to_bytes(8, "little") + _ZSTD.compress(bytes(out), asbytes=True)


def unpack(raw: bytes | pa.Buffer, *sizes: int) -> list[np.ndarray]:
    """The arrays, of the given lengths, as unsigned 64-bit integers."""
    view = memoryview(raw)
    data = np.frombuffer(_ZSTD.decompress(view[8:], int.from_bytes(view[:8], "little")), np.uint8)
    out, at = [], 0
    for n in sizes:
        width = int(data[at])
        planes = np.zeros((n, 8), np.uint8)
        planes[:, :width] = data[at + 1 : at + 1 + n * width].reshape(width, n).T
        out.append(planes.view("<u8").ravel())
        at += 1 + n * width
    return out


def bucketed(rows: DataFrame, column: str) -> DataFrame:
    """The rows as a table in the shared folder, in as many buckets as a shuffle has partitions.

    The table needs a name while it is written; the name goes at once, the files stay.
    """
    spark = rows.sparkSession
    name = f"slices_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = rows.write.bucketBy(buckets, column).option("path", scratch_path(spark)).option("compression", "zstd")
    writer.saveAsTable(name)
    read = spark.table(name)
    spark.sql(f"drop table {name}")
    return read


class Numbering:
    """Slice numbers within a task: unique over the partitions of the table that is written."""

    def __init__(self) -> None:
        self.next = TaskContext.get().partitionId() << 32

    def __call__(self) -> int:
        self.next += 1
        return self.next


def local(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, where each occurs first, and the place of every key among them."""
    return np.unique(keys, return_index=True, return_inverse=True)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, packed as the steps between them."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(raw: pa.Buffer, n: int) -> np.ndarray:
    return np.cumsum(unpack(raw, n)[0], dtype=np.uint64)


def by_number(places: np.ndarray, numbers: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same words as places among the slice's words in order of their numbers; the numbers and counts in that order."""
    order = np.argsort(numbers, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank[places], numbers[order], counts[order]


def _cut(keys: np.ndarray, bits: int) -> np.ndarray:
    """First key of each of 2**bits shards of the sorted keys, and their number."""
    if not bits:
        return np.array([0, len(keys)])
    return np.append(np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)), len(keys))


def shard_bits(total: int, each: int = SHARD) -> int:
    """So many bits of a hash make shards of about `each` keys."""
    return max(0, (-(-total // each) - 1).bit_length()) if total > each else 0


def _send(bits: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column("n_keys")[i].as_py()
                keys = unpack_keys(batch.column("keys")[i].as_buffer(), n)
                counts = unpack(batch.column("counts")[i].as_buffer(), n)[0]
                cuts = _cut(keys, bits)
                shards = np.flatnonzero(np.diff(cuts))
                raw = [pack(np.diff(keys[cuts[s] : cuts[s + 1]], prepend=np.uint64(0)), counts[cuts[s] : cuts[s + 1]]) for s in shards]
                n = len(shards)
                part, number = batch.column("part")[i].as_py(), batch.column("slice")[i].as_py()
                arrays = [pa.array([part] * n, pa.string()), pa.array(shards, pa.int64()), pa.array([number] * n, pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.diff(cuts)[shards], pa.int32()), pa.array(raw, pa.binary())], names=["part", "shard", "slice", "n", "packed"])

    return of_batches


def merged(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First row of each distinct row of the columns, in ascending order, and the place of every row among them."""
    _, first, rank = np.unique(columns[0], return_index=True, return_inverse=True)
    for column in columns[1:]:
        words, inner = np.unique(column, return_inverse=True)
        _, first, rank = np.unique(rank.astype(np.int64) * max(1, len(words)) + inner, return_index=True, return_inverse=True)
    return first, rank


def _number(rows: pa.Table, bits: int) -> pa.Table:
    """Sum the keys of one shard, number them by falling count, and answer every slice."""
    order = np.argsort(rows.column("slice").to_numpy(), kind="stable")
    rows = rows.take(pa.array(order))
    sizes = rows.column("n").to_numpy().astype(np.int64)
    sent = [unpack(x.as_buffer(), n, n) for x, n in zip(rows.column("packed"), sizes, strict=True)]
    keys = np.concatenate([np.cumsum(x[0], dtype=np.uint64) for x in sent])
    counts = np.concatenate([x[1] for x in sent])
    distinct, first, back = np.unique(keys, return_index=True, return_inverse=True)
    if len(distinct) >> PLACE_BITS:
        raise ValueError("a shard has more distinct keys than it may number")
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, back, counts.astype(np.int64))
    number = np.empty(len(distinct), np.int64)
    number[np.lexsort((distinct, -total))] = (np.arange(len(distinct)) << bits) | rows.column("shard")[0].as_py()
    owner = np.zeros(len(keys), np.uint8)
    owner[first] = 1
    ends = np.cumsum(sizes)
    known = np.zeros(len(sizes), np.int64)
    known[0] = (total > 0).sum()
    packed, owned = [], []
    for a, b in zip(ends - sizes, ends, strict=True):
        packed.append(pack(number[back[a:b]], total[back[a:b]]))
        owned.append(np.packbits(owner[a:b]).tobytes())
    return pa.table(
        [rows.column("part"), rows.column("shard"), rows.column("slice"), rows.column("n"), pa.array(packed, pa.binary()), pa.array(owned, pa.binary()), pa.array(known)],
        names=["part", "shard", "slice", "n", "packed", "owned", "known"],
    )


def numbers(slices: DataFrame) -> tuple[DataFrame, int]:
    """(part, shard, slice, n, packed, owned, known): answers to slices(part, slice, keys, counts, n_keys), and the shards' bits.

    An answer holds, in order of the shard's keys in the slice, their numbers and their counts over all
    slices of the part. `owned` marks each distinct key in exactly one slice; `known` sums to the number of
    distinct keys with a count.
    """
    bits = shard_bits(slices.agg(F.sum("n_keys")).first()[0] or 0)
    sent = slices.select("part", "slice", "keys", "counts", "n_keys").mapInArrow(_send(bits), KEYS)
    return sent.groupBy("part", "shard").applyInArrow(lambda rows: _number(rows, bits), NUMBERS), bits


def answers_of(answers: DataFrame, name: str, *columns: str) -> DataFrame:
    """(slice, <name>): the answers to each slice, in order of shards, as one list."""
    return answers.groupBy("slice").agg(F.array_sort(F.collect_list(F.struct("shard", "n", *columns))).alias(name))


def words_below(bits: int) -> int:
    """More than any number that a numbering over 2**bits shards gives."""
    return 1 << (PLACE_BITS + bits)


def of_answers(answers: pa.Scalar, arrays: int) -> list[np.ndarray]:
    """The arrays of all answers of one slice, one shard after the other."""
    parts = [unpack(x["packed"], *[x["n"]] * arrays) for x in answers.as_py()]
    return [np.concatenate([np.zeros(0, np.uint64), *x]).astype(np.int64) for x in zip(*parts, strict=True)]
