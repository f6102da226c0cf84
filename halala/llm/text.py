"""Whole texts as byte arrays inside tasks: slices of Arrow batches, words, and hashes of words and word runs.

Every function works on all rows of a slice at once; a slice holds at most `SLICE` bytes of text, or
another limit, or one row that is longer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE, SMALL = 1 << 20, 1 << 18  # the small one where each byte or row becomes many numbers

WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (splitmix64)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


class Hash:
    """Hashes of byte and value runs, for one seed: equal runs have equal hashes wherever they lie.

    Every step goes through `mix`, which is not linear, so no arrangement of units (such as a text and
    its mirror in two letters) cancels out, and two seeds are independent.
    """

    LONG = 512  # longer byte runs are hashed one by one

    def __init__(self, seed: int):
        draw = np.random.default_rng(seed)
        self.seed, self.left, self.right, self.size = draw.integers(2**62, 2**63, 4, dtype=np.uint64) * _U64(2) + _U64(1)

    def runs(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of values[start:end] for each pair.

        Hashes of all runs of 1, 2, 4, … values follow from each other; a run is covered by the two
        longest such runs at its ends, so both and its length tell it.
        """
        sizes = ends - starts
        out = mix(sizes.astype(_U64) * self.size + self.seed)
        if not len(sizes) or not sizes.any():
            return out
        doubled, width, most = mix(values + self.seed), 1, int(sizes.max())
        while True:
            some = (sizes >= width) & (sizes < 2 * width)
            if some.any():
                a, b = doubled[starts[some]], doubled[ends[some] - width]
                out[some] = mix(mix(a * self.left + out[some]) + b * self.right)
            if 2 * width > most:
                return out
            doubled = mix(mix(doubled[:-width] * self.left) + doubled[width:] * self.right)
            width *= 2

    def bytes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of data[start:end] for each pair, eight bytes at a time."""
        sizes = ends - starts
        out = mix(sizes.astype(_U64) * self.size + self.seed)
        padded = np.append(data, np.zeros(8, np.uint8))
        eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
        long = sizes > self.LONG
        for i in np.flatnonzero(long):
            raw = hashlib.blake2b(data[starts[i] : ends[i]], digest_size=8, key=self.seed.tobytes()).digest()
            out[i] = mix(out[i : i + 1] + np.frombuffer(raw, "<u8"))[0]
        at, left, number = starts[~long], sizes[~long], np.flatnonzero(~long)
        own = out[number]
        while True:
            live = left > 0
            if not live.all():
                out[number] = own
                at, left, number, own = at[live], left[live], number[live], own[live]
            if not len(at):
                return out
            chunk = eight[at] & _FIRST_BYTES[np.minimum(left, 8)]
            own = mix((own ^ chunk) * self.left + self.right)
            at, left = at + 8, left - 8


_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
FIRST, SECOND = Hash(11), Hash(29)


@dataclass
class Texts:
    """The texts of some rows, one after the other."""

    data: np.ndarray  # uint8
    offsets: np.ndarray  # of rows in data, one more than rows

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def words(self, in_word: np.ndarray) -> Words:
        """Maximal runs of bytes for which `in_word` holds, never across rows."""
        n = len(self.data)
        inside = in_word[self.data]
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        before = np.empty(n, bool)
        before[:1], before[1:] = False, inside[:-1]
        starts = np.flatnonzero(inside & (~before | cut[:n]))
        after = np.empty(n, bool)
        after[-1:], after[:-1] = False, inside[1:]
        ends = np.flatnonzero(inside & (~after | cut[1:])) + 1
        return Words(self, starts, ends, np.searchsorted(starts, self.offsets))


@dataclass
class Words:
    """Words of texts: where each starts and ends in the bytes, and the first word of each row."""

    texts: Texts
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # one more than rows

    def hashes(self, by: Hash = FIRST) -> np.ndarray:
        return by.bytes(self.texts.data, self.starts, self.ends)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.texts)), self.counts())


def run_starts(words: Words, k: int) -> np.ndarray:
    """Numbers of the words at which k consecutive words of one row start."""
    left = np.repeat(words.first[1:], words.counts()) - np.arange(len(words.starts))
    return np.flatnonzero(left >= k)


def as_texts(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> Texts:
    """Bytes of a string column; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64, len(column) + 1, column.offset * 8)
    begin, end = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(values, np.uint8, end - begin, begin) if end > begin else np.zeros(0, np.uint8)
    return Texts(LOWER[data] if lower else data, offsets - begin)


def slices(batches: Iterable[pa.RecordBatch], column: str = "text", limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of at most `limit` bytes of text, or of one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(sizes + 64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            yield batch.slice(a, b - a)
    pa.default_memory_pool().release_unused()  # workers are used again


def strings(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A string column from bytes and row offsets."""
    raw = data if isinstance(data, bytes) else data.tobytes()
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(raw)
    ).cast(pa.string())


def ranges(counts: np.ndarray) -> np.ndarray:
    """0, 1, … count - 1 for each count, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - counts, counts)


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def list_sizes(column: pa.Array) -> np.ndarray:
    """Elements of each list; null has none."""
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def lists(values: np.ndarray, rows: np.ndarray, n: int) -> pa.ListArray:
    """A list column of n rows from values in ascending order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)), pa.array(values))
