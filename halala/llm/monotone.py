"""Elias-Fano sequences: non-decreasing numbers in near-minimal space, read at any place.

A sequence of n numbers below u takes l = floor(log2(u / n)) low bits of each in one packed array,
and the rest in a bit array where number i sets bit (high part + i): 2 + l bits each, without tables
of 64-bit numbers. The place of every `SAMPLE`-th set bit is kept, so `select` reads a few words
behind the sample before the wanted bit, and nothing else of the sequence.

All reads take arrays of places or numbers and work on them at once. The bytes may be views of a
memory-mapped file; nothing is copied when a sequence is opened.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 64
MOST_LOW = 56  # low bits of one number lie within nine bytes

_U64 = np.uint64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_SET = _BITS.sum(axis=1).astype(np.uint8)  # set bits of each byte
# Place of set bit k of each byte, 8 where there are fewer.
_PLACE = np.sort(np.where(_BITS == 1, np.arange(8), 8), axis=1).astype(np.uint8)


def _bytes(raw: bytes | memoryview | np.ndarray) -> np.ndarray:
    return raw if isinstance(raw, np.ndarray) else np.frombuffer(raw, np.uint8)


@dataclass
class EliasFano:
    """A non-decreasing sequence of numbers from 0 on."""

    n: int
    low_bits: int
    low: bytes | memoryview | np.ndarray
    high: bytes | memoryview | np.ndarray
    samples: bytes | memoryview | np.ndarray

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        values = values.astype(_U64)
        top = int(values[-1]) + 1 if n else 1
        low_bits = min(MOST_LOW, max(0, (top // max(n, 1)).bit_length() - 1))
        place = (values >> _U64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(place[-1]) + 1 if n else 0, np.uint8)
        high[place] = 1
        low = bytearray()
        for a in range(0, n if low_bits else 0, 1 << 16):  # a multiple of 8 numbers fills whole bytes
            bits = (values[a : a + (1 << 16), None] >> np.arange(low_bits, dtype=_U64)) & _U64(1)
            low += np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        return cls(n, low_bits, bytes(low), np.packbits(high, bitorder="little").tobytes(), place[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: np.ndarray) -> np.ndarray:
        """Low bits of the numbers at places i, from the nine bytes around each."""
        if not self.low_bits:
            return np.zeros(len(i), np.int64)
        raw = _bytes(self.low)
        bit = i * self.low_bits
        at = (bit >> 3)[:, None] + np.arange(9)
        around = raw[np.minimum(at, len(raw) - 1)]
        shift = (bit & 7).astype(_U64)
        word = np.ascontiguousarray(around[:, :8]).view("<u8").ravel() >> shift
        word |= (around[:, 8].astype(_U64) << (_U64(63) - shift)) << _U64(1)
        return (word & _U64((1 << self.low_bits) - 1)).astype(np.int64)

    def select(self, i: np.ndarray | int) -> np.ndarray:
        """The numbers at places i, each from the sample before it."""
        if np.ndim(i) == 0:
            return self.select(np.array([i]))[0]
        i = np.asarray(i, np.int64)
        if len(i) and not (0 <= i.min() and i.max() < self.n):
            raise IndexError("no such place")
        raw = _bytes(self.high)
        start = _bytes(self.samples).view("<u4")[i // SAMPLE].astype(np.int64)
        at, left = start >> 3, i % SAMPLE
        # Set bits before the sample in its own byte are passed over.
        left = left + _SET[raw[at] & ((1 << (start & 7)) - 1).astype(np.uint8)] if len(i) else left
        live = np.arange(len(i))
        while len(live):
            here = _SET[raw[at[live]]]
            live = live[left[live] >= here]
            here = _SET[raw[at[live]]]
            left[live] -= here
            at[live] += 1
        place = at * 8 + _PLACE[raw[at], left] if len(i) else at
        return ((place - i) << self.low_bits) + self._low(i)

    def all(self) -> np.ndarray:
        """The whole sequence, read from one end to the other."""
        ones = np.flatnonzero(np.unpackbits(_bytes(self.high), bitorder="little"))[: self.n]
        i = np.arange(self.n)
        return ((ones - i) << self.low_bits) + self._low(i)

    def successor(self, wanted: np.ndarray, begin: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """Place of the first number that is at least the wanted one, within [begin, end) where given.

        Few numbers are looked for by bisection over `select`; for many, reading the sequence once is less work.
        """
        low = np.zeros(len(wanted), np.int64) if begin is None else begin.copy()
        high = np.full(len(wanted), self.n, np.int64) if end is None else end.copy()
        if 16 * len(wanted) >= self.n:
            return np.clip(np.searchsorted(self.all(), wanted), low, high)
        live = np.flatnonzero(low < high)
        while len(live):
            middle = (low[live] + high[live]) >> 1
            less = self.select(middle) < wanted[live]
            low[live[less]] = middle[less] + 1
            high[live[~less]] = middle[~less]
            live = live[low[live] < high[live]]
        return low
