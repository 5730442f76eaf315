"""Elias-Fano coding of ascending integers, with select."""

from __future__ import annotations

import struct

import numpy as np

#: A sampled position for every so many ones; select scans from there.
SAMPLE = 256
HEAD = "<QQBQQQ"


class EliasFano:
    """n ascending values below a universe in about 2 + log2(universe / n) bits each.

    The low bits lie packed; the high bits are unary, value i setting bit (value >> low) + i. Select of value i finds the
    i-th one from the sampled positions. All parts are views of one buffer, so a mapped file is read only where touched.
    """

    def __init__(self, n: int, universe: int, low: int, lows: np.ndarray, highs: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.low, self.lows, self.highs, self.samples = n, universe, low, lows, highs, samples

    @classmethod
    def build(cls, values: np.ndarray, universe: int | None = None) -> EliasFano:
        v = np.asarray(values, dtype=np.uint64)
        n = len(v)
        if n > 1 and (v[1:] < v[:-1]).any():
            raise ValueError("values must ascend")
        universe = int(universe if universe is not None else (int(v[-1]) + 1 if n else 1))
        low = max(0, (universe // max(1, n)).bit_length() - 1)
        bits = (v[:, None] >> np.arange(low, dtype=np.uint64) & np.uint64(1)).astype(np.uint8)
        ones = (v >> np.uint64(low)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1 if n else 0, dtype=np.uint8)
        unary[ones] = 1
        return cls(n, universe, low, np.packbits(bits.ravel(), bitorder="little"), np.packbits(unary, bitorder="little"),
                   ones[::SAMPLE].astype("<u4" if not n or ones[-1] < 2**32 else "<u8"))

    def to_bytes(self) -> bytes:
        wide = self.samples.dtype.itemsize
        head = struct.pack(HEAD, self.n, self.universe, self.low, len(self.lows), len(self.highs), len(self.samples))
        return head + bytes([wide]) + self.lows.tobytes() + self.highs.tobytes() + self.samples.tobytes()

    @classmethod
    def from_buffer(cls, data, at: int = 0) -> tuple[EliasFano, int]:
        """The list that starts at byte `at` of a buffer, and the byte after it. Nothing is copied."""
        n, universe, low, a, b, c = struct.unpack_from(HEAD, data, at)
        at += struct.calcsize(HEAD) + 1
        wide = data[at - 1]
        lows = np.frombuffer(data, np.uint8, a, at)
        highs = np.frombuffer(data, np.uint8, b, at + a)
        samples = np.frombuffer(data, f"<u{wide}", c, at + a + b)
        return cls(n, universe, low, lows, highs, samples), at + a + b + c * wide

    def _one(self, i: int) -> int:
        """Position of the i-th one of the high bits."""
        at = int(self.samples[i // SAMPLE])
        left = i % SAMPLE
        if not left:
            return at
        byte = (at + 1) >> 3
        first = int(self.highs[byte]) >> (at + 1 & 7) << (at + 1 & 7)
        left -= 1
        count = first.bit_count()
        while left >= count:
            left -= count
            byte += 1
            first = int(self.highs[byte])
            count = first.bit_count()
        for _ in range(left):
            first &= first - 1
        return byte * 8 + (first & -first).bit_length() - 1

    def select(self, i: int) -> int:
        """Value i."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        high = self._one(i) - i
        start = i * self.low
        chunk = int.from_bytes(self.lows[start >> 3 : (start + self.low + 7) >> 3].tobytes(), "little")
        return high << self.low | chunk >> (start & 7) & ((1 << self.low) - 1)

    def all(self) -> np.ndarray:
        """Every value, by one pass over the bits."""
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low)
        bits = np.unpackbits(self.lows, bitorder="little", count=self.n * self.low).reshape(self.n, self.low)
        for i in range(self.low):
            high |= bits[:, i].astype(np.uint64) << np.uint64(i)
        return high

    def successor(self, x: int, begin: int = 0, end: int | None = None) -> int:
        """Index of the first value in [begin, end) not below x, by binary search over select; `end` if there is none."""
        end = self.n if end is None else end
        while begin < end:
            mid = (begin + end) // 2
            if self.select(mid) < x:
                begin = mid + 1
            else:
                end = mid
        return begin
