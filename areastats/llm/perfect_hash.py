"""A minimal perfect hash of distinct integer keys, built and asked in whole arrays.

Every level is a bit array about twice as long as the keys left; a key whose bit nobody else wants sets it and is placed,
the others go on to the next level. A key's number is the rank of its bit, so n keys get the numbers 0 to n - 1 from about
four bits each. A foreign key gets some number too: callers compare the key kept there.
"""

from __future__ import annotations

import struct

import numpy as np

_U = np.uint64


def mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """Well spread 64-bit values of the keys, others at every level."""
    x = keys.astype(_U) + _U((0x9E3779B97F4A7C15 * (level + 1)) & (1 << 64) - 1)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class PerfectHash:
    def __init__(self, levels: list[np.ndarray]):
        """`levels` holds the 64-bit words of each level."""
        self.levels, self.before, n = levels, [], 0
        for words in levels:
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            self.before.append(np.concatenate([[n], n + ones[:-1]]).astype(np.int64))
            n += int(ones[-1])
        self.n = n

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """Of distinct keys."""
        left, levels = keys.astype(_U), []
        while len(left):
            words = max(1, -(-2 * len(left) // 64))
            at = (mixed(left, len(levels)) % _U(64 * words)).astype(np.int64)
            alone = np.bincount(at, minlength=64 * words) == 1
            levels.append(np.packbits(alone, bitorder="little").view(_U))
            left = left[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 for keys that no level holds, which are foreign."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, left = np.arange(len(keys)), keys.astype(_U)
        for level, words in enumerate(self.levels):
            if not len(left):
                break
            at = mixed(left, level) % _U(64 * len(words))
            word, bit = (at >> _U(6)).astype(np.int64), at & _U(63)
            here = words[word] >> bit & _U(1) == 1
            low = words[word[here]] & ((_U(1) << bit[here]) - _U(1))
            out[open_[here]] = self.before[level][word[here]] + np.bitwise_count(low)
            open_, left = open_[~here], left[~here]
        return out

    def to_bytes(self) -> bytes:
        sizes = [len(w) for w in self.levels]
        return struct.pack(f"<{len(sizes) + 1}Q", len(sizes), *sizes) + b"".join(w.tobytes() for w in self.levels)

    @classmethod
    def from_buffer(cls, data, at: int = 0) -> tuple[PerfectHash, int]:
        (n,) = struct.unpack_from("<Q", data, at)
        sizes, at, levels = struct.unpack_from(f"<{n}Q", data, at + 8), at + 8 + 8 * n, []
        for size in sizes:
            levels.append(np.frombuffer(data, _U, size, at))
            at += 8 * size
        return cls(levels), at
