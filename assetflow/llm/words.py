"""Words of many texts at once: boundaries and 128-bit hashes from the UTF-8 bytes."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

MASK = (1 << 64) - 1
#: Bases of the two polynomial hashes (odd, so that they have inverses modulo 2**64).
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_rng = np.random.Generator(np.random.PCG64(20240229))
#: A random 64-bit value for each byte, for each hash.
VALUES = _rng.integers(0, 1 << 64, (2, 256), dtype=np.uint64, endpoint=False)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit over all output bits."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n; kept up to 8 M, built anew beyond."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        out = []
        for b in (BASES[which], pow(BASES[which], -1, 1 << 64)):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = (out[0], out[1])
        if size <= 8 << 20:
            _powers[which] = have
    return have


class Prefix:
    """Hashes of any substrings of ``data`` by prefix sums."""

    def __init__(self, data: np.ndarray, which: int):
        self.inverse = powers(which, len(data) + 1)[1]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(VALUES[which][data] * powers(which, len(data) + 1)[0][:len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


class Words(NamedTuple):
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    h1: np.ndarray
    h2: np.ndarray


def boundaries(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes that are not ASCII white space, within rows.

    ``cuts``: positions where a run is cut besides.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    if cuts is not None:
        edge[cuts] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    doc = np.searchsorted(offsets, start, side="right") - 1
    return start, end, doc


def split(data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray | None = None) -> Words:
    start, end, doc = boundaries(data, offsets, cuts)
    return Words(start, end, doc, Prefix(data, 0).of(start, end), Prefix(data, 1).of(start, end))


def distinct(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of the first of each distinct 128-bit hash, and for each row its distinct number."""
    _, first, inverse = np.unique(h1, return_index=True, return_inverse=True)
    if not np.array_equal(h2[first][inverse], h2):  # 64 bits met by chance: use all 128
        both = np.empty(len(h1), [("a", np.uint64), ("b", np.uint64)])
        both["a"], both["b"] = h1, h2
        _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
    return first, inverse.reshape(-1)


class Known:
    """Row numbers of 128-bit hashes met so far in a task, up to ``most`` of them.

    A memo only: when it is full it starts afresh, and what is not known is worked out again.
    """

    def __init__(self, most: int = 600_000):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.h1 = np.zeros(0, np.uint64)
        self.h2 = np.zeros(0, np.uint64)
        self.row = np.zeros(0, np.int64)
        self.size = 0

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Row of each hash, -1 where it is not known."""
        if not len(self.h1):
            return np.full(len(h1), -1, np.int64)
        at = np.minimum(np.searchsorted(self.h1, h1), len(self.h1) - 1)
        return np.where((self.h1[at] == h1) & (self.h2[at] == h2), self.row[at], -1)

    def add(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Rows given to new hashes (each once in the call), numbered on from the last."""
        new = np.arange(self.size, self.size + len(h1))
        self.size += len(h1)
        order = np.argsort(h1, kind="stable")
        at = np.searchsorted(self.h1, h1[order])
        fresh = np.ones(len(order), bool)
        if len(self.h1):
            fresh = self.h1[np.minimum(at, len(self.h1) - 1)] != h1[order]
        order, at = order[fresh], at[fresh]
        self.h1 = np.insert(self.h1, at, h1[order])
        self.h2 = np.insert(self.h2, at, h2[order])
        self.row = np.insert(self.row, at, new[order])
        return new
