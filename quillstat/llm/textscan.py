"""Vectorised text scanning shared by the operators of this package.

Texts of an Arrow batch are joined into one byte buffer (a space around every
document) and scanned with numpy: word bounds, word hashes, rolling n-gram
hashes.  Work is cut into slices of bounded bytes, so memory does not depend on
the batch size; only a single text longer than the slice is handled whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U = np.uint64

#: word separators: space and \x09-\x0D, everything else is word material
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def _table(seed: int) -> np.ndarray:
    t = np.random.default_rng(seed).integers(1, 1 << 63, 256, dtype=np.uint64) * U(2) + U(1)
    t[SPACE] = 0
    return t


BYTE_CODE = _table(20240611)
_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n (grown on demand)."""
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser (murmur3 constants)."""
    h = h ^ (h >> U(33))
    h *= U(0xFF51AFD7ED558CCD)
    h ^= h >> U(33)
    h *= U(0xC4CEB9FE1A85EC53)
    h ^= h >> U(33)
    return h


def as_bytes(column: pa.Array) -> list[bytes]:
    """Texts as UTF-8 bytes; null is empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts together stay within ``limit`` bytes (or are one row)."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > limit:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if lo < len(texts):
        yield lo, len(texts)


class Words:
    """Word bounds and hashes of some texts.

    ``row[i]`` is the text that word i belongs to, ``first[r]`` the index of the
    first word of text r (``first`` has one more entry than there are texts).
    """

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.buf = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offset = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])[:-1]
        gap = SPACE[self.buf]
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        self.first = np.append(np.searchsorted(self.start, self.offset), len(self.start))
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(len(texts)), self.count)
        up, down = powers(len(self.buf))
        self.hash = (mix(np.add.reduceat(BYTE_CODE[self.buf] * up, self.start) * down[self.start])
                     if len(self.start) else np.zeros(0, np.uint64))

    def word(self, i: int) -> bytes:
        return self.buf[self.start[i]:self.end[i]].tobytes()

    def grams(self, n: int, base: int = 0xD6E8FEB86659FD93) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-word windows and the word index where each starts."""
        m = len(self.hash) - n + 1
        if m <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        g = self.hash[:m].copy()
        for j in range(1, n):
            g *= U(base)
            g += self.hash[j:j + m]
        at = np.flatnonzero(self.row[:m] == self.row[n - 1:])
        return mix(g[at]), at


def shingle_sets(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingle hashes per text, as (hashes, bounds per text), sorted within a text.

    A text of 1 to n-1 words has its whole word sequence as its only shingle.
    """
    g, at = w.grams(n)
    row = w.row[at]
    short = np.flatnonzero((w.count > 0) & (w.count < n))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        for j in range(n - 1):
            has = w.count[short] > j
            step = whole[has] * U(0xD6E8FEB86659FD93) + w.hash[w.first[short[has]] + j]
            whole[has] = step
        g = np.concatenate([g, mix(whole + w.count[short].astype(np.uint64))])
        row = np.concatenate([row, short])
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return g, np.searchsorted(row, np.arange(len(w.texts) + 1))


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
