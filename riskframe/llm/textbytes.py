"""Words of many texts at once, as NumPy arrays over the UTF-8 bytes of an Arrow column.

A word is a run of bytes outside space and 0x09-0x0D. Words are named by a 64-bit polynomial hash
(odd base, modulo 2^64) that is mixed afterwards; all texts of a block are hashed by one prefix sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_BASE, -1, 1 << 64)
BLOCK_BYTES = 1 << 20

_power = np.ones(1, U)
_unpower = np.ones(1, U)
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n; kept for the largest n so far."""
    global _power, _unpower
    while len(_power) < n:
        k = len(_power)
        _power = np.concatenate([_power, _power * U(pow(_BASE, k, 1 << 64))])
        _unpower = np.concatenate([_unpower, _unpower * U(pow(_INVERSE, k, 1 << 64))])
    return _power, _unpower


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A seeded bijection on 64 bits (two rounds of multiply and xor-shift)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & _MASK)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def odd_constants(n: int, seed: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=U), seed) | U(1)


def blocks(column: pa.Array, size: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows with about ``size`` bytes of text; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    off = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None and buffers[2].size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + size, "right")) - 1)
        end = min(end, n)
        yield row, data[off[row] : off[end]], off[row : end + 1] - off[row]
        row = end


class Words:
    """Words of one block: ``start``/``end`` byte positions, ``hash``, and ``first[d]`` the first word of text d."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data = LOWER[data] if lower else data
        n = len(data)
        filled = ~_IS_BLANK[data]
        starts, ends = filled.copy(), filled.copy()
        if n:
            joint = filled[1:] & filled[:-1]
            cut = offsets[(offsets > 0) & (offsets < n)]
            joint[cut - 1] = False
            starts[1:] &= ~joint
            ends[:-1] &= ~joint
        self.filled = filled
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._sums: np.ndarray | None = None

    def spans_hash(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        power, unpower = _powers(len(self.data) + 1)
        if self._sums is None:
            self._sums = np.zeros(len(self.data) + 1, U)
            np.cumsum((self.data.astype(U) + U(1)) * power[: len(self.data)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * unpower[start], seed)

    @property
    def hash(self) -> np.ndarray:
        return self.spans_hash(self.start, self.end)


def windows(hashes: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every run of ``width`` words (runs that cross texts included; callers cut them off)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for k, c in enumerate(odd_constants(width, seed)):
        total += hashes[k : k + n] * c
    return mix(total, seed)
