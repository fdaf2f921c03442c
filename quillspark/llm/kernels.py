"""Vectorised work on the bytes of whole texts: words, their hashes, and shingles.

A task sees texts as Arrow buffers. They are taken in slices of some MB, so that memory does not
depend on how many rows a batch has; a single text longer than a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quillspark.llm.common import mix64

SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes with A-Z in lower case.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BYTE_HASH = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) | np.uint64(1)
_BYTE_HASH[SPACE] = 0
LOWER_BYTE_HASH = _BYTE_HASH[LOWER]
#: For hashes that tell letters of either case apart.
EXACT_BYTE_HASH = _BYTE_HASH
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i under n."""
    if len(_powers[0]) < n:
        m = max(n, SLICE_BYTES + 1)
        for k, x in ((0, _BASE), (1, _BASE_INVERSE)):
            steps = np.full(m, x, np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0][:n], _powers[1][:n]


def text_slices(column: pa.Array, slice_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows' texts in bytes); a null text is an empty one."""
    if column.null_count:
        column = pc.fill_null(column, "")
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        kind = np.int32
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + slice_bytes, "right")) - 1)
        end = min(end, n)
        yield row, raw[at[row] : at[end]], at[row : end + 1] - at[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs without ASCII white space) and, for each row, its first word's number."""
    solid = ~SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    cut = offsets[1:-1]
    cut = cut[cut < len(data)]
    first[cut] = solid[cut]
    starts = np.flatnonzero(first)
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    cut = cut[cut > 0] - 1
    last[cut] = solid[cut]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, table: np.ndarray = LOWER_BYTE_HASH) -> np.ndarray:
    """A 64-bit hash of each word, letters A-Z as lower case."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data))
    return mix64(np.add.reduceat(table[data] * up, starts) * down[starts])


def shingle_sets(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct 64-bit hashes of the k-word shingles) of every row.

    Fewer than k words count as one shingle; no word makes an empty set.
    """
    odd = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    for row, data, offsets in text_slices(column):
        starts, _, first = word_bounds(data, offsets)
        h = word_hashes(data, starts)
        m = max(0, len(h) - k + 1)
        s = np.zeros(m, np.uint64)
        for j in range(k):
            s += h[j : j + m] * odd[j]
        s = mix64(s)
        for i in range(len(offsets) - 1):
            lo, hi = first[i], first[i + 1]
            if hi - lo >= k:
                yield row + i, np.unique(s[lo : hi - k + 1])
            elif hi > lo:
                x = np.uint64(hi - lo)
                with np.errstate(over="ignore"):
                    for y in h[lo:hi]:
                        x = np.uint64(x * _BASE + y)
                yield row + i, mix64(np.array([x], np.uint64))
            else:
                yield row + i, np.zeros(0, np.uint64)


class UnionFind:
    """Disjoint sets over 0..n-1; roots are smallest members."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)
        return x != y

    def roots(self) -> np.ndarray:
        return np.array([self.root(x) for x in range(len(self.parent))], np.int64)
