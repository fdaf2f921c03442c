"""Cutting stock by column generation, in whole units: which patterns of lengths fill how many bars."""

from __future__ import annotations

import numpy as np


def knapsack(values: np.ndarray, lengths: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern that fits, by dynamic programming over capacities; (value, times each length)."""
    best = np.zeros(capacity + 1)
    took = np.full(capacity + 1, -1)
    for w in range(1, capacity + 1):
        best[w] = best[w - 1]
        k = int(np.searchsorted(lengths, w, "right"))
        if k:
            v = best[w - lengths[:k]] + values[:k]
            i = int(v.argmax())
            if v[i] > best[w] + 1e-12:
                best[w], took[w] = v[i], i
    pattern, w = np.zeros(len(lengths), np.int64), capacity
    while w > 0:
        if took[w] < 0:
            w -= 1
        else:
            pattern[took[w]] += 1
            w -= int(lengths[took[w]])
    return float(best[capacity]), pattern


def greedy_basis(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A first basis (columns are patterns) and its non-negative solution.

    Bars are filled as exactly as possible from the largest length down, and each pattern is repeated, in
    parts of bars too, until it uses up a length; that length owns the pattern's column.
    """
    m, left = len(lengths), demand.astype(np.float64).copy()
    place = {int(k): i for i, k in enumerate(lengths)}
    basis, x, open_ = np.zeros((m, m)), np.zeros(m), set(range(m))
    while open_:
        own = fill_exactly({int(lengths[i]): capacity // int(lengths[i]) for i in open_}, capacity)
        column = np.zeros(m)
        for k, n in own.items():
            column[place[k]] = n
        rows = [place[k] for k in own]
        r = min(rows, key=lambda i: (left[i] / column[i], i))
        t = left[r] / column[r]
        left -= t * column
        basis[:, r], x[r] = column, t
        open_.remove(r)
    return basis, x


def inverted(a: np.ndarray) -> np.ndarray:
    """The inverse, by elimination with row pivots; a basis is sparse, so few rows change in a step."""
    n = len(a)
    m = np.concatenate([a.astype(np.float64), np.eye(n)], 1)
    for k in range(n):
        p = k + int(np.abs(m[k:, k]).argmax())
        if p != k:
            m[[k, p]] = m[[p, k]]
        m[k] /= m[k, k]
        other = m[:, k].copy()
        other[k] = 0
        rows = np.flatnonzero(other)
        m[rows] -= other[rows, None] * m[k]
    return m[:, n:].copy()


def relaxed(lengths: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-3, most_columns: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, times) of the linear program, by revised simplex with priced columns.

    It stops when Farley's bound, or the demand's total length, proves the bars within gap of the least possible, or
    when a hundred columns in a row save less than a tenth of that.
    """
    basis, x = greedy_basis(lengths, demand, capacity)
    inverse = inverted(basis)
    bound, before = float(lengths @ demand) / capacity, np.inf
    for turn in range(most_columns):
        if turn % 100 == 0:
            if before - x.sum() < gap / 10 * x.sum():
                break
            before = x.sum()
        if x.sum() <= bound * (1 + gap):
            break
        y = inverse.sum(0)  # all costs are 1
        value, column = knapsack(np.maximum(y, 0), lengths, capacity)
        bound = max(bound, x.sum() / max(value, 1.0))
        if value <= 1 + 1e-9:
            break
        d = inverse @ column
        up = d > 1e-10
        ratio = np.full(len(lengths), np.inf)
        ratio[up] = np.maximum(x[up], 0) / d[up]
        r = int(ratio.argmin())
        x = x - ratio[r] * d
        x[r] = ratio[r]
        basis[:, r] = column
        inverse[r] /= d[r]
        d[r] = 0
        inverse -= np.outer(d, inverse[r])
        if turn % 200 == 199:
            inverse = inverted(basis)
            x = np.maximum(inverse @ demand, 0)
    return np.rint(basis.T).astype(np.int64), np.maximum(x, 0)


def fill_exactly(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The largest length there is, and others that together come closest to the capacity."""
    first = max(counts)
    picked = {first: 1}
    room = capacity - first
    steps, reach = [], 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        n = counts[length] - (length == first)
        n = min(n, room // length)
        k = 1
        while n > 0:
            part = min(k, n)
            steps.append((length, part, reach))
            reach |= (reach << (length * part)) & ((1 << (room + 1)) - 1)
            n -= part
            k *= 2
    at = reach.bit_length() - 1
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            picked[length] = picked.get(length, 0) + part
            at -= length * part
    return picked


def plan(demand: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns (length to times) and how many bars follow each, together covering the demand.

    The linear program's patterns are taken as often as their whole part says; what is left, fewer
    pieces than a few for each length, is filled bar by bar as exactly as possible.
    """
    left = {k: n for k, n in demand.items() if n > 0}
    out: list[tuple[dict[int, int], int]] = []
    if full := left.pop(capacity, 0):
        out.append(({capacity: 1}, full))
    if left:
        lengths = np.array(sorted(left), np.int64)
        patterns, times = relaxed(lengths, np.array([left[k] for k in lengths.tolist()], np.float64), capacity)
        for pattern, t in sorted(zip(patterns.tolist(), times.tolist()), key=lambda z: -z[1]):
            own = {k: n for k, n in zip(lengths.tolist(), pattern) if n}
            t = min([int(t + 1e-7), *(left.get(k, 0) // n for k, n in own.items())])
            if t > 0:
                out.append((own, t))
                for k, n in own.items():
                    left[k] -= n * t
        left = {k: n for k, n in left.items() if n > 0}
    while left:
        own = fill_exactly(left, capacity)
        out.append((own, 1))
        for k, n in own.items():
            left[k] -= n
            if not left[k]:
                del left[k]
    return out
