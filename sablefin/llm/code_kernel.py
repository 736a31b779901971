"""Nearest codebook entry by annular norm pruning, in exact integers (no Spark here).

By the triangle inequality an entry closer to a point than d has a norm within d of the point's. Entries
are sorted by norm; the interval that the best distance so far allows is found by binary search, its ends
included, and only entries inside are evaluated. Points are taken in blocks of like norm, so a block shares an
interval (the union of its points') and is evaluated by one matrix product; as distances fall,
the interval is searched anew and shrinks.
"""

from __future__ import annotations

import numpy as np

#: Points that share an interval, and entries evaluated between two searches of it.
BLOCK = 512
SLICE = 32
#: Relative slack of an interval: norms and distances are rounded to doubles, entries at its very ends count.
SLACK = 1e-9


def _kind(points: np.ndarray, entries: np.ndarray):
    """The narrowest number type in which distance * entries + index is exact."""
    most = max((int(np.abs(x).max()) if x.size else 0) for x in (points, entries))
    bound = 4 * max(points.shape[1], 1) * most * most * 2 * (len(entries) + 1)
    return np.float64 if bound < 1 << 52 else np.int64 if bound < 1 << 62 else object


class Codebook:
    """``entries``: an integer row each; ties between entries go to the lower index."""

    def __init__(self, entries: np.ndarray) -> None:
        self.entries = entries
        exact = entries.astype(object)
        self.squares = (exact * exact).sum(axis=1) if exact.size else np.zeros(len(entries), object)
        norms = np.sqrt(self.squares.astype(float))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        #: (point, entry) pairs evaluated and possible so far.
        self.evaluated = self.possible = 0

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each integer row of ``points``."""
        kind, k = _kind(points, self.entries), len(self.entries)
        x = points.astype(kind)
        own = (x * x).sum(axis=1) if x.shape[1] else np.zeros(len(x), kind)
        sorted_ = self.entries[self.order].astype(kind)
        # distance * k + index - (own square) * k, by one product: -2k x.c + (k |c|^2 + index)
        scaled, fixed = sorted_.T * (-2 * k), self.squares[self.order].astype(kind) * k + self.order.astype(kind)
        norm = np.sqrt(own.astype(float))
        index, square = np.empty(len(x), np.int64), np.empty(len(x), object if kind is object else np.int64)
        by_norm = np.argsort(norm, kind="stable")
        self.possible += len(x) * k
        for a in range(0, len(x), BLOCK):
            rows = by_norm[a : a + BLOCK]
            key = self._block(x[rows], norm[rows], own[rows] * k, scaled, fixed) + own[rows] * k
            if kind is np.float64:
                key = key.astype(np.int64)
            index[rows], square[rows] = key % k, key // k
        return index, square

    def _block(self, x, norm, lift, scaled, fixed):
        """The least key of each point of a block; evaluates outwards from the entries of the block's own norms."""
        k = len(self.norms)
        lo = min(int(np.searchsorted(self.norms, norm[len(norm) // 2])), k - 1)
        lo = max(lo - SLICE // 2, 0)
        hi = min(lo + SLICE, k)
        best = self._evaluate(x, scaled, fixed, lo, hi)
        while True:
            far = np.sqrt(np.maximum((best + lift).astype(float) / k, 0.0))
            slack = SLACK * (norm + far + 1.0)
            first = int(np.searchsorted(self.norms, (norm - far - slack).min(), "left"))
            last = int(np.searchsorted(self.norms, (norm + far + slack).max(), "right"))
            if first >= lo and last <= hi:
                return best
            left, right = (max(first, lo - SLICE), lo), (hi, min(last, hi + SLICE))
            for a, b in (left, right):
                if a < b:
                    best = np.minimum(best, self._evaluate(x, scaled, fixed, a, b))
            lo, hi = min(lo, left[0]), max(hi, right[1])

    def _evaluate(self, x, scaled, fixed, a: int, b: int):
        self.evaluated += len(x) * (b - a)
        return (x @ scaled[:, a:b] + fixed[a:b]).min(axis=1)


def sums(points: np.ndarray, index: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(count, componentwise sum) of the points of each entry, exact."""
    count = np.bincount(index, minlength=k)
    # within 2^62 / rows a long holds any sum
    wide = points.size and int(np.abs(points).max()) > (1 << 62) // max(len(points), 1)
    total = np.zeros((k, points.shape[1]), object if wide else np.int64)
    np.add.at(total, index, points.astype(total.dtype))
    return count, total
