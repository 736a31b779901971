"""MaxScore over one shard of integer vectors (no Spark here)."""

from __future__ import annotations

import numpy as np

_SEED_DIMS = 8
_GROUP = 8


def exact_type(width: int, most: int):
    """The number type in which sums of ``width`` products of integers up to ``most`` are exact: doubles, whose products the
    processor's own routines take, or else Python's integers."""
    return np.float64 if max(width, 1) * most * most < 1 << 52 else object


class Shard:
    """Vectors of one shard as postings by dimension, with the largest and smallest value of each."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.rows, self.n = ids, rows, len(x)
        self.lists = np.ascontiguousarray(x.T)  # one posting list a dimension
        self.low, self.high = (x.min(axis=0), x.max(axis=0)) if self.n else (np.zeros(x.shape[1]), np.zeros(x.shape[1]))

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, scores) of every vector but row ``own`` whose score reaches the shard's k-th best.

        A dimension's contribution lies between two bounds. The k best of a few heavy dimensions give a
        threshold that the true k-th best reaches. Dimensions are split by range: those at the end
        whose upper bounds, over the others' lower bounds, stay under the threshold are non-essential.
        Essential lists are traversed for all; the others are probed, a few at a time, only for
        vectors whose sum so far and bounds to come still compete.
        """
        if not self.n:
            return np.empty(0, int), np.empty(0, np.int64)
        a, b = q * self.low, q * self.high
        least, most = np.minimum(a, b), np.maximum(a, b)
        order = np.argsort(least - most, kind="stable")
        least, most, w = least[order], most[order], q[order]
        after = np.append(np.cumsum(most[::-1])[::-1], 0)  # [j]: upper bound of dimensions j and later
        before = np.append(0, np.cumsum(least))  # [j]: lower bound of dimensions before j
        dims = min(_SEED_DIMS, len(q))
        acc = w[:dims] @ self.lists[order[:dims]]
        mine = np.flatnonzero(self.rows == own)
        never = -np.inf if acc.dtype == np.float64 else -(1 << 200)
        acc[mine] = never
        pool = self.n - len(mine)
        if pool <= 0:
            return np.empty(0, int), np.empty(0, np.int64)
        threshold = never
        if pool > k:
            seeds = np.argpartition(-acc, k - 1)[:k]
            threshold = (w @ self.lists[np.ix_(order, seeds)]).min()
        split = len(q)
        while split > dims and after[split - 1] + before[split - 1] < threshold:
            split -= 1
        if split > dims:
            acc += w[dims:split] @ self.lists[order[dims:split]]
        alive = np.flatnonzero(acc + after[split] >= threshold)
        alive = alive[self.rows[alive] != own] if len(mine) else alive
        acc = acc[alive]
        for j in range(split, len(q), _GROUP):
            end = min(j + _GROUP, len(q))
            acc = acc + w[j:end] @ self.lists[np.ix_(order[j:end], alive)]
            still = acc + after[end] >= threshold
            alive, acc = alive[still], acc[still]
        return alive, acc


def best(ids: np.ndarray, known: np.ndarray, places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of ``places`` by score, then id, null ids last. Scores leave as longs, the nearest one beyond their range."""
    if scores.dtype == object:
        scores = np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in scores], np.int64)
    else:
        scores = scores.astype(np.int64)
    keep = np.lexsort((ids[places], ~known[places], ~scores))[:k]  # ~: as minus, for the least long too
    return places[keep], scores[keep]


def matrix(values: np.ndarray, lengths: np.ndarray, width: int) -> np.ndarray:
    """Rows of ``lengths`` from flat ``values``, padded with zeros to ``width``."""
    if (lengths == width).all():
        return values.reshape(-1, width)
    out, at = np.zeros((len(lengths), width), values.dtype), 0
    for r, n in enumerate(lengths.tolist()):
        out[r, :n] = values[at : at + n]
        at += n
    return out
