"""Shingle sets, banded minima and exact similarity tests of near copies (no Spark here)."""

from __future__ import annotations

import numpy as np
import xxhash

from sablefin.llm.simhash_kernel import shingle_hashes

#: Least Jaccard similarity of near copies, as a fraction: SHARE / WHOLE = 0.8.
SHARE, WHOLE = 4, 5
#: A pair meets if the four minima of one of 32 bands agree: at 0.8 it fails to with (1 - 0.8^4)^32 = 5e-8.
BANDS, ROWS = 32, 4
_CHUNK = 2048
_rng = np.random.default_rng(20)
_XOR = _rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32)
_MUL = _rng.integers(0, 1 << 32, (BANDS * ROWS, 1), dtype=np.uint32) | np.uint32(1)


def identity(text: bytes | None, seed: int) -> int:
    """XXH64 of the text's words, signed: what exact copies share."""
    h = xxhash.xxh64_intdigest(b" ".join((text or b"").lower().split()), seed)
    return h - (1 << 64) if h >> 63 else h


def shingle_set(text: bytes | None, width: int, seed: int) -> np.ndarray:
    """Distinct shingle hashes, sorted."""
    return np.unique(shingle_hashes(text or b"", width, seed))


def bands(some: np.ndarray) -> list[int]:
    """A signed key for each band of minima of a set (empty set: none)."""
    if not len(some):
        return []
    short, low = (some >> np.uint64(32)).astype(np.uint32), np.full(BANDS * ROWS, (1 << 32) - 1, np.uint32)
    for k in range(0, len(short), _CHUNK):  # bounded however long the text is
        x = short[k : k + _CHUNK] ^ _XOR
        x *= _MUL
        np.minimum(low, x.min(axis=1), out=low)
    b, step = low.tobytes(), 4 * ROWS
    keys = [xxhash.xxh64_intdigest(b[k * step : (k + 1) * step], k) for k in range(BANDS)]
    return [h - (1 << 64) if h >> 63 else h for h in keys]


def similar(shared, n, m):
    """Whether sets of ``n`` and ``m`` that share ``shared`` have the least similarity: exact, in integers."""
    return shared * (SHARE + WHOLE) >= SHARE * (n + m)


def near(a: bytes, b: bytes) -> bool:
    """The test of two sets, given as bytes of sorted hashes."""
    x, y = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
    if not similar(min(len(x), len(y)), len(x), len(y)):
        return False
    return bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y)))


def bridges(label: np.ndarray, sets: list[bytes]) -> list[tuple[int, int]]:
    """Similar pairs of members that join all labels that similar members of one list have.

    Exact: each member outside the commonest label is compared with all of other labels.
    """
    parts = [np.frombuffer(s, "<u8") for s in sets]
    n = np.array([len(p) for p in parts])
    at = np.cumsum(n) - n
    kinds, place = np.unique(np.concatenate(parts), return_inverse=True)
    names, label = np.unique(label, return_inverse=True)
    most, out = int(np.bincount(label).argmax()), []
    mark = np.zeros(len(kinds), bool)
    for x in np.flatnonzero(label != most).tolist():
        unlike = (label != label[x]) & similar(np.minimum(n, n[x]), n, n[x])
        if not unlike.any():
            continue
        own = place[at[x] : at[x] + n[x]]
        mark[own] = True
        shared = np.add.reduceat(mark[place], at, dtype=np.int64)
        mark[own] = False
        for y in np.flatnonzero(unlike & similar(shared, n, n[x])).tolist():
            if label[y] != label[x]:
                out.append((x, y))
                label[label == label[y]] = label[x]
    return out
