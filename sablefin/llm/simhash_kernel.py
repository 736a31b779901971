"""Byte-level kernels of the SimHash near-duplicate operator (no Spark here)."""

from __future__ import annotations

import numpy as np
import xxhash

_CHUNK = 1 << 15


def shingle_hashes(text: bytes, width: int, seed: int) -> np.ndarray:
    """XXH64 of every ``width``-word shingle of ``text``, repeats included.

    ``bytes.lower`` folds A-Z only and ``bytes.split`` cuts at \\x20 and \\x09-\\x0D,
    which is exactly the word definition ``[^\\x20\\x09-\\x0D]+``.
    """
    words = text.lower().split()
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if n <= width:
        return np.array([digest(b" ".join(words), seed)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.empty(n, np.int64)
    starts[0] = 0
    starts[1:] = ends[:-1] + 1
    spans = zip(starts[: n - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n - width + 1)


def majority(hashes: np.ndarray) -> int:
    """The 64-bit word whose bit is 1 where over half of ``hashes`` have it set."""
    n = len(hashes)
    if n == 0:
        return 0
    ones = np.zeros(64, np.int64)
    for k in range(0, n, _CHUNK):  # 64 bytes a shingle: bounded however long the text is
        part = np.ascontiguousarray(hashes[k : k + _CHUNK], dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: bytes | None, width: int, seed: int) -> int:
    return majority(shingle_hashes(text or b"", width, seed))


def linked_pairs(fps: np.ndarray, max_bits: int, min_bytes: int, block: int = 2048):
    """Yield (i, j) index arrays, i < j, of fingerprints within ``max_bits`` bits.

    Blockwise: the positional bytes two fingerprints share are tallied first, pairs under
    ``min_bytes`` fall away, the rest are verified bit by bit.
    """
    n = len(fps)
    for a in range(0, n, block):
        for b in range(a, n, block):
            x = fps[a : a + block, None] ^ fps[None, b : b + block]
            shared = (np.ascontiguousarray(x).view(np.uint8).reshape(*x.shape, 8) == 0).sum(axis=2)
            i, j = np.nonzero(shared >= min_bytes)
            near = np.bitwise_count(x[i, j]) <= max_bits
            i, j = i[near] + a, j[near] + b
            keep = i < j
            yield i[keep], j[keep]
