"""The names most like each of many others, exactly, without comparing every pair letter by letter.

A pair's Jaro-Winkler similarity can't exceed what its matched letters and its common prefix allow. Matched letters are counted
for all pairs: a name against the whole other side at once, a step a letter, over words whose bits are a letter's places. A name's list
is begun with those of the highest bounds, which are mostly its own members, so that few others may still enter it; only these
are compared for transpositions.
"""

from __future__ import annotations

import numpy as np

from sablefin.functions.similarity import Letters, both_letters, jaro_winkler_bits, jaro_winkler_many

#: Letters of a name that fit the bits of a word; pairs with longer names are compared by columns of letters.
BITS = 64
#: Pairs whose bounds are held at a time, and pairs compared at a time.
_CELLS, _PAIRS = 1 << 20, 1 << 15
_SLACK = np.float32(1e-5)


def _windows(n: int, sizes: np.ndarray, word: type) -> np.ndarray:
    """For each place of a name of ``n`` letters and each name of ``sizes``: bits of the places whose letters may match."""
    last = 8 * word().itemsize - 1
    of = np.zeros((n, int(sizes.max(initial=0)) + 1), word)
    for m in np.unique(sizes).tolist():
        reach = max(max(n, m) // 2 - 1, 0)
        for k in range(n):
            of[k, m] = (1 << min(k + reach, last) + 1) - (1 << max(0, k - reach))
    return of[:, sizes]


def _ranges(q: Letters, r: Letters) -> list[tuple[np.ndarray, np.ndarray]]:
    """For one to four common first letters: where in ``r``, sorted by its first four letters, those begin and end that share them."""
    out = []
    for letters in range(1, 5):
        shift = np.uint64(16 * (4 - letters))
        a, b = q.four >> shift, r.four >> shift
        out.append((np.searchsorted(b, a, "left"), np.searchsorted(b, a, "right")))
    return out


def nearest(queries: list[str], refs: list[str], floor: float, most: int, digits: int, weight: float = 0.1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, ref, similarity): for each query its ``most`` refs of at least ``floor`` (above 0), ties at ``digits`` digits to the earlier ref."""
    none = np.array([], np.int64), np.array([], np.int64), np.array([])
    if not queries or not refs:
        return none
    q, r, letters = both_letters(queries, refs)
    # names of one beginning stand together; ``place`` is where they came from
    place = np.argsort(r.four, kind="stable")
    r = r.take(place)
    ranges, masks = _ranges(q, r), r.masks(letters, max(int(q.size.max()), int(r.size.max())))
    places, word = np.ascontiguousarray(masks.T), masks.dtype.type
    lasting, sizes = np.flatnonzero(~r.short), np.minimum(r.size, BITS)
    # names of one length see the same windows
    turn = np.argsort(q.size, kind="stable")
    windows, length = None, -1
    free, x, y = (np.empty(len(refs), word) for _ in range(3))
    step, seeds = max(1, _CELLS // len(refs)), min(len(refs), 4 * most)
    out = []

    def compared(x: np.ndarray, y: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = []
        for c in range(0, len(x), _PAIRS):
            i, j = x[c : c + _PAIRS], y[c : c + _PAIRS]
            short = q.short[i] & r.short[j]
            got = np.zeros(len(i))
            if short.any():
                got[short] = jaro_winkler_bits(q, r, masks, i[short], j[short], least[i[short]], weight)
            if not short.all():
                got[~short] = jaro_winkler_many([queries[k] for k in i[~short]], [refs[k] for k in place[j[~short]]], weight)
            # a tie with the last of the list may come before it
            ok = got >= np.where(least[i] > floor, least[i] - 2 * 10.0**-digits, floor)
            found.append((i[ok], j[ok], got[ok]))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else none

    def first(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The lists so far, and each row's place in its list."""
        x, y, got = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((place[y], -np.round(got, digits), x))
        x, y, got = x[order], y[order], got[order]
        nth = np.arange(len(x)) - np.searchsorted(x, x)
        keep = nth < most
        return x[keep], y[keep], got[keep], nth[keep]

    least = np.full(len(queries), floor)
    for a in range(0, len(queries), step):
        rows = turn[a : a + step]
        bound = np.empty((len(rows), len(refs)), np.float32)
        for row, k in zip(bound, rows.tolist(), strict=True):
            if not q.short[k]:
                row[:] = 0
                continue
            if length != q.size[k]:
                length = int(q.size[k])
                windows = _windows(length, sizes, word)
            free[:] = ~word(0)
            for w, letter in zip(windows, q.letters[k].tolist(), strict=False):
                # the first free place of the letter
                np.bitwise_and(places[letter], w, out=x)
                np.bitwise_and(x, free, out=x)
                np.negative(x, out=y)
                np.bitwise_and(x, y, out=x)
                np.bitwise_xor(free, x, out=free)
            # what is missing to 1, times three: two less the shares of matched letters, and a tenth less for each letter of the prefix
            np.add(r.inverse, q.inverse[k], out=row)
            np.invert(free, out=free)
            row *= np.bitwise_count(free)
            np.subtract(np.float32(2), row, out=row)
            for same, (lo, hi) in enumerate(ranges, 1):
                # times (1 - w n) / (1 - w (n - 1)) a step
                row[lo[k] : hi[k]] *= np.float32((1 - weight * same) / (1 - weight * (same - 1)))
            row[lasting] = 0
        seed = np.argpartition(bound, seeds - 1, axis=1)[:, :seeds] if seeds < len(refs) else np.broadcast_to(np.arange(len(refs)), bound.shape)
        held = first([compared(np.repeat(rows, seeds), seed.ravel().astype(np.int64), least)])
        if seeds < len(refs):
            np.put_along_axis(bound, seed, np.float32(np.inf), axis=1)
            full = held[3] == most - 1
            least[held[0][full]] = np.maximum(floor, held[2][full])
            i, j = np.nonzero(bound <= (3 * (1 - least[rows])).astype(np.float32)[:, None] + _SLACK)
            if len(i):
                held = first([held[:3], compared(rows[i], j, least)])
        out.append((held[0], place[held[1]], held[2]))
    i, j, got = (np.concatenate(c) for c in zip(*out, strict=True))
    order = np.argsort(i, kind="stable")
    return i[order], j[order], got[order]
