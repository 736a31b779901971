"""String similarity kernels."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Names repeat: a worker keeps what it has compared, up to this many pairs.
KEPT = 500_000


@lru_cache(maxsize=KEPT)
def jaro_winkler(a: str, b: str, weight: float = 0.1) -> float:
    """Jaro similarity, raised by the common prefix (four letters at most) if it is above 0.7; 0 if either is
    empty."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    mine = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                mine.append(c)
                break
    m = len(mine)
    if not m:
        return 0.0
    theirs = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(mine, theirs, strict=True)) // 2
    jaro = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if jaro <= 0.7:
        return jaro
    prefix = 0
    for x, y in zip(a[:4], b[:4], strict=False):
        if x != y:
            break
        prefix += 1
    return jaro + prefix * weight * (1 - jaro)


class Letters:
    """Texts as letter numbers (0: none) of the first 64 letters, lengths, and first four letters in a word."""

    def __init__(self, size: np.ndarray, letters: np.ndarray, pad: int):
        self.size, self.short, self.letters = size, size <= 64, letters
        four = np.full((len(size), 4), pad, np.uint64)
        w = min(4, letters.shape[1])
        four[:, :w] = np.where(letters[:, :w] > 0, letters[:, :w], pad)
        self.four = (four[:, 0] << np.uint64(48)) | (four[:, 1] << np.uint64(32)) | (four[:, 2] << np.uint64(16)) | four[:, 3]
        self.inverse = (1 / np.maximum(size, 1)).astype(np.float32)

    def take(self, rows: np.ndarray) -> Letters:
        out = object.__new__(Letters)
        out.__dict__.update({k: v[rows] for k, v in self.__dict__.items()})
        return out

    def masks(self, n: int, longest: int) -> np.ndarray:
        """A word for each text and letter, whose bits are the letter's places; of 32 bits where neither side has a text longer than that."""
        word = np.uint32 if longest <= 32 else np.uint64
        out = np.zeros((len(self.size), n), word)
        for k in range(self.letters.shape[1]):
            out[np.arange(len(self.size)), self.letters[:, k]] |= word(1) << word(k)
        out[:, 0] = 0
        return out


def both_letters(a: list[str], b: list[str]) -> tuple[Letters, Letters, int]:
    """Two lists of texts in letter numbers of their own alphabet, and one more than the highest of these."""
    sides = []
    for texts in (a, b):
        if any("\0" in t for t in texts):  # numpy would take it for the end
            codes = np.zeros((len(texts), max(map(len, texts))), np.uint32)
            for k, t in enumerate(texts):
                codes[k, : len(t)] = [ord(c) + 1 for c in t]
        else:
            codes = _letters(texts)
            codes = np.where(codes > 0, codes + 1, 0)
        sides.append((np.array([len(t) for t in texts], np.int64), codes[:, :64]))
    seen = np.zeros(2 + max(int(c.max(initial=0)) for _, c in sides), bool)
    for _, codes in sides:
        seen[codes.ravel()] = True
    seen[0] = False
    number = np.where(seen, np.cumsum(seen), 0).astype(np.int32)
    x, y = (Letters(size, number[codes], pad) for (size, codes), pad in zip(sides, (65534, 65535), strict=True))
    return x, y, int(number.max(initial=0)) + 1


def _prefix(x: np.ndarray) -> np.ndarray:
    """Common first letters, four at most, from the difference of two words of four."""
    return (x < np.uint64(1 << 48)).astype(np.int8) + (x < np.uint64(1 << 32)) + (x < np.uint64(1 << 16)) + (x == 0)


def jaro_winkler_bits(a: Letters, b: Letters, masks: np.ndarray, i: np.ndarray, j: np.ndarray, least: np.ndarray | float = 0.0, weight: float = 0.1) -> np.ndarray:
    """``jaro_winkler`` of the pairs (i, j) of texts of at most 64 letters; ``masks`` are those of ``b``. Pairs that stay under ``least`` may get less than theirs.

    Windows, used and matched letters are bits of words; pairs are taken by falling length, so that a step has only those with a letter left.
    """
    word = masks.dtype.type
    order = np.argsort((-a.size[i]).astype(np.int16), kind="stable")  # a radix sort
    i, j = i[order], j[order]
    n, m = np.maximum(a.size[i], 1), np.maximum(b.size[j], 1)
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)
    one, wide, flat = word(1), masks.shape[1], masks.ravel()
    full = (reach + 1).astype(word)
    window = np.where(reach >= 8 * masks.itemsize - 1, ~word(0), (one << np.minimum(full, word(8 * masks.itemsize - 1))) - one)
    used, mine = np.zeros(len(i), word), np.zeros(len(i), word)
    letters, base, reach = a.letters[i].T.copy(), j * wide, reach.astype(np.int16)
    steps = int(n.max(initial=0)) if len(i) else 0
    upto = np.searchsorted(-n, -np.arange(steps), "left")  # pairs with a letter at place k
    for k in range(steps):
        e = upto[k]
        x = flat.take(base[:e] + letters[k, :e])
        x &= window[:e]
        x &= ~used[:e]
        x &= ~x + one
        used[:e] |= x
        mine[:e] |= (x != 0).astype(word) << word(k)
        window[:e] <<= one
        window[:e] |= k < reach[:e]
    matched = np.bitwise_count(used).astype(np.int64)
    prefix = _prefix(a.four[i] ^ b.four[j])

    def score(swaps) -> np.ndarray:
        jaro = (matched / n + matched / m + (matched - swaps) / np.maximum(matched, 1)) / 3
        return np.where(matched == 0, 0.0, np.where(jaro > 0.7, jaro + prefix * weight * (1 - jaro), jaro))

    bar = least[order] if isinstance(least, np.ndarray) else least
    alive = np.flatnonzero(score(0) >= bar - 1e-9)
    wrong, left, on_, base = np.zeros(len(alive), np.int64), used[alive], mine[alive], base[alive]
    letters, upto = letters[:, alive], np.searchsorted(-n[alive], -np.arange(steps), "left")
    for k in range(steps):
        e = upto[k]
        on = (on_[:e] >> word(k) & one) != 0
        low = np.where(on, left[:e] & (~left[:e] + one), word(0))
        wrong[:e] += on & (flat.take(base[:e] + letters[k, :e]) & low == 0)
        left[:e] ^= low
    swaps = np.zeros(len(i), np.int64)
    swaps[alive] = wrong // 2
    out = np.empty(len(i))
    out[order] = score(swaps)
    return out


def jaro_winkler_many(a: list[str], b: list[str], weight: float = 0.1, block: int = 8192) -> np.ndarray:
    """``jaro_winkler`` of many pairs at once: by bits, or for texts over 64 letters a step per letter place over whole columns of letters."""
    out = np.zeros(len(a))
    for k in range(0, len(a), block):
        out[k : k + block] = _jaro_winkler_some(a[k : k + block], b[k : k + block], weight)
    return out


def _distinct(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct texts and where each of ``texts`` is among them."""
    at: dict[str, int] = {}
    place = np.array([at.setdefault(t, len(at)) for t in texts], np.int64)
    return list(at), place


def _jaro_winkler_some(a: list[str], b: list[str], weight: float) -> np.ndarray:
    (x, i), (y, j) = _distinct(a), _distinct(b)
    left, right, letters = both_letters(x, y)
    short = left.short[i] & right.short[j]
    out = np.zeros(len(a))
    if short.any():
        masks = right.masks(letters, max(int(left.size[left.short].max()), int(right.size[right.short].max())))
        out[short] = jaro_winkler_bits(left, right, masks, i[short], j[short], weight=weight)
    if not short.all():
        long = np.flatnonzero(~short)
        out[long] = _jaro_winkler_block([a[k] for k in long], [b[k] for k in long], weight)
        for k in long:
            if "\0" in a[k] or "\0" in b[k]:  # no letter there
                out[k] = jaro_winkler(a[k], b[k], weight)
    return out


def _letters(texts: list[str]) -> np.ndarray:
    """Code points, a row a text, zeros behind its end."""
    flat = np.array(texts, dtype=str)
    return flat.view(np.uint32).reshape(len(texts), -1) if flat.dtype.itemsize else np.zeros((len(texts), 1), np.uint32)


def _jaro_winkler_block(a: list[str], b: list[str], weight: float) -> np.ndarray:
    x, y = _letters(a), _letters(b)
    n, m = np.array([len(t) for t in a]), np.array([len(t) for t in b])
    reach = np.maximum(np.maximum(n, m) // 2 - 1, 0)[:, None]
    row, place = np.arange(len(a)), np.arange(y.shape[1])
    used, hit = np.zeros(y.shape, bool), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        c = x[:, i : i + 1]
        ok = (y == c) & (c != 0) & ~used & (np.abs(place - i) <= reach)
        first = ok.argmax(axis=1)
        got = ok[row, first]
        used[row[got], first[got]] = True
        hit[:, i] = got
    matched = hit.sum(axis=1)
    width = min(x.shape[1], y.shape[1])
    mine = np.take_along_axis(x, np.argsort(~hit, axis=1, kind="stable"), 1)[:, :width]
    theirs = np.take_along_axis(y, np.argsort(~used, axis=1, kind="stable"), 1)[:, :width]
    swaps = ((mine != theirs) & (np.arange(width) < matched[:, None])).sum(axis=1) // 2
    some = np.maximum(matched, 1)
    jaro = (matched / np.maximum(n, 1) + matched / np.maximum(m, 1) + (matched - swaps) / some) / 3
    four = min(4, width)
    prefix = np.cumprod((x[:, :four] == y[:, :four]) & (x[:, :four] != 0), axis=1).sum(axis=1)
    score = np.where(jaro > 0.7, jaro + prefix * weight * (1 - jaro), jaro)
    same = np.array([s == t and s != "" for s, t in zip(a, b, strict=True)])
    return np.where(same, 1.0, np.where(matched == 0, 0.0, score))


def indel(a: str, b: str) -> int:
    """Insertions and deletions between two strings: lengths minus twice the longest common subsequence."""
    if not a or not b:
        return len(a) + len(b)
    # bit-parallel longest common subsequence (Hyyro 2004)
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = (s + u | s - u) & full
    return len(a) + len(b) - 2 * (len(a) - s.bit_count())


def indel_many(a: list[str], b: list[str], block: int = 8192) -> np.ndarray:
    """``indel`` of many pairs at once; texts over 64 letters one by one."""
    out = np.zeros(len(a), np.int64)
    for at in range(0, len(a), block):
        some, other = a[at : at + block], b[at : at + block]
        (x, i), (y, j) = _distinct(some), _distinct(other)
        left, right, letters = both_letters(x, y)
        short = left.short[i] & right.short[j]
        got = np.zeros(len(some), np.int64)
        if short.any():
            masks = left.masks(letters, 64)
            p, r = i[short], j[short]
            s, base, flat, rows = np.full(len(p), ~np.uint64(0)), p * masks.shape[1], masks.ravel(), right.letters[r]
            for k in range(int(right.size[r].max())):
                # the letters behind a text's end have no places, so nothing changes there
                u = s & flat.take(base + rows[:, k])
                s = (s + u) | (s - u)
            got[short] = left.size[p] + right.size[r] - 2 * np.bitwise_count(~s).astype(np.int64)
        for k in np.flatnonzero(~short):
            got[k] = indel(some[k], other[k])
        out[at : at + block] = got
    return out


def token_set_many(a: list[str], b: list[str]) -> np.ndarray:
    """``token_set`` of many pairs at once."""
    words = {t: (w := frozenset(t.split()), " ".join(sorted(w))) for t in {*a, *b}}
    out, at, rests, shares = np.zeros(len(a)), [], ([], []), []
    for k, (s, t) in enumerate(zip(a, b, strict=True)):
        (left, x), (right, y) = words[s], words[t]
        if not left or not right:
            continue
        both = left & right
        if both:
            if left <= right or right <= left:
                out[k] = 1.0
                continue
            x, y = " ".join(sorted(left - right)), " ".join(sorted(right - left))
        at.append(k)
        rests[0].append(x)
        rests[1].append(y)
        shares.append(len(" ".join(sorted(both))) if both else -1)
    if at:
        s, gap = np.maximum(shares, 0), (np.array(shares) >= 0).astype(np.int64)
        n, m = (np.array([len(t) for t in side]) for side in rests)
        rest = 1 - indel_many(*rests) / (2 * (s + gap) + n + m)
        one, other = (1 - (gap + c) / np.maximum(2 * s + gap + c, 1) for c in (n, m))
        out[at] = np.where(gap == 1, np.maximum(rest, np.maximum(one, other)), rest)
    return out


@lru_cache(maxsize=KEPT)
def token_set(a: str, b: str) -> float:
    """Token-set ratio in [0, 1]: best of the shared words against each side and the two rests."""
    left, right = set(a.split()), set(b.split())
    if not left or not right:
        return 0.0
    both = left & right
    if both and (left <= right or right <= left):
        return 1.0
    s = len(" ".join(sorted(both)))
    x, y = " ".join(sorted(left - right)), " ".join(sorted(right - left))
    gap = 1 if both else 0
    whole = 2 * (s + gap) + len(x) + len(y)
    rests = 1 - indel(x, y) / whole
    if not both:
        return rests
    side = lambda n: 1 - (gap + n) / (2 * s + gap + n)
    return max(rests, side(len(x)), side(len(y)))
