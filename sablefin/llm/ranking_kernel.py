"""Features and fitting of the pairwise quality ranker (no Spark here)."""

from __future__ import annotations

import numpy as np

FEATURES = (
    "log_words", "word_length", "symbols", "upper", "digits", "exclaim", "stops", "commas", "bars", "other_ascii", "non_ascii", "lines_per_word",
    "distinct_words", "repeated_5grams", "duplicate_lines", "capital_words", "ends_in_mark", "longest_word", "byte_entropy", "top_word",
)


def _mask(chars: bytes) -> np.ndarray:
    m = np.zeros(256, bool)
    m[list(chars)] = True
    return m


_SYMBOLS = _mask(b"#*$%&<>")
_UPPER = _mask(bytes(range(65, 91)))
_DIGITS = _mask(b"0123456789")
_HIGH = np.arange(256) >= 128
_BLANK = _mask(b" \t\n\x0b\x0c\r")
_OTHER = _mask(bytes(range(33, 127))) & ~_SYMBOLS & ~_DIGITS & ~_mask(bytes(range(65, 91)) + bytes(range(97, 123)) + b"!.,|")


def _repeated(code: np.ndarray, distinct: int, width: int = 5) -> int:
    """Windows of ``width`` of the numbers ``code``, below ``distinct``, that equal an earlier window. Exact: a
    window is one integer, renumbered before it would overflow."""
    grams = len(code) - width + 1
    if grams < 2:
        return 0
    window, bound = code[:grams], distinct
    for k in range(1, width):
        if bound * distinct >= 1 << 62:
            window, bound = np.unique(window, return_inverse=True)[1], grams
        window, bound = window * distinct + code[k : k + grams], bound * distinct
    return grams - len(np.unique(window))


def features(text: bytes) -> np.ndarray:
    """The measures of one whole text, in the order of FEATURES; a text without words has zeros."""
    words = text.split()
    n = len(words)
    if not n:
        return np.zeros(len(FEATURES))
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    solid = int(hist[~_BLANK].sum())
    share = lambda m: float(hist[m].sum()) / solid
    number: dict[bytes, int] = {}
    code = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)  # each word's number
    distinct, top = len(number), int(np.bincount(code).max())
    repeats = _repeated(code, distinct)
    lines = [x for x in text.split(b"\n") if x.strip()]
    p = hist[hist > 0] / hist.sum()
    return np.array([
        np.log1p(n), solid / n, share(_SYMBOLS), share(_UPPER), share(_DIGITS), float(hist[33]) / n, float(hist[46]) / n, float(hist[44]) / n, float(hist[124]) / n,
        share(_OTHER), share(_HIGH), np.log1p(len(lines)) - np.log1p(n), distinct / n, repeats / n, 1 - len(set(lines)) / max(len(lines), 1),
        sum(w.isupper() for w in words) / n, sum(w[-1] in b"!?;:#*$%&|" for w in words) / n, np.log1p(max(map(len, words))), float(-(p * np.log2(p)).sum()), top / n,
    ])


def scale(x: np.ndarray, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / spread, -6, 6)


def moments(x: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, means and sums of squared differences from them."""
    mean = x.mean(0)
    return len(x), mean, ((x - mean) ** 2).sum(0)


def joined(a: tuple, b: tuple) -> tuple[int, np.ndarray, np.ndarray]:
    """The ``moments`` of both."""
    n, gap = a[0] + b[0], b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + gap**2 * (a[0] * b[0] / n)


def cell_width(w: np.ndarray) -> float:
    """Width of score cells: a 64th, or more where scores can be so far apart that they would take over 4,096 cells."""
    return max(1 / 64, 12 * float(np.abs(w).sum()) / 4096)


def cell_sums(x: np.ndarray, y: np.ndarray, w: np.ndarray, width: float) -> dict[int, np.ndarray]:
    """For each cell of scores x . w and label y (key: twice the cell plus y): rows, sum of x, sum of x x'."""
    key = np.floor((x @ w) / width).astype(np.int64) * 2 + y
    order = np.argsort(key, kind="stable")
    x, key = x[order], key[order]
    ends = [*(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
    upper = np.triu_indices(x.shape[1])
    out, at = {}, 0
    for end in ends:
        part = x[at:end]
        out[int(key[at])] = np.concatenate([[end - at], part.sum(0), (part.T @ part)[upper]])
        at = end
    return out


def newton_step(sums: dict[int, np.ndarray], w: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """What Newton's method takes off Bradley-Terry weights ``w``, over every pair of a good and a bad row.

    P(good beats bad) = sigmoid(w . (good - bad)). Rows enter by their ``cell_sums``; in a cell a pair's chance runs
    with the score to the second order, so the gradient is off by the third power of the cell's width.
    """
    k = len(w)
    upper = np.triu_indices(k)

    def side(label: int):
        v = np.array([sums[c] for c in sorted(sums) if c % 2 == label])
        square = np.zeros((len(v), k, k))
        square[:, upper[0], upper[1]] = square[:, upper[1], upper[0]] = v[:, 1 + k :]
        n, x = v[:, 0], v[:, 1 : 1 + k]
        along = square @ w  # sum of score times x
        s = x @ w / n
        return n, x, square, s, along - s[:, None] * x, np.maximum(along @ w / n - s**2, 0)

    n, x, xx, s, dx, var = side(1)
    m, y, yy, t, dy, war = side(0)
    p = 1 / (1 + np.exp(np.clip(s[:, None] - t, -30, 30)))  # chance that the pair is ranked wrongly
    q = p * (1 - p)
    bend = q * (1 - 2 * p) / 2
    good = (p + bend * war) @ m + (bend @ m) * var
    bad = n @ (p + bend * var[:, None]) + (n @ bend) * war
    up, down = q @ m, n @ q
    pairs = n.sum() * m.sum()
    grad = (bad @ y + down @ dy - good @ x + up @ dx) / pairs + ridge * w
    cross = x.T @ q @ y
    hess = (np.tensordot(up, xx, 1) + np.tensordot(down, yy, 1) - cross - cross.T) / pairs + ridge * np.eye(k)
    return np.linalg.solve(hess, grad)


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int, seed: int, ridge: float = 1e-3, steps: int = 25) -> np.ndarray:
    """Bradley-Terry weights of a small table by Newton's method over ``pairs`` drawn preference pairs: a plain
    counterpart of ``newton_step``, not used by the operator."""
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return w
    d = x[rng.choice(good, pairs)] - x[rng.choice(bad, pairs)]
    for _ in range(steps):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))  # chance that the pair is ranked wrongly
        grad = -(d * p[:, None]).mean(0) + ridge * w
        hess = (d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def cut(scores: np.ndarray, y: np.ndarray, grid: int = 200) -> float:
    """The score quantile of a small table, of ``grid`` ones, at which accepting what lies at or above it is right
    most often in the mean of both labels: a plain counterpart of the operator's, which takes it over all rows."""
    if not len(scores) or len(set(y.tolist())) < 2:
        return float(scores.min(initial=0.0))
    best = (-1.0, 0.0)
    for q in np.unique(np.quantile(scores, np.arange(grid) / grid)):
        said = scores >= q
        right = (said[y == 1].mean() + (~said)[y == 0].mean()) / 2
        best = max(best, (float(right), float(q)), key=lambda t: t[0])
    return best[1]
