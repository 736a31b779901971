"""Vector codes against plain integer k-means and against SQL."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from sablefin.llm import code_kernel as kernel
from sablefin.llm import codes
from tests.oracle import assert_same

ROWS = "vec_id bigint, embedding array<float>, label int"


def plain_nearest(x, book):
    d = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book]
    return d.index(min(d)), min(d)


def plain(rows, parts=4, entries=256, rounds=4):
    """(code, error) by row, label sums and the digest, in Python integers."""
    kept = [(i, [math.floor(1024 * float(x)) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = max((len(v) for _, v, _ in kept), default=0)
    width = max(-(-width // parts) * parts, parts)
    kept = [(i, v + [0] * (width - len(v)), lab) for i, v, lab in kept]
    w = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[v[p * w : (p + 1) * w] for _, v, _ in first] for p in range(parts)]
    near = lambda: [[plain_nearest(v[p * w : (p + 1) * w], books[p]) for p in range(parts)] for _, v, _ in kept]
    for _ in range(rounds):
        got = near()
        for p in range(parts):
            for e in range(len(books[p])):
                mine = [v[p * w : (p + 1) * w] for (_, v, _), g in zip(kept, got, strict=True) if g[p][0] == e]
                if mine:
                    books[p][e] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    got, per = near(), {}
    for (_, _, lab), g in zip(kept, got, strict=True):
        per[lab] = per.get(lab, 0) + sum(d for _, d in g)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted((repr(i), "".join(f"{k:02x}" for k, _ in g), sum(d for _, d in g), per[lab], digest) for (i, _, lab), g in zip(kept, got, strict=True))


@pytest.mark.parametrize("most", [3, 1000, 1 << 20, 1 << 28, 1 << 40, (1 << 62) - 1])
def test_nearest(most):
    """All number types; small ranges make ties."""
    rng = np.random.default_rng(most)
    for n, k, w in ((1, 1, 1), (700, 90, 3), (1500, 256, 16), (5, 3, 0)):
        if most > 1 << 20:
            n = min(n, 60)
        x, book = rng.integers(-most, most, (n, w)), rng.integers(-most, most, (k, w))
        book[k // 2] = book[0]
        x[: n // 3] = 0
        index, square = kernel.Codebook(book).nearest(x)
        some = range(n) if n * k < 20_000 else range(0, n, 11)
        for r in some:
            assert (index[r], square[r]) == plain_nearest(x[r].tolist(), book.tolist())


def test_only_the_annulus_is_evaluated():
    rng = np.random.default_rng(1)
    ray = np.arange(1, 257)[:, None] * 1000 + rng.integers(-5, 5, (256, 8))
    b = kernel.Codebook(ray)
    b.nearest(ray[rng.integers(0, 256, 20_000)] + rng.integers(-3, 3, (20_000, 8)))
    assert b.evaluated < 0.4 * b.possible


def test_codes(spark):
    rng = random.Random(2)
    vec = lambda n: [rng.uniform(-0.5, 0.5) for _ in range(n)]
    same = vec(8)
    rows = [(k, [float(np.float32(x)) for x in vec(8)], rng.choice((0, 1, None))) for k in range(300)]
    rows += [(300, None, 1), (301, [None, *same[1:]], 1), (302, [float("nan"), *same[1:]], 1), (303, [float("inf"), *same[1:]], 1), (304, [], 0), (305, [1.0], 0), (None, [0.25] * 8, None), (7, [0.5] * 8, 2), (7, [0.5] * 8, 2)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, ROWS).select("*", *(F.lit("x").alias(c) for c in ("_keep", "_id", "_label", "_v", "codes", "error", "_l", "_sum", "part", "entry", "n", "s", "at", "x")))
    got = codes.encode(df).collect()
    assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == plain(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None)], [(1, [3e38] * 4, 1), (2, [-3e38] * 4, 1), (3, [1e6] * 4, 1)], [(1, [0.5] * 6, 1)], [(5, [], None), (6, [], None)]])
def test_few_rows(spark, rows):
    got = codes.encode(spark.createDataFrame(rows, ROWS)).collect()
    if any(x and abs(x) > 1e30 for _, v, _ in rows for x in v or ()):
        assert [r["error"] for r in got] == [0, 0, 0]
    else:
        assert sorted((repr(r["vec_id"]), r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got) == plain(rows)


def test_errors_beyond_a_long(spark):
    far = [(k, [3e38 * (-1) ** (k // 2)] * 4, None) for k in range(4)] + [(9, [0.0] * 4, None)]
    got = {r["vec_id"]: r for r in codes.encode(spark.createDataFrame(far, ROWS), entries=2).collect()}
    assert got[9]["error"] == codes.LONG and got[9]["label_error"] == codes.LONG


def test_query_against_sql(spark, sf):
    assert assert_same(codes.op12_codes(spark, sf), codes.ORACLE, sf) == 500
