"""Dense numbers and the k-th row against plain sorting."""

from __future__ import annotations

import datetime
import random

import pytest
from pyspark.sql import functions as F

from sablefin.operators import ordering


def rows_of(rng, n):
    when = datetime.datetime(2024, 1, 1)
    out = []
    for _ in range(n):
        out.append((
            rng.choice([None, 0.0, -0.5, 1e-300, 1e300, float("inf"), rng.random(), rng.gauss(0, 1e6), 2.5, 2.5]), rng.choice([None, 0, -(1 << 63), (1 << 63) - 1, rng.getrandbits(60), 5, 5]),
            rng.choice([None, "", "a", "a\0", "aaaaaaaaaaaab", "aaaaaaaaaaaac", "é", "zz" * 9, str(rng.random())]), rng.random() < 0.5, when + datetime.timedelta(seconds=rng.randrange(10**6)),
        ))
    return out


SCHEMA = "x double, n bigint, s string, f boolean, t timestamp"
ORDERS = [[("x", True), ("n", False), ("s", False)], [("s", False), ("x", False)], [("s", True), ("n", True)], [("n", False), ("t", True)], [("f", True), ("s", False), ("t", False)], [("t", False)]]


@pytest.mark.parametrize("order", ORDERS, ids=str)
def test_kth(spark, order):
    rng = random.Random(3)
    df = spark.createDataFrame(rows_of(rng, 400), SCHEMA)
    sort = [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in order]
    want = df.orderBy(*sort).collect()
    for k, few in ((1, 30), (57, 1), (230, 30), (400, 1)):
        last = ordering.kth(df, order, k, few)
        assert all(repr(last[c]) == repr(want[k - 1][c]) for c, _ in order), (k, few)
        held = df.where(ordering.upto(order, last)).count()
        assert held == max(i for i, r in enumerate(want, 1) if all(repr(r[c]) == repr(last[c]) for c, _ in order))
    assert ordering.kth(df, order, 401) is None and ordering.kth(df, order, 0) is None


def test_numbered(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, 1, 2, 3]), f"k{rng.randrange(50)}", k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b string, c int").repartition(7)
    got = ordering.numbered(df, ["a", F.desc("b"), "c"], "nth", start=5)
    assert got.columns == ["a", "b", "c", "nth"]
    want = [tuple(r) for r in df.orderBy("a", F.desc("b"), "c").collect()]
    assert [tuple(r) for r in got.orderBy("nth").collect()] == [(*r, k) for k, r in enumerate(want, 5)]
    assert ordering.numbered(df.where("c < 0"), ["a"]).count() == 0


def test_numbers_need_no_python_workers(spark, capsys):
    """The ranges' first numbers come from the plan: no rows of Python objects, which every executor would start workers for."""
    df = ordering.numbered(spark.range(50), ["id"])
    df.explain()
    plan = capsys.readouterr().out
    assert "LocalTableScan" in plan and "ExistingRDD" not in plan
    assert [(r["id"], r["n"]) for r in df.orderBy("id").collect()] == [(k, k) for k in range(50)]
