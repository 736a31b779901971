from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from sablefin.operators.quantile import exact_quantiles


@pytest.mark.parametrize("q", [0.0, 0.25, 0.5, 0.75, 1.0])
def test_equals_the_gathered_quantile(spark, q):
    rng = np.random.default_rng(3)
    rows = [(g, float(v)) for g, n in (("a", 30_001), ("b", 2), ("c", 1), (None, 500)) for v in rng.normal(size=n)]
    rows += [("tie", float(k % 3)) for k in range(40_000)] + [("a", None), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r["g"]: r["q_v"] for r in exact_quantiles(df, ["g"], ["v"], q).collect()}
    want = {r["g"]: r["p"] for r in df.groupBy("g").agg(F.percentile("v", q).alias("p")).collect()}
    assert set(got) == set(want)
    assert all((got[g] is None) == (want[g] is None) and (got[g] is None or got[g] == pytest.approx(want[g], abs=1e-12)) for g in want)
    assert exact_quantiles(df, [], ["v"], q).first()[0] == pytest.approx(df.agg(F.percentile("v", q)).first()[0], abs=1e-12)
    assert exact_quantiles(df.limit(0), [], ["v"], q).first()[0] is None
