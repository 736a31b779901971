"""Rank metrics against plain versions; feature, split and label semantics."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sablefin.operators import evaluate as ev, features as ft, models


def scored(spark, n=400, seed=1, ties=20):
    rng = random.Random(seed)
    rows = [(k, float(rng.randrange(ties)), rng.random() < 0.2) for k in range(n)]
    return spark.createDataFrame(rows, "id long, score double, y boolean"), rows


def plain_auc(rows):
    pos, neg = [s for _, s, y in rows if y], [s for _, s, y in rows if not y]
    return sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))


def plain_ap(rows):
    out = seen = hits = 0
    for s in sorted({s for _, s, _ in rows}, reverse=True):
        tp = sum(y for _, x, y in rows if x == s)
        seen, hits = seen + sum(x == s for _, x, _ in rows), hits + tp
        out += tp * hits / seen
    return out / sum(y for _, _, y in rows)


@pytest.mark.parametrize("ties", [1, 3, 1000])
def test_auc_and_average_precision(spark, ties):
    df, rows = scored(spark, ties=ties)
    assert ev.roc_auc(df).first()[0] == pytest.approx(plain_auc(rows))
    assert ev.average_precision(df).first()[0] == pytest.approx(plain_ap(rows))


def test_metrics_without_a_class_or_rows(spark):
    df, _ = scored(spark)
    assert ev.roc_auc(df.where("y")).first()[0] is None
    assert ev.roc_auc(df.limit(0)).first()[0] is None
    with pytest.raises(ValueError, match="positives"):
        ev.at_recall(df.where("not y"), 0.8, ["id"])


def test_operating_points(spark):
    rows = [(k, 1.0 - k / 100, k % 10 == 0) for k in range(100)]
    df = spark.createDataFrame(rows, "id long, score double, y boolean")
    r = ev.at_recall(df, 0.8, ["id"]).first()
    assert (r["alert_volume"], r["true_positives"], r["threshold"]) == (71, 8, pytest.approx(0.3))
    b = ev.at_budget(df, 0.125, ["id"]).first()  # 12.5 rounds half to even
    assert b["alert_volume"] == 12
    assert ev.at_budget(df, 0.0001, ["id"]).first()["alert_volume"] == 1
    assert math.isinf(ev.at_budget(df.where("not y"), 0.1, ["id"]).first()["fp_ratio"])


def test_percentile_rank_shares_ties(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 2.0), (4, 3.0)], "id long, v double")
    assert {r["id"]: r["pct_rank"] for r in ev.percentile_rank(df, "v").collect()} == {1: 0.25, 2: 0.625, 3: 0.625, 4: 1.0}


def test_separability_reads_its_rows_once(spark):
    _, rows = scored(spark, ties=9)
    rows = [(k, s, "anomaly" if y else ("near_miss", "background", "background")[k % 3]) for k, s, y in rows]
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def met(v):
        seen.add(1)
        return v

    df = spark.createDataFrame([*rows, (-1, None, "background")], "id long, v double, kind string").withColumn("score", met.asNondeterministic()("v"))
    got = {r["kind"]: r for r in ev.separability(df).collect()}
    assert seen.value == len(rows) + 1
    every = [s for _, s, _ in rows]
    for kind, r in got.items():
        mine = [s for _, s, x in rows if x == kind]
        assert r["mean_percentile"] == pytest.approx(sum((sum(o < s for o in every) + (every.count(s) + 1) / 2) / len(every) for s in mine) / len(mine))
        both = [(k, s, x == "anomaly") for k, s, x in rows if x in ("anomaly", kind)]
        assert r["roc_auc"] == (None if kind == "anomaly" else pytest.approx(plain_auc(both)))
    assert set(got) == {"anomaly", "near_miss", "background"}


def test_split_is_exact_grouped_and_stable(spark):
    df = spark.range(1000).select((F.col("id") % 203).alias("customer_id"))
    a = {r["customer_id"]: r["is_test"] for r in ft.split_by_customer(df).collect()}
    b = {r["customer_id"]: r["is_test"] for r in ft.split_by_customer(df.repartition(7)).collect()}
    assert a == b and len(a) == 203 and sum(a.values()) == math.ceil(203 * 0.25)


def test_self_relative_uses_prior_active_months(spark):
    rows = [(1, "2024-01", 100.0, 2.0), (1, "2024-05", 300.0, 4.0), (1, "2024-06", 0.0, 1.0), (2, "2024-01", 0.0, 1.0), (2, "2024-02", 9.0, 1.0)]
    got = {(r["customer_id"], r["period"]): r for r in ft.self_relative(spark.createDataFrame(rows, "customer_id long, period string, total_amount double, txn_count double")).collect()}
    assert got[1, "2024-01"]["amount_vs_prior"] == 1.0 and got[1, "2024-01"]["is_first_active_month"] == 1.0
    assert got[1, "2024-05"]["amount_vs_prior"] == 3.0 and got[1, "2024-06"]["amount_vs_trailing_mean"] == 0.0
    assert got[2, "2024-02"]["amount_vs_prior"] == 1.0  # nothing to divide by


def test_labels_attach_once(spark):
    cells = spark.createDataFrame([(1, "2024-01"), (2, "2024-01")], "customer_id long, period string")
    lab = spark.createDataFrame([(1, "2024-01", True)], "customer_id long, period string, is_true boolean")
    assert {r["customer_id"]: r["is_true"] for r in ft.attach_labels(cells, lab).collect()} == {1: True, 2: False}
    with pytest.raises(ValueError, match="twice"):
        ft.attach_labels(cells, lab.union(lab))


def test_features_are_finite_and_label_free(spark, sf):
    from sablefin.plans.features import transformed

    x = transformed(spark, sf)
    number = [c for c, k in x.dtypes if k == "double"]
    assert len(number) == 37 + 7 + 5 + 5 and not any("label" in c or "true" in c for c in x.columns)
    bad = x.agg(*(F.sum((F.col(c).isNull() | F.isnan(c)).cast("long")).alias(c) for c in number)).first()
    assert set(bad) == {0}


def test_out_of_time_is_the_last_months(spark):
    df = spark.createDataFrame([(k, f"2024-{m:02d}") for k, m in enumerate((1, 2, 3, 4, 4, 5))], "customer_id long, period string")
    assert {r["period"] for r in ft.out_of_time(df).where("is_oot").collect()} == {"2024-03", "2024-04", "2024-05"}


def test_tripwires():
    assert models.tripwire(0.6) == "weak" and models.tripwire(0.8) == "ok"
    with pytest.raises(models.LeakageError):
        models.tripwire(0.99)
    assert models.tripwire(0.925, supervised=False) == "ok"


def test_rows_descend_isolation_trees_level_by_level():
    """Path lengths of a walk down each tree, for values on a cut, infinite ones and not-a-number too."""
    def walk(tree, row, at=0):
        return at + float(models._unlucky(tree[0])) if len(tree) == 1 else walk(tree[2] if row[tree[0]] < tree[1] else tree[3], row, at + 1)

    rng = np.random.default_rng(1)
    x = np.round(rng.lognormal(size=(3000, 5)), 1)
    for t in range(5):
        tree = models.grow_tree(x[rng.choice(3000, (1, 2, 64, 256, 256)[t])], t, 7)
        if len(tree) > 1:
            x[7, tree[0]] = tree[1]
        some = np.vstack([x[:200], np.full((1, 5), np.nan), np.full((1, 5), np.inf), np.full((1, 5), -np.inf)])
        assert models._descend(models._flat(tree), some).tolist() == [walk(tree, row) for row in some]
    assert models._descend(models._flat((3,)), x[:0]).tolist() == []


def test_isolation_forest_finds_outliers(spark):
    rng = random.Random(2)
    rows = [(k, rng.gauss(0, 1), rng.gauss(0, 1), False) for k in range(500)] + [(1000 + k, 9.0 + k, -9.0, True) for k in range(5)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y boolean")
    s = models.isolation_scores(df, df, ["a", "b"], ["id"], trees=50)
    assert ev.roc_auc(s).first()[0] > 0.98


def test_boosting_learns_and_ranks_features(spark):
    rng = random.Random(2)
    rows = [(k, x := rng.random(), rng.random(), x > 0.8) for k in range(600)]
    df = spark.createDataFrame(rows, "id long, a double, b double, y boolean")
    s, imp = models.boosted_scores(df.where("id % 2 = 0"), df.where("id % 2 = 1"), ["a", "b"], models.Boosting(5, 2, 0.3), ["id"])
    assert ev.roc_auc(s).first()[0] > 0.95 and imp[0][0] == "a"


def test_forest_is_the_plain_one_on_the_same_samples(spark):
    """Every tree's sample is the least hashed rows of all, not of a few thousand."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 3))
    df = spark.createDataFrame([(k, bool(k % 2), *map(float, r)) for k, r in enumerate(x)], "id long, y boolean, a double, b double, c double").repartition(6)
    h = {r["id"]: r["h"] for r in df.select("id", F.xxhash64("id", F.lit(7)).alias("h")).collect()}
    hashes = np.array([h[k] for k in range(len(x))])
    forest = models.isolation_forest(df, ["a", "b", "c"], ["id"], trees=12, sample=64)
    plain = [models.grow_tree(x[np.argsort(models.tree_hashes(hashes, t, 7), kind="stable")[:64]], t, 7) for t in range(12)]
    assert forest == [(64, t) for t in plain]
    got = {r["id"]: r["score"] for r in models.isolation_scores(df, df, ["a", "b", "c"], ["id"], trees=12, sample=64).collect()}
    depth = np.mean([models._depths(t, x) for t in plain], axis=0)
    want = 2.0 ** (-depth / float(models._unlucky(64)))
    assert max(abs(got[k] - want[k]) for k in got) < 1e-12
    few = models.isolation_forest(df.limit(10), ["a", "b", "c"], ["id"], trees=3, sample=64)
    assert [n for n, _ in few] == [10] * 3
    assert models.isolation_forest(df.limit(0), ["a"], ["id"]) == [] and models.isolation_scores(df.limit(0), df.limit(2), ["a"], ["id"]).count() == 2


def test_slices_equal_separate_runs(spark):
    rng = np.random.default_rng(6)
    rows = [(m, f"2024-{1 + k % 6:02d}", float(round(rng.normal() + (k % 7 == 0), 1)), k % 7 == 0) for m in ("p", "q") for k in range(600)]
    df = spark.createDataFrame(rows, "model string, period string, score double, y boolean")
    got = {(r["model"], r["slice"]): r for r in ev.out_of_time_report(df, 2).collect()}
    for m in ("p", "q"):
        for name, some in (("test", df), ("out_of_time", df.where("period >= '2024-05'"))):
            one = some.where(F.col("model") == m)
            r = got[m, name]
            assert r["roc_auc"] == pytest.approx(ev.roc_auc(one).first()[0], abs=1e-12) and r["average_precision"] == pytest.approx(ev.average_precision(one).first()[0], abs=1e-12)
            assert (r["rows"], r["positives"]) == (one.count(), one.where("y").count())
    assert sum(r["best"] for r in got.values()) == 2 and len({m for (m, _), r in got.items() if r["best"]}) == 1
    thin = {(r["model"], r["slice"]): r for r in ev.out_of_time_report(df, 2, least=10**6).collect()}
    assert thin["p", "out_of_time"]["roc_auc"] is None and thin["p", "test"]["roc_auc"] is not None
    assert ev.out_of_time_report(df.where("y"), 2).where("roc_auc is not null").count() == 0 and ev.out_of_time_report(df.limit(0), 2).count() == 0


def test_partitions_by_customer_grow_with_the_input(spark, tmp_path, sf):
    """A task of the monthly windows gets as many bytes of a large input as of a small one; rows and customers stay whole."""
    from sablefin.session import spread

    rows = spark.range(20_000).select((F.col("id") % 500).alias("customer_id"), F.rand(1).alias("x"))
    rows.write.parquet(str(tmp_path / "rows"))
    df = spark.read.parquet(str(tmp_path / "rows"))
    out = spread(df, "customer_id", part=10_000)
    parts = out.select("customer_id", F.spark_partition_id().alias("p")).distinct()
    assert out.rdd.getNumPartitions() > 8 and out.count() == 20_000 and parts.count() == 500
    assert spread(rows, "customer_id").count() == 20_000


def test_wide_feature_rows_are_not_shuffled(spark, sf):
    """Self-relative columns are made where base features are, so nothing is exchanged after these are settled but fitted baselines."""
    from sablefin.plans import features as plans

    base = plans.settled_base(spark, sf)
    got = plans.transformed(spark, sf, base)
    plain = ft.transform(base.drop(*ft.SELF), ft.peer_medians(base.where(plans._TRAIN)), ft.shrink_targets(base.where(plans._TRAIN)), plans.SEGMENTS)
    assert got.columns == plain.columns and got.exceptAll(plain).isEmpty() and plain.exceptAll(got).isEmpty()
    by_customer = lambda df: df._jdf.queryExecution().executedPlan().toString().count("hashpartitioning(customer_id")
    assert by_customer(got) == 0 < by_customer(plain)


def test_base_features_are_deleted_once_the_matrix_is_settled(spark, sf):
    from sablefin.plans.screening import _matrices
    from sablefin.session import settled_paths, settled_under

    held = set(settled_paths(spark))
    train, test = _matrices(spark, sf)
    more = [p for p in settled_paths(spark) if p not in held]
    assert not any("/base-features-" in p for p in more)
    assert [p for p in more if "/model-matrix-" in p] == settled_under(train) == settled_under(test)
    assert train.count() > 0 and test.count() > 0
