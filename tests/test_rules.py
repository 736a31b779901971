"""Scenario semantics on hand-made feeds, and what must hold between settings."""

from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from sablefin.config import scenarios
from sablefin.operators import rules, sweep
from sablefin.plans.monitoring import cells, feed, tuned
from sablefin.sources import tables
from sablefin.sources.tables import TX_SCHEMA


def day(n, h=9):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n, hours=h)


@pytest.fixture(scope="module")
def tx_of(spark):
    def build(rows):
        """(customer, day, amount, channel, direction[, counterparty[, country]])"""
        full = [(k, c, t, float(a), ch, d, *(x[0] if x else "CP",), x[1] if len(x) > 1 else 9, False) for k, (c, t, a, ch, d, *x) in enumerate(rows)]
        return spark.createDataFrame(full, TX_SCHEMA)

    return build


@pytest.fixture(scope="module")
def cust(spark):
    rows = [(k, "SALARIED", dt.datetime(2023, 12, 20), 0, "LOW", False) for k in range(1, 6)]
    return spark.createDataFrame(rows, "customer_id bigint, behaviour_segment string, account_open_date timestamp, nation_key int, kyc string, is_pep boolean")


@pytest.fixture(scope="module")
def risk(spark):
    return spark.createDataFrame([(1, "HIGH"), (2, "MEDIUM"), (9, "LOW")], "country_key int, tier string")


def run(rule, tx, cust, risk, **params):
    s = scenarios()[rule]
    for k, v in params.items():
        s = s.with_param(k, v)
    return {(r["customer_id"], r["period"]): (r["metric_value"], r["alert_amount"], r["txn_count"]) for r in rules.run_rule(s, tx, cust, risk).collect()}


def test_two_deposits_make_three_pairs(tx_of, cust, risk):
    tx = tx_of([(1, day(0), 9000, "CASH", "CREDIT"), (1, day(5), 9500, "CASH", "CREDIT"), (2, day(0), 9000, "CASH", "CREDIT"), (2, day(10), 9000, "CASH", "CREDIT"), (3, day(0), 100, "CASH", "CREDIT")])
    assert run("R01_STRUCTURING", tx, cust, risk) == {(1, "2024-01"): (3.0, 28000.0, 3)}


def test_hold_window_is_open_then_closed(tx_of, cust, risk):
    tx = tx_of([(1, day(0), 5000, "WIRE", "CREDIT"), (1, day(0), 9999, "WIRE", "DEBIT"), (1, day(3), 4500, "WIRE", "DEBIT"), (2, day(0), 5000, "WIRE", "CREDIT"), (2, day(3, 10), 5000, "WIRE", "DEBIT")])
    assert run("R02_VELOCITY", tx, cust, risk) == {(1, "2024-01"): (0.9, 4500.0, 1)}


def test_equal_credits_merge(tx_of, cust, risk):
    tx = tx_of([(1, day(0), 6000, "WIRE", "CREDIT"), (1, day(0), 6000, "ACH", "CREDIT"), (1, day(1), 3000, "WIRE", "DEBIT")])
    assert run("R02_VELOCITY", tx, cust, risk) == {(1, "2024-01"): (1.0, 6000.0, 1)}  # one credit, its debits twice
    s = scenarios()["R02_VELOCITY"].params
    assert rules.velocity_join(tx, s).collect() == rules.velocity(tx, cust, risk, s).collect()


def test_dormancy_counts_the_whole_month(tx_of, cust, risk):
    tx = tx_of([(1, day(0), 10, "CARD", "DEBIT"), (1, day(91), 8000, "WIRE", "DEBIT"), (1, day(92), 8000, "WIRE", "DEBIT"), (2, day(0), 10, "CARD", "DEBIT"), (2, day(88), 90000, "WIRE", "DEBIT")])
    assert run("R04_DORMANT_REACTIVATION", tx, cust, risk) == {(1, "2024-04"): (16000.0, 16000.0, 2)}


def test_unknown_counterparties_are_left_out_of_totals(tx_of, cust, risk):
    rows = [(1, day(k), 5000, "WIRE", "DEBIT", "A" if k < 4 else "B") for k in range(5)] + [(1, day(9), 10**6, "WIRE", "DEBIT", None)]
    assert run("R06_COUNTERPARTY_CONCENTRATION", tx_of(rows), cust, risk) == {(1, "2024-01"): (0.8, 20000.0, 5)}


def test_corridor_and_new_account(tx_of, cust, risk):
    tx = tx_of([(1, day(k), 6000, "WIRE", "DEBIT", "A", 1 if k < 2 else 9) for k in range(6)])
    assert run("R07_HIGH_RISK_CORRIDOR", tx, cust, risk) == {(1, "2024-01"): (2 / 6, 12000.0, 2)}
    assert run("R05_NEW_ACCOUNT_BURST", tx, cust, risk) == {(1, "2024-01"): (36000.0, 36000.0, 6)}


def test_empty_feed(tx_of, cust, risk):
    assert rules.run_all(tx_of([]), cust, risk).count() == 0


def test_window_form_equals_self_join(spark, sf):
    tx, c, r = feed(spark, sf, "events")
    for days in (1.0, 3.0, 10.0):
        p = scenarios()["R01_STRUCTURING"].with_param("window_days", days).params
        p = {**p, "lower_bound": 1.0, "upper_bound": 30000.0}
        a, b = (sorted(map(tuple, d.collect())) for d in (rules.structuring(tx, c, r, p), rules.structuring_selfjoin(tx, p)))
        assert a == b and a


def test_spread_forms_equal_the_joins_for_one_hot_customer(spark, tx_of, cust, risk):
    """Two thirds of all rows are one customer's: within hours, days and at equal instants, before 1970 as well."""
    rng = random.Random(8)
    rows = []
    for k in range(900):
        c = 1 if k % 3 else rng.choice((2, 3))
        t = dt.datetime(1969 if k % 5 == 0 else 2024, 12 if k % 5 == 0 else 1, 28) + dt.timedelta(hours=rng.randrange(200), minutes=rng.choice((0, 0, 7, 59)), microseconds=rng.choice((0, 1)))
        rows.append((c, t, rng.choice((100, 5000.5, 8200, 9000.25, 9999)), rng.choice(("CASH", "WIRE")), rng.choice(("CREDIT", "DEBIT"))))
    tx = tx_of(rows)
    got = lambda d: sorted(map(tuple, d.collect()))
    for days in (1.0, 4.0, 10.0):
        p = scenarios()["R01_STRUCTURING"].with_param("window_days", days).params
        assert got(rules.structuring(tx, cust, risk, p)) == got(rules.structuring_selfjoin(tx, p))
    for hours in (1.0, 24.0, 72.0):
        p = scenarios()["R02_VELOCITY"].with_param("max_hold_hours", hours).params
        assert got(rules.velocity(tx, cust, risk, p)) == got(rules.velocity_join(tx, p))
    plan = rules.velocity(tx, cust, risk, scenarios()["R02_VELOCITY"].params)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(customer_id#\d+L, stretch", plan)


@pytest.mark.parametrize("rule", sorted(tuned()))
def test_sweep_equals_running_each_setting(spark, sf, rule):
    s, f, lab = tuned()[rule], feed(spark, sf, "events"), cells(spark, sf)
    swept = {r["param_value"]: r for r in sweep.sweep(s, *f, lab).collect()}
    volumes = []
    for v in s.grid:
        alerts = rules.run_rule(s.with_param(s.sweep_param, v), *f)
        assert swept[v]["alert_volume"] == alerts.count()
        volumes.append(swept[v]["alert_volume"])
    assert volumes == sorted(volumes, reverse=True)  # a higher minimum never alerts more
    assert [r["position"] for r in swept.values()].count("BASELINE") == 1


def test_unknown_parameter_and_rule(spark, sf):
    with pytest.raises(KeyError):
        scenarios()["R01_STRUCTURING"].with_param("nope", 1)
    s = scenarios()["R01_STRUCTURING"]
    with pytest.raises(rules.RuleError):
        rules.candidates(type(s)("R99", s.params, s.sweep_param, s.sweep_values), *feed(spark, sf, "events"))


def test_filters_reach_the_scan_and_shuffles_stay_few(spark, sf):
    plan = rules.run_rule(tuned()["R03_ROUND_DOLLAR"], *feed(spark, sf, "events"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_recommendation_prefers_recall_within_the_limit(spark):
    rows = [("R", "p", v, pos, n, 1, n - 1, 0.1, rec, fp, 0.1, 0, 0, 0.0) for v, pos, n, rec, fp in ((1.0, "LOOSER", 90, 0.9, 50.0), (2.0, "BASELINE", 50, 0.7, 20.0), (3.0, "TIGHTER", 40, 0.7, 10.0))]
    kinds = "rule_id string, param_name string, param_value double, position string, alert_volume long, true_positives long, false_positives long, precision double, recall double, false_positive_ratio double, alert_rate double, delta_alerts long, delta_true_positives long, marginal_reviews_per_extra_hit double"
    r = sweep.recommend(spark.createDataFrame(rows, kinds), 40.0).first()
    assert (r["recommended_value"], r["within_limit"], r["changed"]) == (3.0, True, True)
    r = sweep.recommend(spark.createDataFrame(rows, kinds).where(F.col("false_positive_ratio") > 1), 5.0).first()
    assert (r["recommended_value"], r["within_limit"]) == (3.0, False)


def test_lines_are_the_same_in_sized_joins(spark, sf, monkeypatch):
    plain = tables.tx_lines(spark, sf)
    monkeypatch.setattr(tables, "pieces", lambda df: 7)
    sized = tables.tx_lines(spark, sf).select(*plain.columns)
    assert plain.count() and not plain.exceptAll(sized).count() and not sized.exceptAll(plain).count()


def test_dormancy_partitions_follow_the_input(spark, tmp_path):
    """Six parts' worth of files: a task takes a part of them, not a share of the session's four partitions."""
    tx = spark.range(3_000_000).select((F.col("id") % 9_000).alias("customer_id"), F.timestamp_seconds(1_700_000_000 + F.col("id") * 7).alias("txn_ts"), (F.rand(1) * 1e4).alias("amount"))
    tx.write.parquet(str(tmp_path / "tx"))
    tx = spark.read.parquet(str(tmp_path / "tx"))
    n = sum(f.stat().st_size for f in (tmp_path / "tx").glob("*.parquet")) // (4 << 20)
    got = rules.dormant(tx, None, None, {"dormancy_days": 1, "min_reactivation_txns": 1})
    assert n > 4 and got.rdd.getNumPartitions() == n
