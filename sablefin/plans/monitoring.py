"""Queries over scenarios, sweeps and their evaluation, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.config import RULE_PARAMS, Scenario, scenarios
from sablefin.operators import rules, sweep
from sablefin.plans.rules_sql import candidates_sql, rule_sql
from sablefin.sources import tables as t

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}

#: Thresholds fitted to the driver's feeds: the shares below are what its uniform draws can reach.
TUNED = {
    "R03_ROUND_DOLLAR": {"round_unit": 100.0, "min_round_share": 0.02},
    "R06_COUNTERPARTY_CONCENTRATION": {"min_concentration": 0.25},
    "R07_HIGH_RISK_CORRIDOR": {"min_corridor_share": 0.20},
    "R08_CASH_INTENSITY": {"min_cash_share": 0.40},
}
GRIDS = {
    "R03_ROUND_DOLLAR": (0.01, 0.02, 0.03), "R06_COUNTERPARTY_CONCENTRATION": (0.20, 0.25, 0.30), "R07_HIGH_RISK_CORRIDOR": (0.15, 0.20, 0.25), "R08_CASH_INTENSITY": (0.35, 0.40, 0.45),
}


def tuned() -> dict[str, Scenario]:
    out = {}
    for r, s in scenarios().items():
        p = {**s.params, **TUNED.get(r, {})}
        out[r] = Scenario(r, p, s.sweep_param, GRIDS.get(r, s.sweep_values))
    return out


def _feed(rule_id: str) -> str:
    return "lines" if rule_id == "R04_DORMANT_REACTIVATION" else "events"


def feed(spark: SparkSession, sf_dir: str, kind: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    if kind == "lines":
        return t.tx_lines(spark, sf_dir), t.line_customers(spark, sf_dir), t.risk_tiers(spark, sf_dir)
    return t.tx_events(spark, sf_dir), t.event_customers(spark, sf_dir), t.risk_tiers(spark, sf_dir)


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def _rule(rule_id: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rules.run_rule(tuned()[rule_id], *feed(spark, sf_dir, _feed(rule_id)))

    return run


_ROUND = "rule_id, customer_id, period, round(metric_value, 6) AS metric_value, alert_amount, txn_count"
for _id, _s in tuned().items():
    _add(_id.lower(), _rule(_id), f"{t.sql_views(_feed(_id))} {rule_sql(_s)}")


def all_alerts_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every scenario's alerts over the dense feed, one cached scan of it."""
    return rules.run_all(*feed(spark, sf_dir, "events"), tuned())


_add("all_alerts_union", all_alerts_union, f"{t.sql_views()} " + " UNION ALL ".join(f"({rule_sql(s)})" for s in tuned().values()))
_add(
    "r01_pairs_selfjoin", lambda spark, d: rules.structuring_selfjoin(t.tx_events(spark, d), RULE_PARAMS["R01_STRUCTURING"]),
    f"{t.sql_views()} {candidates_sql(scenarios()['R01_STRUCTURING'])}",
)
_add(
    "r02_interval_join", lambda spark, d: rules.velocity_join(t.tx_events(spark, d), RULE_PARAMS["R02_VELOCITY"]),
    f"{t.sql_views()} {candidates_sql(scenarios()['R02_VELOCITY'])}",
)


_R01 = RULE_PARAMS["R01_STRUCTURING"]
_OBSERVED = {"observed_min": "min(amount)", "observed_max": "max(amount)", "observed_txns": "count(*)"}


def params_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parameter table, with what the feed shows as further parameters, turned into one row, as a rule's head reads it."""
    seen = t.tx_events(spark, sf_dir).agg(*(F.expr(x).cast("double").alias(n) for n, x in _OBSERVED.items()))
    more = seen.select(F.lit("R01_STRUCTURING").alias("rule_id"), F.expr("stack(3, " + ", ".join(f"'{n}', {n}" for n in _OBSERVED) + ") AS (param_name, param_value)"))
    return t.pivot_params(t.params_table(spark, RULE_PARAMS).unionByName(more), "R01_STRUCTURING", [*_R01, *_OBSERVED])


_VALUES = ", ".join(f"('{r}', '{n}', {v}::DOUBLE)" for r, p in RULE_PARAMS.items() for n, v in p.items())
_PIVOT = ", ".join(f"max(v) FILTER (n = '{n}') AS {n}" for n in _R01)
_add("params_pivot", params_pivot, f"{t.sql_views()}, seen AS (SELECT {', '.join(f'({x})::DOUBLE AS {n}' for n, x in _OBSERVED.items())} FROM tx) SELECT * FROM (SELECT {_PIVOT} FROM (VALUES {_VALUES}) x(r, n, v) WHERE r = 'R01_STRUCTURING'), seen")


def txn_param_crossjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions against the one-row parameter relation, the form that takes thresholds from a table."""
    p = params_pivot(spark, sf_dir)
    tx = t.tx_events(spark, sf_dir)
    return tx.crossJoin(F.broadcast(p)).where(F.col("amount").between(F.col("lower_bound"), F.col("upper_bound"))).groupBy("channel", "direction").agg(F.count(F.lit(1)).alias("n"), rules.total(F.col("amount")).alias("amount"))  # one row


_P = RULE_PARAMS["R01_STRUCTURING"]
_add(
    "txn_param_crossjoin", txn_param_crossjoin,
    f"{t.sql_views()} SELECT channel, direction, count(*) AS n, CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM tx WHERE amount BETWEEN {_P['lower_bound']} AND {_P['upper_bound']} GROUP BY 1, 2",
)


def run_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = t.run_window(spark, "2024-01-05 00:00:00", "2024-01-20 00:00:00")
    tx = t.tx_events(spark, sf_dir)
    inside = (F.col("txn_ts") >= F.col("window_start")) & (F.col("txn_ts") < F.col("window_end"))
    return tx.crossJoin(F.broadcast(w)).groupBy(inside.alias("inside")).agg(F.count(F.lit(1)).alias("n"))  # one row


_add("run_window", run_window, f"{t.sql_views()} SELECT txn_ts >= TIMESTAMP '2024-01-05' AND txn_ts < TIMESTAMP '2024-01-20' AS inside, count(*) AS n FROM tx GROUP BY 1")


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled customer-months of the dense feed."""
    return t.cell_labels(t.tx_events(spark, sf_dir).select("customer_id", rules.period()))


CELLS_SQL = f"SELECT DISTINCT customer_id, period, {t.LABEL_EXPR} AS is_true FROM (SELECT customer_id, strftime(txn_ts, '%Y-%m') AS period FROM tx)"


def _sweep_sql(s: Scenario) -> str:
    grid = ", ".join(f"({v}::DOUBLE)" for v in s.grid)
    base = s.params[s.sweep_param]
    return f"""SELECT '{s.rule_id}' AS rule_id, '{s.sweep_param}' AS param_name, v AS param_value,
  CASE WHEN v = {base} THEN 'BASELINE' WHEN n > bn THEN 'LOOSER' ELSE 'TIGHTER' END AS position, n AS alert_volume, k AS true_positives, n - k AS false_positives,
  round(coalesce(k / nullif(n, 0), 0), 6) AS precision, round(coalesce(k / nullif(truth, 0), 0), 6) AS recall,
  round(CASE WHEN k = 0 THEN CASE WHEN n = 0 THEN 0::DOUBLE ELSE 'inf'::DOUBLE END ELSE (n - k) / nullif(k, 0) END, 6) AS false_positive_ratio, round(n / cells, 6) AS alert_rate,
  n - bn AS delta_alerts, k - bk AS delta_true_positives,
  round(CASE WHEN k <> bk THEN abs(n - bn) / nullif(abs(k - bk), 0) WHEN n <> bn THEN 'inf'::DOUBLE ELSE 0::DOUBLE END, 6) AS marginal_reviews_per_extra_hit
FROM (SELECT *, max(n) FILTER (v = {base}) OVER () AS bn, max(k) FILTER (v = {base}) OVER () AS bk FROM (
  SELECT v, count(c.metric_value) AS n, count(*) FILTER (c.metric_value IS NOT NULL AND l.is_true) AS k, (SELECT count(*) FROM lab) AS cells, (SELECT count(*) FROM lab WHERE is_true) AS truth
  FROM (VALUES {grid}) g(v) LEFT JOIN ({candidates_sql(s)}) c ON c.metric_value >= v LEFT JOIN lab l ON l.customer_id = c.customer_id AND l.period = c.period GROUP BY v))"""


def _sweep(rule_id: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sweep.sweep(tuned()[rule_id], *feed(spark, sf_dir, "events"), cells(spark, sf_dir))

    return run


_SWEEP_VIEWS = f"{t.sql_views()}, lab AS MATERIALIZED ({CELLS_SQL})"
for _id, _s in tuned().items():
    _add("sweep_" + _id[:3].lower(), _sweep(_id), f"{_SWEEP_VIEWS} {_sweep_sql(_s)}")


def sweep_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.sweep_all(tuned(), *feed(spark, sf_dir, "events"), cells(spark, sf_dir))


_ALL_SWEEPS = " UNION ALL ".join(f"({_sweep_sql(s)})" for s in tuned().values())
_add("sweep_all", sweep_all, f"{_SWEEP_VIEWS} {_ALL_SWEEPS}")
_add(
    "threshold_recommendations", lambda spark, d: sweep.recommend(sweep_all(spark, d), 6.0),
    f"""{_SWEEP_VIEWS}, sw AS MATERIALIZED ({_ALL_SWEEPS}) SELECT rule_id, param_name, baseline_value, param_value AS recommended_value, baseline_recall, recall AS recommended_recall,
  baseline_ratio, false_positive_ratio AS recommended_ratio, within_limit, alert_volume AS recommended_volume, param_value <> baseline_value AS changed FROM (
  SELECT *, false_positive_ratio <= 6 AS within_limit, max(param_value) FILTER (position = 'BASELINE') OVER r AS baseline_value, max(recall) FILTER (position = 'BASELINE') OVER r AS baseline_recall,
    max(false_positive_ratio) FILTER (position = 'BASELINE') OVER r AS baseline_ratio,
    row_number() OVER (PARTITION BY rule_id ORDER BY false_positive_ratio <= 6 DESC, CASE WHEN false_positive_ratio <= 6 THEN recall END DESC NULLS LAST,
      CASE WHEN false_positive_ratio <= 6 THEN param_value END DESC NULLS LAST, false_positive_ratio, param_value DESC) AS k
  FROM sw WINDOW r AS (PARTITION BY rule_id)) WHERE k = 1""",
)
_ALERTS = " UNION ALL ".join(f"({rule_sql(s)})" for s in tuned().values())
_add(
    "rule_performance", lambda spark, d: sweep.rule_performance(all_alerts_union(spark, d), cells(spark, d)),
    f"""{_SWEEP_VIEWS}, a AS MATERIALIZED ({_ALERTS}) SELECT rule_id, n AS alert_volume, k AS true_positives, n - k AS false_positives, truth - k AS false_negatives, round(k / n, 6) AS precision,
  round(coalesce(k / nullif(truth, 0), 0), 6) AS recall, round(CASE WHEN k = 0 THEN CASE WHEN n = 0 THEN 0::DOUBLE ELSE 'inf'::DOUBLE END ELSE (n - k) / nullif(k, 0) END, 6) AS false_positive_ratio, round(n / cells, 6) AS alert_rate
  FROM (SELECT rule_id, count(*) AS n, count(*) FILTER (is_true) AS k, (SELECT count(*) FROM lab) AS cells, (SELECT count(*) FROM lab WHERE is_true) AS truth
    FROM a LEFT JOIN lab USING (customer_id, period) GROUP BY rule_id)""",
)
_add(
    "union_recall", lambda spark, d: sweep.union_recall(all_alerts_union(spark, d), cells(spark, d)),
    f"""{_SWEEP_VIEWS}, a AS MATERIALIZED ({_ALERTS}), c AS (SELECT DISTINCT customer_id, period, 1 AS hit FROM a)
  SELECT count(*) AS true_cells, count(hit) AS detected_cells, round(coalesce(count(hit) / nullif(count(*), 0), 0), 6) AS union_recall FROM lab LEFT JOIN c USING (customer_id, period) WHERE is_true""",
)


def _cells_of(spark: SparkSession, d: str, rule_id: str) -> DataFrame:
    return _rule(rule_id)(spark, d).select("customer_id", "period").distinct()


def semi_join_cells(spark: SparkSession, d: str) -> DataFrame:
    """Alert cells that are true."""
    return _cells_of(spark, d, "R01_STRUCTURING").join(cells(spark, d).where("is_true"), ["customer_id", "period"], "left_semi")


def anti_join_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Transactions of the dense feed whose account holder isn't in the customer table, by customer."""
    c = t.read_table(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("customer_id"))
    return t.tx_events(spark, d).join(c, "customer_id", "left_anti").groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


_R1, _R2 = (f"SELECT DISTINCT customer_id, period FROM ({rule_sql(tuned()[r])})" for r in ("R01_STRUCTURING", "R02_VELOCITY"))
_V = t.sql_views()
_add("semi_join_cells", semi_join_cells, f"{_SWEEP_VIEWS} SELECT customer_id, period FROM ({_R1}) a WHERE EXISTS (SELECT 1 FROM lab l WHERE l.is_true AND l.customer_id = a.customer_id AND l.period = a.period)")
_add("anti_join_orphans", anti_join_orphans, f"{_V} SELECT customer_id, count(*) AS n FROM tx LEFT JOIN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING') ON c_custkey = customer_id WHERE c_custkey IS NULL GROUP BY 1")
_add("set_intersect", lambda s, d: _cells_of(s, d, "R01_STRUCTURING").intersect(_cells_of(s, d, "R02_VELOCITY")), f"{_V} ({_R1}) INTERSECT ({_R2})")
_add("set_except", lambda s, d: _cells_of(s, d, "R01_STRUCTURING").subtract(_cells_of(s, d, "R02_VELOCITY")), f"{_V} ({_R1}) EXCEPT ({_R2})")
_add("distinct_cells", lambda s, d: cells(s, d), f"{_V} {CELLS_SQL}")
_add(
    "month_end", lambda s, d: t.tx_lines(s, d).select(rules.period()).distinct().select("period", F.last_day(F.to_date(F.concat("period", F.lit("-01")))).alias("month_end")),
    f"{t.sql_views('lines')} SELECT DISTINCT strftime(txn_ts, '%Y-%m') AS period, last_day(txn_ts) AS month_end FROM tx",
)
