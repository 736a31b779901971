"""Queries over features, fitted baselines, splits and rank metrics, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.operators import evaluate, features as f, rules
from sablefin.plans.monitoring import feed
from sablefin.session import settle
from sablefin.sources import tables as t

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
_DEC = "CAST(coalesce(sum(CAST({x} AS DECIMAL(18,2))), 0) AS DOUBLE)"


def _m(test: str | None = None) -> str:
    return _DEC.format(x=f"CASE WHEN {test} THEN amount END" if test else "amount")


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def _sig(c: str) -> str:
    """Rounding that hides the last bits of float means, in both engines."""
    return f"round({c}, 6)"


def _rounded(df: DataFrame, keep: list[str], digits: int = 6) -> DataFrame:
    """All but ``keep`` as doubles, rounded where float arithmetic made them: rounding goes through decimals and is slow."""
    exact = {*f.EXACT, *(c for c in df.columns if c.startswith("segment_"))}
    number = lambda c: F.col(c).cast("double")
    return df.select(*keep, *(number(c).alias(c) if c in exact else F.round(number(c), digits).alias(c) for c in df.columns if c not in keep))


_MONTHLY = f"""SELECT customer_id, period, count(*) AS txn_count, {_m()} AS total_amount, max(amount) AS max_amount, coalesce(stddev_samp(amount), 0) AS std_amount,
  quantile_cont(amount, 0.5) AS median_amount, {_m("direction = 'CREDIT'")} AS credit_amount, {_m("direction = 'DEBIT'")} AS debit_amount, count(*) FILTER (direction = 'CREDIT') AS credits,
  {_m("channel = 'CASH'")} AS cash_amount, count(*) FILTER (channel = 'CASH') AS cash_txns, {_m("channel = 'WIRE'")} AS wire_amount, {_m("channel = 'CARD'")} AS card_amount,
  count(*) FILTER (amount BETWEEN 7500 AND 9999.99) AS near_ctr_count, count(*) FILTER (amount = round(amount / 1000.0) * 1000.0) AS rounds, count(*) FILTER (amount >= 10000) AS ctr_count,
  {_m("is_cross_border")} AS cross_border_amount, count(DISTINCT country_key) AS distinct_countries, count(DISTINCT counterparty) AS distinct_counterparties,
  count(*) FILTER (hour(txn_ts) < 7 OR hour(txn_ts) >= 20) AS nights, count(*) FILTER (dayofweek(txn_ts) IN (0, 6)) AS weekends, min(txn_ts) AS first_ts, max(txn_ts) AS last_ts,
  {_m("tier = 'HIGH'")} AS high_risk_amount, {_m("tier = 'MEDIUM'")} AS medium_risk_amount, count(*) FILTER (tier = 'HIGH') AS high_risk_count, coalesce(max(gap), 0) AS max_gap_days
  FROM (SELECT tx.*, tier, strftime(txn_ts, '%Y-%m') AS period, date_diff('day', lag(txn_ts) OVER (PARTITION BY customer_id ORDER BY txn_ts), txn_ts) AS gap FROM tx LEFT JOIN risk USING (country_key)) GROUP BY 1, 2"""
_TOP = f"""SELECT customer_id, period, max(s) AS top_cp_amount FROM (SELECT customer_id, strftime(txn_ts, '%Y-%m') AS period, counterparty, {_m()} AS s FROM tx WHERE counterparty IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2"""


def base_sql(kind: str) -> str:
    """WITH-list up to ``feat``: key, segment and the base features as doubles."""
    ex = {
        "month_of_year": "substr(period, 6, 2)::INTEGER", "avg_amount": "total_amount / txn_count", "credit_share": "credits / txn_count", "passthrough_ratio": "least(debit_amount, credit_amount) / nullif(credit_amount, 0)",
        "cash_share": "cash_amount / nullif(total_amount, 0)", "cash_txn_share": "cash_txns / txn_count", "wire_share": "wire_amount / nullif(total_amount, 0)", "card_share": "card_amount / nullif(total_amount, 0)",
        "near_ctr_share": "near_ctr_count / txn_count", "round_share": "rounds / txn_count", "cross_border_share": "cross_border_amount / nullif(total_amount, 0)", "counterparty_diversity": "distinct_counterparties / txn_count",
        "night_share": "nights / txn_count", "weekend_share": "weekends / txn_count", "active_span_days": "date_diff('day', first_ts, last_ts)", "high_risk_share": "high_risk_amount / nullif(total_amount, 0)",
        "medium_risk_share": "medium_risk_amount / nullif(total_amount, 0)", "top_counterparty_share": "coalesce(top_cp_amount, 0) / nullif(total_amount, 0)", "account_age_days": "date_diff('day', account_open_date, first_ts)",
        "kyc_risk_ordinal": "CASE kyc WHEN 'LOW' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END", "is_pep": "is_pep::INTEGER", "nationality_high_risk": "(rn.tier IS NOT NULL)::INTEGER",
    }
    cols = ", ".join(f"coalesce(({ex.get(c, c)})::DOUBLE, 0) AS {c}" for c in f.BASE)
    return f"""{t.sql_views(kind)}, monthly AS ({_MONTHLY}), topcp AS ({_TOP}),
feat AS MATERIALIZED (SELECT customer_id, period, behaviour_segment, {cols} FROM monthly LEFT JOIN topcp USING (customer_id, period) JOIN cust USING (customer_id)
  LEFT JOIN (SELECT country_key, tier FROM risk WHERE tier = 'HIGH') rn ON rn.country_key = nation_key)"""


def _base(kind: str):
    return lambda spark, d: f.base_features(*feed(spark, d, kind))


def features_base(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_base("lines")(spark, d), ["customer_id", "period", "behaviour_segment"])


_ROUND_BASE = ", ".join(f"round({c}, 6) AS {c}" for c in f.BASE)
_add("features_base", features_base, f"{base_sql('lines')} SELECT customer_id, period, behaviour_segment, {_ROUND_BASE} FROM feat")
_add(
    "features_base_events", lambda s, d: _rounded(_base("events")(s, d), ["customer_id", "period", "behaviour_segment"]),
    f"{base_sql('events')} SELECT customer_id, period, behaviour_segment, {_ROUND_BASE} FROM feat",
)


def features_monthly(spark: SparkSession, d: str) -> DataFrame:
    tx, _, risk = feed(spark, d, "events")
    return f.monthly(tx, risk).select("customer_id", "period", "txn_count", "total_amount", F.round("std_amount", 6).alias("std_amount"), "median_amount", "credits", "cash_amount", "near_ctr_count", "distinct_countries", "distinct_counterparties", "nights", "weekends")


_add("features_monthly", features_monthly, f"{t.sql_views()} SELECT customer_id, period, txn_count, total_amount, round(std_amount, 6) AS std_amount, median_amount, credits, cash_amount, near_ctr_count, distinct_countries, distinct_counterparties, nights, weekends FROM ({_MONTHLY})")
_add("features_corridor", lambda s, d: f.monthly(feed(s, d, "events")[0], t.risk_tiers(s, d)).select("customer_id", "period", "high_risk_amount", "medium_risk_amount", "high_risk_count"), f"{t.sql_views()} SELECT customer_id, period, high_risk_amount, medium_risk_amount, high_risk_count FROM ({_MONTHLY})")
_add("features_top_counterparty", lambda s, d: f.top_counterparty(t.tx_events(s, d)), f"{t.sql_views()} {_TOP}")
_add("features_gaps", lambda s, d: f.monthly(t.tx_lines(s, d), t.risk_tiers(s, d)).select("customer_id", "period", "max_gap_days"), f"{t.sql_views('lines')} SELECT customer_id, period, max_gap_days::INTEGER AS max_gap_days FROM ({_MONTHLY})")

# Fitted baselines use customers whose id isn't a multiple of 4 as training ones, so that both engines agree.
_TRAIN = "customer_id % 4 <> 0"


def _train(spark: SparkSession, d: str) -> DataFrame:
    return _base("lines")(spark, d).where(_TRAIN)


_MEDS = ", ".join(f"quantile_cont({c}, 0.5) AS med_{c}" for c in f.PEER)
_MUS = ", ".join(f"sum({c} * txn_count) / coalesce(nullif(sum(txn_count), 0), 1) AS mu_{c}" for c in f.SHRUNK)
_MED_SQL = f"SELECT behaviour_segment, {_MEDS} FROM feat WHERE {_TRAIN} GROUP BY 1 UNION ALL SELECT NULL, {_MEDS} FROM feat WHERE {_TRAIN}"
_add("peer_medians", lambda s, d: _rounded(f.peer_medians(_train(s, d)), ["behaviour_segment"]), f"{base_sql('lines')} SELECT behaviour_segment, " + ", ".join(f"round(med_{c}, 6) AS med_{c}" for c in f.PEER) + f" FROM ({_MED_SQL})")
_add("shrink_targets", lambda s, d: _rounded(f.shrink_targets(_train(s, d)), []), f"{base_sql('lines')} SELECT " + ", ".join(f"round(mu_{c}, 6) AS mu_{c}" for c in f.SHRUNK) + f" FROM (SELECT {_MUS} FROM feat WHERE {_TRAIN})")
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


def settled_base(spark: SparkSession, d: str) -> DataFrame:
    """Base features and self-relative columns, which need the same rows by customer."""
    return settle(f.self_relative(_base("lines")(spark, d)), "base-features")


def transformed(spark: SparkSession, d: str, base: DataFrame | None = None) -> DataFrame:
    base = settled_base(spark, d) if base is None else base  # read three times
    train = base.where(_TRAIN)
    return f.transform(base, f.peer_medians(train), f.shrink_targets(train), SEGMENTS)


def features_transformed(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(transformed(spark, d), ["customer_id", "period", "behaviour_segment"], 5)


def _clip(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN 1 ELSE greatest(0, least(50, {x})) END"


_SELF = f"""coalesce(lag(total_amount) OVER w, 0) AS prior_month_amount, {_clip("total_amount / nullif(lag(total_amount) OVER w, 0)")} AS amount_vs_prior,
  {_clip("txn_count / nullif(lag(txn_count) OVER w, 0)")} AS count_vs_prior, {_clip("total_amount / nullif(avg(total_amount) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)")} AS amount_vs_trailing_mean,
  (row_number() OVER w = 1)::INTEGER::DOUBLE AS is_first_active_month"""
_T = [f"round(txn_count / (txn_count + 3) * {c} + 3 / (txn_count + 3) * mu_{c}, 5) AS {c}" if c in f.SHRUNK else f"round({c}, 5) AS {c}" for c in f.BASE]
_T += [f"round({_clip(f'{c} / nullif(coalesce(own.med_{c}, everyone.med_{c}), 0)')}, 5) AS peer_ratio_{c}" for c in f.PEER]
_T += [f"round({c}, 5) AS {c}" for c in f.SELF] + [f"(behaviour_segment = '{s}')::INTEGER::DOUBLE AS segment_{s}" for s in SEGMENTS]
_add(
    "features_transformed", features_transformed,
    f"""{base_sql('lines')}, med AS MATERIALIZED ({_MED_SQL}), own AS (SELECT * FROM med WHERE behaviour_segment IS NOT NULL), everyone AS (SELECT * EXCLUDE (behaviour_segment) FROM med WHERE behaviour_segment IS NULL),
mu AS (SELECT {_MUS} FROM feat WHERE {_TRAIN}), sr AS (SELECT *, {_SELF} FROM feat WINDOW w AS (PARTITION BY customer_id ORDER BY period))
SELECT customer_id, period, behaviour_segment, {", ".join(_T)} FROM sr LEFT JOIN own USING (behaviour_segment), everyone, mu""",
)
_add(
    "self_relative_windows", lambda s, d: _rounded(f.self_relative(_base("lines")(s, d)).select("customer_id", "period", *f.SELF), ["customer_id", "period"]),
    f"{base_sql('lines')} SELECT customer_id, period, " + ", ".join(f"round({c}, 6) AS {c}" for c in f.SELF) + f" FROM (SELECT customer_id, period, {_SELF} FROM feat WINDOW w AS (PARTITION BY customer_id ORDER BY period))",
)
_add("out_of_time_mask", lambda s, d: f.out_of_time(t.tx_lines(s, d).select("customer_id", rules.period()).distinct()), f"{t.sql_views('lines')}, c AS (SELECT DISTINCT customer_id, strftime(txn_ts, '%Y-%m') AS period FROM tx) SELECT customer_id, period, period IN (SELECT period FROM c GROUP BY 1 ORDER BY 1 DESC LIMIT 3) AS is_oot FROM c")


def _line_cells(spark: SparkSession, d: str) -> DataFrame:
    return t.tx_lines(spark, d).groupBy("customer_id", rules.period()).agg(rules.total(F.col("amount")).alias("total_amount"), F.count(F.lit(1)).alias("txn_count"))


def attach_labels(spark: SparkSession, d: str) -> DataFrame:
    c = _line_cells(spark, d)
    return f.attach_labels(c, t.cell_labels(c.where("period >= '1996-01'")))


_LC = f"SELECT customer_id, strftime(txn_ts, '%Y-%m') AS period, {_m()} AS total_amount, count(*) AS txn_count FROM tx GROUP BY 1, 2"
_add("attach_labels", attach_labels, f"{t.sql_views('lines')} SELECT customer_id, period, total_amount, txn_count, period >= '1996-01' AND {t.LABEL_EXPR} AS is_true FROM ({_LC})")
_add("split_by_customer", lambda s, d: f.split_by_customer(t.tx_lines(s, d)).groupBy("is_test").agg(F.count(F.lit(1)).alias("customers")), f"{t.sql_views('lines')}, n AS (SELECT count(DISTINCT customer_id) AS n FROM tx) SELECT true AS is_test, ceil(n * 0.25)::BIGINT AS customers FROM n UNION ALL SELECT false, n - ceil(n * 0.25)::BIGINT FROM n")


def scored(spark: SparkSession, d: str) -> DataFrame:
    """A deterministic score with many ties: the month's transaction count, then its money in thousands."""
    c = _line_cells(spark, d)
    month = F.substring("period", 6, 2).cast("int")
    return c.select("customer_id", "period", (F.floor(F.col("total_amount") / 1000) + F.col("txn_count") * 7).cast("double").alias("score"), ((F.col("customer_id") * 31 + month) % 7 == 0).alias("y"))


_SC = f"{t.sql_views('lines')}, sc AS MATERIALIZED (SELECT customer_id, period, floor(total_amount / 1000) + txn_count * 7 AS score, {t.LABEL_EXPR} AS y FROM ({_LC}))"
_STEPS = "SELECT score, count(*) AS n, count(*) FILTER (y) AS p FROM sc GROUP BY 1"
_add("roc_auc", lambda s, d: evaluate.roc_auc(scored(s, d)).select(F.round("roc_auc", 9).alias("roc_auc")), f"{_SC} SELECT round((sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0) / (count(*) FILTER (y) * count(*) FILTER (NOT y)), 9) AS roc_auc FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM sc)")
_add("average_precision", lambda s, d: evaluate.average_precision(scored(s, d)).select(F.round("average_precision", 9).alias("average_precision")), f"{_SC} SELECT round(sum(p * cp / cn) / sum(p), 9) AS average_precision FROM (SELECT p, sum(p) OVER (ORDER BY score DESC) AS cp, sum(n) OVER (ORDER BY score DESC) AS cn FROM ({_STEPS}))")
_POINT = """SELECT threshold, n AS alert_volume, k AS true_positives, n - k AS false_positives, round(k / pos, 9) AS recall, round(k / n, 9) AS precision, round(CASE WHEN k = 0 THEN 'inf'::DOUBLE ELSE (n - k) / k END, 9) AS fp_ratio
  FROM (SELECT min(score) AS threshold, count(*) AS n, count(*) FILTER (y) AS k, any_value(pos) AS pos FROM o WHERE i <= ({cut}))"""
_O = f"{_SC}, o AS MATERIALIZED (SELECT *, row_number() OVER w AS i, count(*) FILTER (y) OVER (w ROWS UNBOUNDED PRECEDING) AS cum, (SELECT count(*) FROM sc WHERE y) AS pos, (SELECT count(*) FROM sc) AS everything FROM sc WINDOW w AS (ORDER BY score DESC, customer_id, period))"


def _points(df: DataFrame) -> DataFrame:
    return df.select("threshold", "alert_volume", "true_positives", "false_positives", *(F.round(c, 9).alias(c) for c in ("recall", "precision", "fp_ratio")))


_add("op_at_recall", lambda s, d: _points(evaluate.at_recall(scored(s, d), 0.85, ["customer_id", "period"])), f"{_O} {_POINT.format(cut='SELECT min(i) FROM o WHERE cum / pos >= 0.85')}")
_add("op_at_budget", lambda s, d: _points(evaluate.at_budget(scored(s, d), 0.05, ["customer_id", "period"])), f"{_O} {_POINT.format(cut='SELECT greatest(1, round_even(0.05 * any_value(everything), 0)) FROM o')}")
_PCT = "(rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0) / count(*) OVER ()"
_add("pct_rank_average", lambda s, d: evaluate.percentile_rank(scored(s, d), "score").select("customer_id", "period", F.round("pct_rank", 9).alias("pct_rank")), f"{_SC} SELECT customer_id, period, round({_PCT}, 9) AS pct_rank FROM sc")


def model_scores(spark: SparkSession, d: str) -> DataFrame:
    """(model, period, score, y): three deterministic scores of every line cell."""
    c = scored(spark, d).join(_line_cells(spark, d).select("customer_id", "period", "total_amount"), ["customer_id", "period"])
    three = {"count_and_amount": F.col("score"), "amount": F.floor(F.col("total_amount") / 500).cast("double"), "customer": (F.col("customer_id") * 31 % 97).cast("double")}
    each = F.explode(F.array(*(F.struct(F.lit(m).alias("model"), x.alias("score")) for m, x in three.items())))
    return c.select("period", "y", each.alias("e")).select("e.model", "period", "e.score", "y")


def _report(df: DataFrame) -> DataFrame:
    return df.select("model", "slice", "rows", "positives", F.round("roc_auc", 9).alias("roc_auc"), F.round("average_precision", 9).alias("average_precision"), "best")


_MODELS = f"""{_SC}, cells AS (SELECT sc.*, floor(total_amount / 500) AS amount FROM sc JOIN ({_LC}) USING (customer_id, period)),
ms AS (SELECT 'count_and_amount' AS model, period, score, y FROM cells UNION ALL SELECT 'amount', period, amount, y FROM cells UNION ALL SELECT 'customer', period, customer_id * 31 % 97, y FROM cells),
sl AS MATERIALIZED (SELECT model, 'test' AS slice, score, y FROM ms UNION ALL SELECT model, 'out_of_time', score, y FROM ms WHERE period IN (SELECT DISTINCT period FROM ms ORDER BY 1 DESC LIMIT {{months}})),
au AS (SELECT model, slice, count(*) AS rows, count(*) FILTER (y) AS positives, (sum(r) FILTER (y) - positives * (positives + 1) / 2.0) / (positives * (rows - positives)) AS auc FROM (
  SELECT *, rank() OVER (PARTITION BY model, slice ORDER BY score) + (count(*) OVER (PARTITION BY model, slice, score) - 1) / 2.0 AS r FROM sl) GROUP BY 1, 2),
ap AS (SELECT model, slice, sum(p * cp / cn) / sum(p) AS ap FROM (SELECT *, sum(p) OVER w AS cp, sum(n) OVER w AS cn FROM (SELECT model, slice, score, count(*) AS n, count(*) FILTER (y) AS p FROM sl GROUP BY ALL)
  WINDOW w AS (PARTITION BY model, slice ORDER BY score DESC)) GROUP BY 1, 2)
SELECT model, slice, rows, positives, CASE WHEN slice = 'test' OR positives >= {{least}} THEN round(auc, 9) END AS roc_auc, CASE WHEN slice = 'test' OR positives >= {{least}} THEN round(ap, 9) END AS average_precision,
  model = (SELECT model FROM ap WHERE slice = 'test' ORDER BY ap DESC, model LIMIT 1) AS best FROM au JOIN ap USING (model, slice)"""
_add("out_of_time_report", lambda s, d: _report(evaluate.out_of_time_report(model_scores(s, d), 3)), _MODELS.format(months=3, least=5))
_add("out_of_time_thin", lambda s, d: _report(evaluate.out_of_time_report(model_scores(s, d), 1, 10**9)), _MODELS.format(months=1, least=10**9))


def separability(spark: SparkSession, d: str) -> DataFrame:
    k = scored(spark, d).withColumn("kind", F.when(F.col("y"), "anomaly").when(F.col("customer_id") % 5 == 0, "near_miss").otherwise("background"))
    out = evaluate.separability(k)
    return out.select("kind", F.round("mean_percentile", 9).alias("mean_percentile"), F.round("roc_auc", 9).alias("roc_auc"), "separable")


_auc = lambda k: f"(SELECT (sum(r) FILTER (y) - count(*) FILTER (y) * (count(*) FILTER (y) + 1) / 2.0) / (count(*) FILTER (y) * count(*) FILTER (NOT y)) FROM (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM kd WHERE kind IN ('anomaly', '{k}')))"
_add(
    "separability", separability,
    f"""{_SC}, kd AS MATERIALIZED (SELECT *, CASE WHEN y THEN 'anomaly' WHEN customer_id % 5 = 0 THEN 'near_miss' ELSE 'background' END AS kind FROM sc),
p AS (SELECT kind, avg(pr) AS mp FROM (SELECT kind, {_PCT} AS pr FROM kd) GROUP BY 1), a AS (SELECT kind, mp, CASE kind WHEN 'near_miss' THEN {_auc('near_miss')} WHEN 'background' THEN {_auc('background')} END AS auc FROM p)
SELECT kind, round(mp, 9) AS mean_percentile, round(auc, 9) AS roc_auc, abs(auc - 0.5) > 0.08 AS separable FROM a""",
)
