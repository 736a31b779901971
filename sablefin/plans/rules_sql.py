"""Oracle SQL of the monitoring scenarios: the plain joins, over views tx, cust and risk."""

from __future__ import annotations

from sablefin.config import Scenario

_P = "strftime(txn_ts, '%Y-%m')"


def _m(x: str) -> str:
    return f"CAST(coalesce(SUM(CAST({x} AS DECIMAL(18,2))), 0) AS DOUBLE)"


def candidates_sql(s: Scenario) -> str:
    """SELECT of (customer_id, period, metric_value, alert_amount, txn_count), all gates but the swept one."""
    p = s.params
    n = s.rule_id[:3]
    if n == "R01":
        band = f"SELECT customer_id, txn_ts, amount FROM tx WHERE channel = 'CASH' AND direction = 'CREDIT' AND amount BETWEEN {p['lower_bound']} AND {p['upper_bound']}"
        return f"""SELECT customer_id, period, n::DOUBLE AS metric_value, s AS alert_amount, n AS txn_count FROM (
  SELECT a.customer_id, strftime(a.txn_ts, '%Y-%m') AS period, count(*) AS n, {_m("b.amount")} AS s FROM ({band}) a JOIN ({band}) b
    ON b.customer_id = a.customer_id AND b.txn_ts >= a.txn_ts AND date_diff('day', a.txn_ts, b.txn_ts) < {int(p["window_days"])} GROUP BY 1, 2)"""
    if n == "R02":
        return f"""SELECT customer_id, period, passed / credited AS metric_value, passed AS alert_amount, txn_count FROM (
  SELECT customer_id, period, {_m("amount")} AS credited, {_m("least(gone, amount)")} AS passed, count(*) AS txn_count FROM (
    SELECT c.customer_id, strftime(c.txn_ts, '%Y-%m') AS period, c.txn_ts, c.amount, {_m("d.amount")} AS gone
    FROM (SELECT * FROM tx WHERE direction = 'CREDIT' AND amount >= {p["min_amount"]}) c
    LEFT JOIN (SELECT * FROM tx WHERE direction = 'DEBIT') d ON d.customer_id = c.customer_id AND d.txn_ts > c.txn_ts AND d.txn_ts <= c.txn_ts + INTERVAL {int(p["max_hold_hours"])} HOUR
    GROUP BY 1, 2, 3, 4) GROUP BY 1, 2) WHERE credited > 0"""
    if n == "R03":
        unit = p.get("round_unit", 1000.0)
        whole = f"amount = round(amount / {unit}) * {unit}"
        return f"""SELECT customer_id, {_P} AS period, count(*) FILTER ({whole})::DOUBLE / count(*) AS metric_value, {_m(f"CASE WHEN {whole} THEN amount END")} AS alert_amount, count(*) AS txn_count
  FROM tx WHERE amount >= {p["min_amount"]} AND channel IN ('WIRE', 'ACH') GROUP BY 1, 2 HAVING count(*) >= {p["min_txn_count"]}"""
    if n == "R04":
        return f"""SELECT g.customer_id, g.period, {_m("amount")} AS metric_value, {_m("amount")} AS alert_amount, count(*) AS txn_count
  FROM (SELECT customer_id, {_P} AS period, amount, date_diff('day', lag(txn_ts) OVER (PARTITION BY customer_id ORDER BY txn_ts), txn_ts) AS gap FROM tx) g
  GROUP BY 1, 2 HAVING max(gap) >= {p["dormancy_days"]} AND count(*) >= {p["min_reactivation_txns"]}"""
    if n == "R05":
        return f"""SELECT customer_id, {_P} AS period, {_m("amount")} AS metric_value, {_m("amount")} AS alert_amount, count(*) AS txn_count FROM tx JOIN cust USING (customer_id)
  WHERE date_diff('day', account_open_date, txn_ts) BETWEEN 0 AND {p["account_age_days"]} GROUP BY 1, 2 HAVING count(*) >= {p["min_txn_count"]}"""
    if n == "R06":
        return f"""SELECT customer_id, period, top / nullif(s, 0) AS metric_value, top AS alert_amount, n::BIGINT AS txn_count FROM (
  SELECT customer_id, period, sum(s) AS s, max(s) AS top, sum(n) AS n FROM (
    SELECT customer_id, {_P} AS period, counterparty, {_m("amount")} AS s, count(*) AS n FROM tx WHERE counterparty IS NOT NULL GROUP BY 1, 2, 3) GROUP BY 1, 2)
  WHERE n >= {p["min_txn_count"]} AND s >= {p["min_total_amount"]}"""
    if n == "R07":
        return f"""SELECT customer_id, period, s / nullif(everything, 0) AS metric_value, s AS alert_amount, k AS txn_count FROM (
  SELECT customer_id, {_P} AS period, {_m("CASE WHEN tier = 'HIGH' THEN amount END")} AS s, {_m("amount")} AS everything, count(*) FILTER (tier = 'HIGH') AS k
  FROM tx LEFT JOIN risk USING (country_key) GROUP BY 1, 2) WHERE k >= {p["min_txn_count"]} AND s >= {p["min_corridor_amount"]}"""
    if n == "R08":
        return f"""SELECT customer_id, period, share AS metric_value, cash AS alert_amount, n AS txn_count FROM (
  SELECT *, quantile_cont(share, 0.75) OVER (PARTITION BY behaviour_segment) AS p75 FROM (
    SELECT customer_id, behaviour_segment, period, cash, n, cash / nullif(s, 0) AS share FROM (
      SELECT customer_id, behaviour_segment, {_P} AS period, {_m("CASE WHEN channel = 'CASH' THEN amount END")} AS cash, {_m("amount")} AS s, count(*) AS n
      FROM tx JOIN cust USING (customer_id) GROUP BY 1, 2, 3)))
  WHERE n >= {p["min_txn_count"]} AND cash >= {p["min_cash_amount"]} AND share >= p75"""
    raise KeyError(s.rule_id)


def rule_sql(s: Scenario) -> str:
    return f"SELECT '{s.rule_id}' AS rule_id, * FROM ({candidates_sql(s)}) WHERE metric_value >= {s.params[s.sweep_param]}"
