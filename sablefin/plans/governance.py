"""Queries over controls, validation, fingerprints, audit and the alert queue, with oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.operators import audit, data_quality as dq
from sablefin.operators.screening import transaction_flags
from sablefin.plans.monitoring import all_alerts_union, tuned
from sablefin.plans.rules_sql import rule_sql
from sablefin.plans.service import number_alerts, page
from sablefin.sources import tables as t

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
START, END = "2024-01-02", "2024-01-28"


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def controlled(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Customers, transactions and watchlist as the controls see them. Lines aren't unique by order and number,
    which gives the uniqueness control something to find; country codes are the first letters of nations."""
    n = t.read_table(spark, d, "nation").select(F.col("n_nationkey").alias("country_key"), F.when(F.col("n_nationkey") % 9 == 0, F.lower(F.substring("n_name", 1, 2))).otherwise(F.substring("n_name", 1, 2)).alias("country"))
    tx = t.tx_events(spark, d).join(F.broadcast(n), "country_key", "left")  # a row per country
    watch = t.read_table(spark, d, "part").select(F.when(F.col("p_partkey") % 97 != 0, F.col("p_name")).otherwise(F.lit("  ")).alias("primary_name"))
    cust = t.event_customers(spark, d).where("customer_id % 40 <> 3").withColumn("account_open_date", F.date_add("account_open_date", F.when(F.col("customer_id") % 30 == 0, 60).otherwise(0)).cast("timestamp"))
    return cust, tx, watch


_NAT = "SELECT n_nationkey AS country_key, CASE WHEN n_nationkey % 9 = 0 THEN lower(n_name[1:2]) ELSE n_name[1:2] END AS country FROM nation"
_VIEWS = f"""{t.sql_views()}, nat AS ({_NAT}), ctx AS MATERIALIZED (SELECT tx.*, country FROM tx LEFT JOIN nat USING (country_key)),
watch AS (SELECT CASE WHEN p_partkey % 97 <> 0 THEN p_name ELSE '  ' END AS primary_name FROM part),
ccust AS (SELECT customer_id, account_open_date + INTERVAL (CASE WHEN customer_id % 30 = 0 THEN 60 ELSE 0 END) DAY AS account_open_date FROM cust WHERE customer_id % 40 <> 3)"""
_CHECKS = {
    "DQ01_CUSTOMER_PK_UNIQUE": "SELECT count(*) FROM (SELECT customer_id FROM ccust GROUP BY 1 HAVING count(*) > 1)",
    "DQ02_TXN_PK_UNIQUE": "SELECT count(*) FROM (SELECT txn_id FROM ctx GROUP BY 1 HAVING count(*) > 1)",
    "DQ03_TXN_CUSTOMER_FK": "SELECT count(*) FROM ctx WHERE customer_id NOT IN (SELECT customer_id FROM ccust)",
    "DQ04_MANDATORY_NULLS": "SELECT count(*) FROM ctx WHERE txn_ts IS NULL OR amount IS NULL OR channel IS NULL OR direction IS NULL",
    "DQ05_AMOUNT_RANGE": "SELECT count(*) FROM ctx WHERE NOT (amount > 0 AND amount <= 50000000)",
    "DQ06_TXN_DATE_WINDOW": f"SELECT count(*) FROM ctx WHERE NOT (txn_ts >= TIMESTAMP '{START}' AND txn_ts < TIMESTAMP '{END}')",
    "DQ07_CHANNEL_DOMAIN": "SELECT count(*) FROM ctx WHERE channel NOT IN ('WIRE', 'ACH', 'CARD', 'CASH') OR direction NOT IN ('CREDIT', 'DEBIT')",
    "DQ08_COUNTRY_CODE_FORMAT": "SELECT count(*) FROM ctx WHERE country IS NOT NULL AND NOT regexp_full_match(country, '[A-Z]{2}')",
    "DQ09_WATCHLIST_NAME_PRESENT": "SELECT count(*) FROM watch WHERE coalesce(length(trim(primary_name)), 0) = 0",
    "DQ10_ACCOUNT_OPEN_BEFORE_TXN": "SELECT count(*) FROM ctx JOIN ccust USING (customer_id) WHERE txn_ts < account_open_date",
}


def dq_report(spark: SparkSession, d: str) -> DataFrame:
    return dq.run_controls(*controlled(spark, d), START, END)


def _one(name: str) -> str:
    _, dim, sev = next(c for c in dq.CONTROLS if c[0] == name)
    return f"SELECT '{name}' AS check_id, '{dim}' AS dimension, '{sev}' AS severity, ({_CHECKS[name]}) AS failing_rows"


_REPORT = " UNION ALL ".join(_one(n) for n in _CHECKS)
_add("dq_report", dq_report, f"{_VIEWS} SELECT *, CASE WHEN failing_rows = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({_REPORT})")


def _single(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        cust, tx, watch = controlled(spark, d)
        plans = {
            "DQ01_CUSTOMER_PK_UNIQUE": lambda: dq.duplicates(cust, ["customer_id"]), "DQ02_TXN_PK_UNIQUE": lambda: dq.duplicates(tx, ["txn_id"]), "DQ03_TXN_CUSTOMER_FK": lambda: dq.orphans(tx, cust, "customer_id"),
            "DQ09_WATCHLIST_NAME_PRESENT": lambda: dq.failing(watch, failing=F.col("primary_name").isNull() | (F.length(F.trim("primary_name")) == 0)),
            "DQ10_ACCOUNT_OPEN_BEFORE_TXN": lambda: dq.failing(tx.join(cust.select("customer_id", "account_open_date"), "customer_id"), failing=F.col("txn_ts") < F.col("account_open_date")),
        }
        got = plans[name]() if name in plans else dq.failing(tx, failing=dq.column_tests(START, END)[name])
        return got.select(F.lit(name).alias("check_id"), F.col("failing").alias("failing_rows"))

    return run


for _n in _CHECKS:
    _add("dq_" + _n[:4].lower(), _single(_n), f"{_VIEWS} SELECT '{_n}' AS check_id, ({_CHECKS[_n]}) AS failing_rows")

LINE_SPECS = [
    dq.ColumnSpec("l_orderkey", "bigint", False), dq.ColumnSpec("l_linenumber", "int", False, minimum=1, maximum=7), dq.ColumnSpec("l_quantity", "double", False, minimum=2, maximum=49),
    dq.ColumnSpec("l_returnflag", "string", False, allowed=("A", "N")), dq.ColumnSpec("l_discount", "double", True, maximum=0.09),
]


def schema_violations(spark: SparkSession, d: str) -> DataFrame:
    lines = t.read_table(spark, d, "lineitem").select(*(s.name for s in LINE_SPECS))
    return dq.violations(lines, LINE_SPECS, ["l_orderkey", "l_linenumber"])


_add(
    "schema_violations", schema_violations,
    """SELECT * FROM (SELECT 'l_linenumber' AS "column", 'minimum' AS "check", count(*) FILTER (l_linenumber < 1) AS failing FROM lineitem UNION ALL
  SELECT 'l_linenumber', 'maximum', count(*) FILTER (l_linenumber > 7) FROM lineitem UNION ALL SELECT 'l_quantity', 'minimum', count(*) FILTER (l_quantity < 2) FROM lineitem UNION ALL
  SELECT 'l_quantity', 'maximum', count(*) FILTER (l_quantity > 49) FROM lineitem UNION ALL SELECT 'l_returnflag', 'domain', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem UNION ALL
  SELECT 'l_discount', 'maximum', count(*) FILTER (l_discount > 0.09) FROM lineitem UNION ALL
  SELECT 'l_orderkey,l_linenumber', 'key', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)) WHERE failing > 0""",
)
_add("fingerprint", lambda s, d: dq.fingerprint(t.read_table(s, d, "lineitem")))
_FLAGS = """SELECT txn_id, concat_ws(',', CASE WHEN amount >= 10000 THEN 'CTR_REPORTABLE' WHEN channel = 'CASH' AND amount BETWEEN 8200 AND 9900 THEN 'NEAR_CTR_CASH' END,
  CASE WHEN tier = 'HIGH' THEN 'HIGH_RISK_CORRIDOR' END, CASE WHEN channel IN ('WIRE', 'ACH') AND amount >= 1000 AND amount = round(amount / 1000.0) * 1000.0 THEN 'ROUND_VALUE' END) AS flags, tier = 'HIGH' AS high FROM tx LEFT JOIN risk USING (country_key)"""
_add("txn_flags", lambda s, d: transaction_flags(t.tx_events(s, d), t.risk_tiers(s, d)), f"{t.sql_views()} {_FLAGS}")
_add(
    "requires_review", lambda s, d: transaction_flags(t.tx_events(s, d), t.risk_tiers(s, d)).groupBy(F.col("high").alias("requires_review")).agg(F.count(F.lit(1)).alias("n")),
    f"{t.sql_views()} SELECT high AS requires_review, count(*) AS n FROM ({_FLAGS}) GROUP BY 1",
)


def alerts_page(spark: SparkSession, d: str) -> DataFrame:
    """Second page of the alert queue."""
    a = all_alerts_union(spark, d)
    q = a.select(F.concat_ws("/", "rule_id", "customer_id", "period").alias("alert_id"), "rule_id", F.col("alert_amount").alias("score"))
    return page(q, limit=25, offset=25)


_UNION = " UNION ALL ".join(f"({rule_sql(s)})" for s in tuned().values())
_add("alerts_page", alerts_page, f"{t.sql_views()} SELECT rule_id || '/' || customer_id || '/' || period AS alert_id, rule_id, alert_amount AS score FROM ({_UNION}) ORDER BY score DESC, alert_id LIMIT 25 OFFSET 25")


def alert_ids(spark: SparkSession, d: str) -> DataFrame:
    """All alerts with the ids the queue gives them."""
    a = number_alerts(all_alerts_union(spark, d), "TM", ["customer_id", "period", "rule_id"])
    return a.select("alert_id", "customer_id", "period", "rule_id")


_add("alert_ids", alert_ids, f"{t.sql_views()} SELECT printf('TM-%07d', row_number() OVER (ORDER BY customer_id, period, rule_id)) AS alert_id, customer_id, period, rule_id FROM ({_UNION})")


def audit_chain(spark: SparkSession, d: str) -> DataFrame:
    """All alerts as chained audit records."""
    a = all_alerts_union(spark, d)
    events = a.select(
        F.col("customer_id").cast("string").alias("subject_id"), F.concat(F.last_day(F.to_date(F.concat("period", F.lit("-01")))).cast("string"), F.lit("T00:00:00Z")).alias("occurred_at"),
        F.lit("REVIEW").alias("decision"), F.to_json(F.struct("rule_id", "period", "txn_count")).alias("snapshot"), F.to_json(F.struct("metric_value", "alert_amount")).alias("breakdown"), "rule_id", "customer_id", "period",
    )
    return audit.build(events, ["customer_id", "period", "rule_id"], "monitoring-v1", "TM_ALERT")


_add("audit_chain", audit_chain)


def audit_verify(spark: SparkSession, d: str) -> DataFrame:
    """One row: records and breaks found by the parallel verification."""
    records = audit_chain(spark, d)
    return records.agg(F.count(F.lit(1)).alias("records")).crossJoin(audit.breaks(records).agg(F.count(F.lit(1)).alias("breaks")))


_add("audit_verify", audit_verify, f"{t.sql_views()} SELECT count(*) AS records, 0::BIGINT AS breaks FROM ({_UNION})")
_add("audit_summary", lambda s, d: audit.summary(audit_chain(s, d)), f"{t.sql_views()} SELECT 'TM_ALERT' AS event_type, 'REVIEW' AS decision, count(*) AS records FROM ({_UNION})")
_add("manifest", lambda s, d: audit.manifest_of(s, d))
