"""Monitoring scenarios at customer-month grain.

Each rule is a function of canonical transactions, customers and risk tiers that returns its
candidates: (customer_id, period, metric_value double, alert_amount double, txn_count bigint), gated by
every predicate but the swept one, which always is ``metric_value >= parameter``. A rule fires by one
more filter; a sweep filters the same candidates by many values in one pass. Parameters are
literals, so they fold and push down. Money is summed as decimals: exact, and equal in any order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.config import Scenario, scenarios
from sablefin.operators.quantile import exact_quantiles
from sablefin.session import settle, spread
from sablefin.sources.tables import union_all

OUTPUT = ("rule_id", "customer_id", "period", "metric_value", "alert_amount", "txn_count")


def period(ts: str = "txn_ts") -> Column:
    return F.date_format(ts, "yyyy-MM").alias("period")


def money(x: Column) -> Column:
    return x.cast("decimal(18,2)")


def total(x: Column) -> Column:
    return F.sum(money(x)).cast("double")


def _micros(ts: str = "txn_ts") -> Column:
    return F.unix_micros(ts)


def _day(ts: str = "txn_ts") -> Column:
    return F.datediff(F.col(ts), F.lit("1970-01-01")).cast("long")


def structuring(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Cash credits just under the reporting limit: pairs of an anchor and itself or a later one less
    than ``window_days`` calendar days on, by the anchor's month.

    No self-join: the pairs of a day's anchors are its rows times those of the days in reach, less the pairs within the day
    that run backwards. Rows meet by customer and day, so one customer's rows are spread over as many tasks as they have days;
    only a row a day is windowed by customer.
    """
    banded = tx.where((F.col("channel") == "CASH") & (F.col("direction") == "CREDIT") & F.col("amount").between(p["lower_bound"], p["upper_bound"]))
    banded = banded.select("customer_id", period(), money(F.col("amount")).alias("amt"), _micros().alias("us"), _day().alias("day"))
    past = Window.partitionBy("customer_id", "day").orderBy("us").rangeBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("decimal(18,2)")
    inside = banded.select("customer_id", "period", "day", "amt", F.count(F.lit(1)).over(past).alias("_n"), F.coalesce(F.sum("amt").over(past), zero).alias("_s"))
    days = inside.groupBy("customer_id", "day").agg(
        F.first("period").alias("period"), F.count(F.lit(1)).alias("k"), F.sum("amt").alias("a"), F.sum("_n").alias("_n"), F.sum("_s").cast("decimal(28,2)").alias("_s")
    )
    reach = Window.partitionBy("customer_id").orderBy("day").rangeBetween(0, int(p["window_days"]) - 1)  # a row a day: short frames
    pairs = days.select(
        "customer_id", "period", (F.col("k") * F.sum("k").over(reach) - F.col("_n")).alias("n"),
        (F.col("k").cast("decimal(10,0)") * F.sum("a").over(reach).cast("decimal(26,2)") - F.col("_s")).alias("s"),
    )
    out = pairs.groupBy("customer_id", "period").agg(F.sum("n").alias("n"), F.sum("s").cast("double").alias("s"))
    return out.select("customer_id", "period", F.col("n").cast("double").alias("metric_value"), F.col("s").alias("alert_amount"), F.col("n").alias("txn_count"))


def structuring_selfjoin(tx: DataFrame, p: dict[str, float]) -> DataFrame:
    """The same candidates by the naive self-join, to cross-check the window form."""
    b = tx.where((F.col("channel") == "CASH") & (F.col("direction") == "CREDIT") & F.col("amount").between(p["lower_bound"], p["upper_bound"])).select("customer_id", "txn_ts", "amount")
    later = b.select(F.col("customer_id").alias("c2"), F.col("txn_ts").alias("ts2"), F.col("amount").alias("amount2"))
    near = (F.col("customer_id") == F.col("c2")) & (F.col("ts2") >= F.col("txn_ts")) & (F.datediff("ts2", "txn_ts") < int(p["window_days"]))
    out = b.join(later, near).groupBy("customer_id", period()).agg(F.count(F.lit(1)).alias("txn_count"), total(F.col("amount2")).alias("alert_amount"))
    return out.select("customer_id", "period", F.col("txn_count").cast("double").alias("metric_value"), "alert_amount", "txn_count")


def velocity(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Credits whose amount leaves again within ``max_hold_hours``: share of credited money matched by
    debits after each credit, capped at the credit.

    Equal credits at one instant count once, with the debits of each. No range join: debits in the
    hold window are a difference of two growing frames. Rows meet by customer and stretch of two holds; debits of a stretch's first
    hold are seen from the stretch before, too, so one customer's rows are spread over as many tasks as there are stretches.
    """
    hold = int(p["max_hold_hours"]) * 3_600_000_000
    width = max(2 * hold, 1)
    debit = F.when(F.col("direction") == "DEBIT", money(F.col("amount"))).otherwise(F.lit(0).cast("decimal(18,2)"))
    credit = (F.col("direction") == "CREDIT") & (F.col("amount") >= p["min_amount"])
    base = tx.where(credit | (F.col("direction") == "DEBIT")).select("customer_id", period(), "txn_ts", "amount", credit.alias("_credit"), debit.alias("debit"), _micros().alias("us"))
    into = F.expr(f"pmod(us, {width})")
    own = F.expr(f"(us - pmod(us, {width})) div {width}")
    seen = F.explode(F.when(~F.col("_credit") & (into <= hold), F.array(own, own - 1)).otherwise(F.array(own))).alias("stretch")
    w = Window.partitionBy("customer_id", "stretch").orderBy("us")
    inside = F.sum("debit").over(w.rangeBetween(Window.unboundedPreceding, hold)) - F.sum("debit").over(w.rangeBetween(Window.unboundedPreceding, 0))
    credits = base.select("*", seen).withColumn("out", inside).where("_credit")
    # the stretch follows from the instant: grouping by it, too, needs no further shuffle
    one = credits.groupBy("customer_id", "stretch", "period", "txn_ts", "amount").agg(F.sum("out").alias("out"))
    month = one.groupBy("customer_id", "period").agg(
        total(F.col("amount")).alias("credited"), total(F.least(F.col("out").cast("decimal(18,2)"), money(F.col("amount")))).alias("passed"), F.count(F.lit(1)).alias("txn_count")
    )
    return month.where("credited > 0").select("customer_id", "period", (F.col("passed") / F.col("credited")).alias("metric_value"), F.col("passed").alias("alert_amount"), "txn_count")


def velocity_join(tx: DataFrame, p: dict[str, float]) -> DataFrame:
    """The same candidates by the left interval join, to cross-check the window form."""
    c = tx.where((F.col("direction") == "CREDIT") & (F.col("amount") >= p["min_amount"]))
    c = c.select("customer_id", period(), "txn_ts", "amount", (F.col("txn_ts") + F.make_dt_interval(F.lit(0), F.lit(int(p["max_hold_hours"])))).alias("until"))
    d = tx.where("direction = 'DEBIT'").select(F.col("customer_id").alias("c2"), F.col("txn_ts").alias("ts2"), money(F.col("amount")).alias("debit"))
    on = (F.col("customer_id") == F.col("c2")) & (F.col("ts2") > F.col("txn_ts")) & (F.col("ts2") <= F.col("until"))
    one = c.join(d, on, "left").groupBy("customer_id", "period", "txn_ts", "amount").agg(F.coalesce(F.sum("debit"), F.lit(0)).cast("decimal(18,2)").alias("out"))
    month = one.groupBy("customer_id", "period").agg(total(F.col("amount")).alias("credited"), total(F.least("out", money(F.col("amount")))).alias("passed"), F.count(F.lit(1)).alias("txn_count"))
    return month.where("credited > 0").select("customer_id", "period", (F.col("passed") / F.col("credited")).alias("metric_value"), F.col("passed").alias("alert_amount"), "txn_count")


def round_dollar(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Share of transfers whose amount is a multiple of ``round_unit`` (1000)."""
    unit = p.get("round_unit", 1000.0)
    whole = F.col("amount") == F.round(F.col("amount") / unit) * unit
    some = tx.where((F.col("amount") >= p["min_amount"]) & F.col("channel").isin("WIRE", "ACH"))
    out = some.groupBy("customer_id", period()).agg(
        F.sum(whole.cast("long")).alias("k"), F.coalesce(total(F.when(whole, F.col("amount"))), F.lit(0.0)).alias("alert_amount"), F.count(F.lit(1)).alias("txn_count")
    )
    out = out.where(F.col("txn_count") >= p["min_txn_count"])
    return out.select("customer_id", "period", (F.col("k") / F.col("txn_count")).alias("metric_value"), "alert_amount", "txn_count")


def dormant(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Months with a transaction after ``dormancy_days`` of silence; all of the month's money counts.

    Silence is counted in days, so transactions fold to a row a customer and day before days are compared: no task sorts all of a
    customer's transactions. The join of marked months back to their transactions is a maximum in the month's own aggregate.
    """
    each = tx.select("customer_id", F.to_date("txn_ts").alias("day"), money(F.col("amount")).alias("s"))
    days = spread(each, "customer_id", "day").groupBy("customer_id", "day").agg(F.sum("s").alias("s"), F.count(F.lit(1)).alias("k"))
    days = spread(days, "customer_id")
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("customer_id").orderBy("day")))
    g = days.select("customer_id", period("day"), "s", "k", gap.alias("gap"))
    out = g.groupBy("customer_id", "period").agg(F.sum("s").cast("double").alias("s"), F.sum("k").alias("txn_count"), F.max("gap").alias("gap"))
    out = out.where((F.col("gap") >= p["dormancy_days"]) & (F.col("txn_count") >= p["min_reactivation_txns"]))
    return out.select("customer_id", "period", F.col("s").alias("metric_value"), F.col("s").alias("alert_amount"), "txn_count")


def new_account(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Volume in the first ``account_age_days`` of an account."""
    age = F.datediff("txn_ts", "account_open_date")
    early = tx.join(cust.select("customer_id", "account_open_date"), "customer_id").where(age.between(0, int(p["account_age_days"])))
    out = early.groupBy("customer_id", period()).agg(total(F.col("amount")).alias("s"), F.count(F.lit(1)).alias("txn_count")).where(F.col("txn_count") >= p["min_txn_count"])
    return out.select("customer_id", "period", F.col("s").alias("metric_value"), F.col("s").alias("alert_amount"), "txn_count")


def concentration(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Share of the largest counterparty in all money with a known counterparty."""
    by = tx.where(F.col("counterparty").isNotNull()).groupBy("customer_id", period(), "counterparty").agg(F.sum(money(F.col("amount"))).alias("s"), F.count(F.lit(1)).alias("n"))
    out = by.groupBy("customer_id", "period").agg(F.sum("s").cast("double").alias("all"), F.max("s").cast("double").alias("top"), F.sum("n").alias("txn_count"))
    out = out.where((F.col("txn_count") >= p["min_txn_count"]) & (F.col("all") >= p["min_total_amount"]))
    return out.select("customer_id", "period", (F.col("top") / F.nullif("all", F.lit(0.0))).alias("metric_value"), F.col("top").alias("alert_amount"), "txn_count")


def corridor(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Share of money that goes to or comes from high-risk countries."""
    high = risk.where("tier = 'HIGH'").select("country_key", F.lit(1).alias("hit"))
    s = tx.join(high, "country_key", "left")
    out = s.groupBy("customer_id", period()).agg(
        F.coalesce(total(F.when(F.col("hit") == 1, F.col("amount"))), F.lit(0.0)).alias("s"), total(F.col("amount")).alias("all"), F.count("hit").alias("txn_count")
    )
    out = out.where((F.col("txn_count") >= p["min_txn_count"]) & (F.col("s") >= p["min_corridor_amount"]))
    return out.select("customer_id", "period", (F.col("s") / F.nullif("all", F.lit(0.0))).alias("metric_value"), F.col("s").alias("alert_amount"), "txn_count")


def cash_intensity(tx: DataFrame, cust: DataFrame, risk: DataFrame, p: dict[str, float]) -> DataFrame:
    """Cash share of a month, no less than the upper quartile of its segment's months."""
    s = tx.join(cust.select("customer_id", "behaviour_segment"), "customer_id")
    month = s.groupBy("customer_id", "behaviour_segment", period()).agg(
        F.coalesce(total(F.when(F.col("channel") == "CASH", F.col("amount"))), F.lit(0.0)).alias("cash"), total(F.col("amount")).alias("all"), F.count(F.lit(1)).alias("txn_count")
    )
    month = month.withColumn("share", F.col("cash") / F.nullif("all", F.lit(0.0)))
    month = settle(month, "cash-months")  # a row per customer-month, read three times
    peer = exact_quantiles(month, ["behaviour_segment"], ["share"], 0.75).withColumnRenamed("q_share", "p75")
    out = month.join(peer, "behaviour_segment").where((F.col("txn_count") >= p["min_txn_count"]) & (F.col("cash") >= p["min_cash_amount"]) & (F.col("share") >= F.col("p75")))
    return out.select("customer_id", "period", F.col("share").alias("metric_value"), F.col("cash").alias("alert_amount"), "txn_count")


Rule = Callable[[DataFrame, DataFrame, DataFrame, dict[str, float]], DataFrame]
RULES: dict[str, Rule] = {
    "R01_STRUCTURING": structuring, "R02_VELOCITY": velocity, "R03_ROUND_DOLLAR": round_dollar, "R04_DORMANT_REACTIVATION": dormant,
    "R05_NEW_ACCOUNT_BURST": new_account, "R06_COUNTERPARTY_CONCENTRATION": concentration, "R07_HIGH_RISK_CORRIDOR": corridor, "R08_CASH_INTENSITY": cash_intensity,
}


class RuleError(ValueError):
    """A rule is unknown or its result breaks the contract."""


def candidates(scenario: Scenario, tx: DataFrame, cust: DataFrame, risk: DataFrame) -> DataFrame:
    if scenario.rule_id not in RULES:
        raise RuleError(f"unknown rule {scenario.rule_id}; known: {', '.join(RULES)}")
    return RULES[scenario.rule_id](tx, cust, risk, scenario.params)


def run_rule(scenario: Scenario, tx: DataFrame, cust: DataFrame, risk: DataFrame) -> DataFrame:
    """Alerts of one rule: OUTPUT columns. Order is the sink's business, not the plan's."""
    got = candidates(scenario, tx, cust, risk).where(F.col("metric_value") >= scenario.params[scenario.sweep_param])
    out = got.select(F.lit(scenario.rule_id).alias("rule_id"), "customer_id", "period", "metric_value", "alert_amount", "txn_count")
    if tuple(out.columns) != OUTPUT:
        raise RuleError(f"{scenario.rule_id} returned {out.columns}")
    return out


def run_all(tx: DataFrame, cust: DataFrame, risk: DataFrame, some: dict[str, Scenario] | None = None) -> DataFrame:
    """UNION ALL of all rules' alerts."""
    return union_all([run_rule(s, tx, cust, risk) for s in (some or scenarios()).values()])
