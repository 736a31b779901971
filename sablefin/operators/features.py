"""Customer-month features, fitted baselines, self-relative windows, splits.

The transactions are shuffled once, by customer: the gap window, the per-counterparty totals and the
monthly aggregate all group by supersets of that key, so Spark adds no further exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.config import Monitoring
from sablefin.operators.ordering import kth, upto
from sablefin.operators.quantile import exact_quantiles
from sablefin.operators.rules import money, period
from sablefin.session import settle, spread

PEER = ("total_amount", "txn_count", "max_amount", "avg_amount", "cash_amount", "high_risk_amount", "distinct_counterparties")
SHRUNK = (
    "cash_share", "cash_txn_share", "wire_share", "card_share", "credit_share", "near_ctr_share", "round_share", "cross_border_share", "high_risk_share",
    "medium_risk_share", "top_counterparty_share", "night_share", "weekend_share", "passthrough_ratio", "counterparty_diversity",
)
BASE = (
    "month_of_year", "txn_count", "total_amount", "avg_amount", "max_amount", "std_amount", "median_amount", "credit_amount", "debit_amount", "credit_share",
    "passthrough_ratio", "cash_amount", "cash_share", "cash_txn_share", "wire_share", "card_share", "near_ctr_count", "near_ctr_share", "round_share", "ctr_count",
    "cross_border_share", "distinct_countries", "distinct_counterparties", "counterparty_diversity", "night_share", "weekend_share", "active_span_days",
    "high_risk_amount", "high_risk_share", "medium_risk_share", "high_risk_count", "top_counterparty_share", "max_gap_days", "account_age_days",
    "kyc_risk_ordinal", "is_pep", "nationality_high_risk",
)
#: Of these, counts, ordinals and sums of exact amounts: no float arithmetic behind their last bits.
EXACT = (
    "month_of_year", "txn_count", "total_amount", "max_amount", "credit_amount", "debit_amount", "cash_amount", "near_ctr_count", "ctr_count",
    "distinct_countries", "distinct_counterparties", "active_span_days", "high_risk_amount", "high_risk_count", "max_gap_days", "account_age_days",
    "kyc_risk_ordinal", "is_pep", "nationality_high_risk", "prior_month_amount", "is_first_active_month",
)
SELF = ("prior_month_amount", "amount_vs_prior", "count_vs_prior", "amount_vs_trailing_mean", "is_first_active_month")
KEY = ("customer_id", "period")


def _amount(test: Column | None = None) -> Column:
    """Sum of the exact amount ``_amt``, cast once a row and not once a sum."""
    v = F.col("_amt") if test is None else F.when(test, F.col("_amt"))
    return F.coalesce(F.sum(v).cast("double"), F.lit(0.0))


def _count(test: Column) -> Column:
    return F.sum(test.cast("long"))


def _ranks(rank: str) -> Column:
    return F.coalesce(F.max(rank), F.lit(0)).cast("long")


def monthly(tx: DataFrame, risk: DataFrame) -> DataFrame:
    """One row per active customer-month with everything that is a sum, extreme or quantile over its
    transactions, corridor money and gaps included. One exchange."""
    tx = spread(tx, "customer_id")
    gap = F.datediff("txn_ts", F.lag("txn_ts").over(Window.partitionBy("customer_id").orderBy("txn_ts")))
    t = tx.join(F.broadcast(risk.select("country_key", "tier")), "country_key", "left")  # a row per country
    t = t.withColumn("_amt", money(F.col("amount"))).withColumn("gap", gap).withColumn("period", period())
    # What sets and sorted values would gather into one buffer a month is marked on rows instead, by three windows over
    # the month's rows within the same partitions: a rank and the money of each counterparty, a rank of each country, the
    # place of each row by amount. Ranks count distinct values; nulls come last and are left out.
    cell = Window.partitionBy("customer_id", "period")
    by_cp, by_country, by_amount = (cell.orderBy(F.asc_nulls_last(c)) for c in ("counterparty", "country_key", "amount"))
    of_known = lambda key, c: F.when(F.col(key).isNotNull(), c)
    whole = by_amount.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    t = t.select(
        "*", of_known("counterparty", F.sum("_amt").over(by_cp.rangeBetween(Window.currentRow, Window.currentRow)).cast("double")).alias("_cp"),
        of_known("counterparty", F.dense_rank().over(by_cp)).alias("_cp_rank"), of_known("country_key", F.dense_rank().over(by_country)).alias("_country_rank"),
        F.row_number().over(by_amount).alias("_place"), F.count("amount").over(whole).alias("_known"),
    )
    middle = (F.col("_place") <= F.col("_known")) & F.abs(2 * F.col("_place") - F.col("_known") - 1).between(0, 1)
    hour, day, a = F.hour("txn_ts"), F.dayofweek("txn_ts"), F.col("amount")
    return t.groupBy("customer_id", "period").agg(
        F.count(F.lit(1)).alias("txn_count"), _amount().alias("total_amount"), F.max("amount").alias("max_amount"),
        F.coalesce(F.stddev_samp("amount"), F.lit(0.0)).alias("std_amount"), F.avg(F.when(middle, a)).alias("median_amount"),
        _amount(F.col("direction") == "CREDIT").alias("credit_amount"), _amount(F.col("direction") == "DEBIT").alias("debit_amount"), _count(F.col("direction") == "CREDIT").alias("credits"),
        _amount(F.col("channel") == "CASH").alias("cash_amount"), _count(F.col("channel") == "CASH").alias("cash_txns"),
        _amount(F.col("channel") == "WIRE").alias("wire_amount"), _amount(F.col("channel") == "CARD").alias("card_amount"),
        _count(a.between(7500, 9999.99)).alias("near_ctr_count"), _count(a == F.round(a / 1000.0) * 1000.0).alias("rounds"), _count(a >= 10000).alias("ctr_count"),
        _amount(F.col("is_cross_border")).alias("cross_border_amount"), _ranks("_country_rank").alias("distinct_countries"), _ranks("_cp_rank").alias("distinct_counterparties"),
        _count((hour < 7) | (hour >= 20)).alias("nights"), _count(day.isin(1, 7)).alias("weekends"), F.min("txn_ts").alias("first_ts"), F.max("txn_ts").alias("last_ts"),
        _amount(F.col("tier") == "HIGH").alias("high_risk_amount"), _amount(F.col("tier") == "MEDIUM").alias("medium_risk_amount"), F.coalesce(_count(F.col("tier") == "HIGH"), F.lit(0)).alias("high_risk_count"),
        F.coalesce(F.max("gap"), F.lit(0)).alias("max_gap_days"), F.coalesce(F.max("_cp"), F.lit(0.0)).alias("top_cp_amount"),
    )


def top_counterparty(tx: DataFrame) -> DataFrame:
    """(customer_id, period, top_cp_amount): the largest sum with one known counterparty, by two aggregates
    that fold before they shuffle; on its own cheaper than ``monthly``."""
    by = tx.where(F.col("counterparty").isNotNull()).groupBy("customer_id", period(), "counterparty").agg(F.sum(money(F.col("amount"))).alias("s"))
    return by.groupBy("customer_id", "period").agg(F.max("s").cast("double").alias("top_cp_amount"))


def base_features(tx: DataFrame, cust: DataFrame, risk: DataFrame) -> DataFrame:
    """KEY, behaviour_segment and BASE. Null, NaN and infinite numbers become 0."""
    m = monthly(tx, risk).join(cust, "customer_id")
    high = risk.where("tier = 'HIGH'").select(F.col("country_key").alias("nation_key"), F.lit(1).alias("_high"))
    m = m.join(F.broadcast(high), "nation_key", "left")  # a row per country
    n, all_ = F.col("txn_count").cast("double"), F.nullif(F.col("total_amount"), F.lit(0.0))
    part = lambda c: F.col(c) / all_
    rate = lambda c: F.col(c) / n
    cols = {
        "month_of_year": F.substring("period", 6, 2).cast("int"), "avg_amount": F.col("total_amount") / n, "credit_share": rate("credits"),
        "passthrough_ratio": F.least("debit_amount", "credit_amount") / F.nullif(F.col("credit_amount"), F.lit(0.0)), "cash_share": part("cash_amount"), "cash_txn_share": rate("cash_txns"),
        "wire_share": part("wire_amount"), "card_share": part("card_amount"), "near_ctr_share": rate("near_ctr_count"), "round_share": rate("rounds"),
        "cross_border_share": part("cross_border_amount"), "counterparty_diversity": rate("distinct_counterparties"), "night_share": rate("nights"), "weekend_share": rate("weekends"),
        "active_span_days": F.datediff("last_ts", "first_ts"), "high_risk_share": part("high_risk_amount"), "medium_risk_share": part("medium_risk_amount"),
        "top_counterparty_share": part("top_cp_amount"), "account_age_days": F.datediff("first_ts", "account_open_date"),
        "kyc_risk_ordinal": F.when(F.col("kyc") == "LOW", 0).when(F.col("kyc") == "MEDIUM", 1).otherwise(2), "is_pep": F.col("is_pep").cast("int"),
        "nationality_high_risk": F.coalesce("_high", F.lit(0)),
    }
    number = lambda c: finite(cols.get(c, F.col(c)).cast("double")).alias(c)
    return m.select(*KEY, "behaviour_segment", *(number(c) for c in BASE))


def finite(c: Column) -> Column:
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c)


def peer_medians(train: DataFrame, columns: tuple[str, ...] = PEER) -> DataFrame:
    """(behaviour_segment, med_*): exact medians by segment; the row of the null segment is the global one."""
    return exact_quantiles(train, ["behaviour_segment"], list(columns), 0.5, "med_", grand=True)


def shrink_targets(train: DataFrame, columns: tuple[str, ...] = SHRUNK) -> DataFrame:
    """One row: the transaction-weighted mean of each rate."""
    n = F.nullif(F.sum("txn_count"), F.lit(0.0))
    return train.agg(*((F.sum(F.col(c) * F.col("txn_count")) / F.coalesce(n, F.lit(1.0))).alias(f"mu_{c}") for c in columns))


def clip(c: Column) -> Column:
    """To [0, 50]; null stays null, which least and greatest alone would skip."""
    return F.when(c.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(50.0), c)))


def self_relative(df: DataFrame) -> DataFrame:
    """Against the customer's own earlier active months; 1 where there is nothing to compare with."""
    w = Window.partitionBy("customer_id").orderBy("period")
    prior, n = F.lag("total_amount").over(w), F.lag("txn_count").over(w)
    mean = F.avg("total_amount").over(w.rowsBetween(Window.unboundedPreceding, -1))
    against = lambda x, y: F.coalesce(clip(F.col(x) / F.nullif(y, F.lit(0.0))), F.lit(1.0))
    return df.select(
        "*", F.coalesce(prior, F.lit(0.0)).alias("prior_month_amount"), against("total_amount", prior).alias("amount_vs_prior"), against("txn_count", n).alias("count_vs_prior"),
        against("total_amount", mean).alias("amount_vs_trailing_mean"), (F.row_number().over(w) == 1).cast("double").alias("is_first_active_month"),
    )


def transform(df: DataFrame, medians: DataFrame, targets: DataFrame, segments: list[str], prior: float = Monitoring.shrink_prior) -> DataFrame:
    """Peer ratios (before shrinkage), shrunk rates, self-relative columns and one-hot segments.

    ``medians`` and ``targets`` come from training customers only: a row per segment and one row. Self-relative columns that ``df`` has
    already are kept: where they are made with the base features, whose rows are by customer anyway, no wide row is shuffled here.
    """
    own = medians.where("behaviour_segment is not null")
    top = medians.where("behaviour_segment is null").select(*(F.col(f"med_{c}").alias(f"all_{c}") for c in PEER))
    d = df.join(own, "behaviour_segment", "left").crossJoin(top).crossJoin(targets)  # two one-row sides
    ratio = lambda c: F.coalesce(clip(F.col(c) / F.nullif(F.coalesce(f"med_{c}", f"all_{c}"), F.lit(0.0))), F.lit(1.0)).alias(f"peer_ratio_{c}")
    trust = F.col("txn_count") / (F.col("txn_count") + prior)
    plain = [F.when(F.lit(True), trust * F.col(c) + (1 - trust) * F.col(f"mu_{c}")).alias(c) if c in SHRUNK else F.col(c) for c in BASE]
    own_past = SELF if set(SELF) <= set(df.columns) else ()
    d = d.select(*KEY, "behaviour_segment", *plain, *(ratio(c) for c in PEER), *own_past)
    hot = [(F.col("behaviour_segment") == s).cast("double").alias(f"segment_{s}") for s in segments]
    return (d if own_past else self_relative(d)).select("*", *hot)


def split_by_customer(df: DataFrame, share: float = Monitoring.test_share, seed: int = 7) -> DataFrame:
    """(customer_id, is_test): exactly ceil(share n) customers are test ones, chosen by a hash order.

    The cut, one row, is found by histograms over distinct customers; nothing is sorted but a bounded remainder.
    """
    ids = settle(df.select("customer_id").distinct().withColumn("_h", F.xxhash64("customer_id", F.lit(seed))), "customers-hashed")
    n = ids.count()
    k = -(-int(n * share * 1_000_000) // 1_000_000)
    if k == 0:
        return ids.select("customer_id", F.lit(False).alias("is_test"))
    order = [("_h", False), ("customer_id", False)]
    return ids.select("customer_id", upto(order, kth(ids, order, k)).alias("is_test"))


def out_of_time(df: DataFrame, months: int = Monitoring.out_of_time_months) -> DataFrame:
    """``df`` with is_oot: whether its period is among the last ``months`` distinct ones."""
    last = df.select("period").distinct().orderBy(F.desc("period")).limit(months)
    return df.join(F.broadcast(last.withColumn("_o", F.lit(True))), "period", "left").withColumn("is_oot", F.coalesce("_o", F.lit(False))).drop("_o")  # ``months`` rows


def attach_labels(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of one label a cell; cells without one are negatives. Doubled labels are an error."""
    twice = labels.groupBy(*KEY).count().where("count > 1").limit(1).count()
    if twice:
        raise ValueError("labels hold a cell twice")
    return df.join(labels, list(KEY), "left").withColumn("is_true", F.coalesce("is_true", F.lit(False)))
