"""Threshold sweeps above and below the line, from one pass over each rule's candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.config import Scenario
from sablefin.operators.rules import candidates
from sablefin.sources.tables import union_all

COLUMNS = (
    "rule_id", "param_name", "param_value", "position", "alert_volume", "true_positives", "false_positives", "precision", "recall",
    "false_positive_ratio", "alert_rate", "delta_alerts", "delta_true_positives", "marginal_reviews_per_extra_hit",
)
INF = float("inf")


def _ratio(fp, tp):
    return F.when(tp == 0, F.when(fp == 0, 0.0).otherwise(INF)).otherwise(fp / F.nullif(tp, F.lit(0)))


def sweep(s: Scenario, tx: DataFrame, cust: DataFrame, risk: DataFrame, labels: DataFrame) -> DataFrame:
    """COLUMNS for each value of the grid. All values are counted in one aggregate over the candidates;
    the baseline's row meets the others by a window over the handful of grid rows.

    A setting with more alerts than the baseline is LOOSER, any other one TIGHTER.
    """
    c = candidates(s, tx, cust, risk).select("customer_id", "period", "metric_value")
    c = c.join(labels.where("is_true").select("customer_id", "period", F.lit(1).alias("hit")), ["customer_id", "period"], "left")
    grid = s.grid
    counts = c.agg(*(x for k, v in enumerate(grid) for x in (
        F.count(F.when(F.col("metric_value") >= v, 1)).alias(f"n{k}"), F.count(F.when((F.col("metric_value") >= v) & (F.col("hit") == 1), 1)).alias(f"t{k}")
    )))
    long_ = counts.select(F.inline(F.array(*(F.struct(F.lit(float(v)).alias("param_value"), F.col(f"n{k}").alias("alert_volume"), F.col(f"t{k}").alias("true_positives")) for k, v in enumerate(grid)))))
    all_ = labels.agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(F.col("is_true"), 1)).alias("truth"))
    d = long_.crossJoin(F.broadcast(all_))  # grid rows x one row
    base = F.col("param_value") == float(s.params[s.sweep_param])
    w = Window.partitionBy(F.lit(0))
    d = d.withColumn("_bn", F.max(F.when(base, F.col("alert_volume"))).over(w)).withColumn("_bt", F.max(F.when(base, F.col("true_positives"))).over(w))
    n, t = F.col("alert_volume"), F.col("true_positives")
    dn, dt = n - F.col("_bn"), t - F.col("_bt")
    return d.select(
        F.lit(s.rule_id).alias("rule_id"), F.lit(s.sweep_param).alias("param_name"), "param_value",
        F.when(base, "BASELINE").when(n > F.col("_bn"), "LOOSER").otherwise("TIGHTER").alias("position"), n.alias("alert_volume"), t.alias("true_positives"), (n - t).alias("false_positives"),
        F.round(F.coalesce(t / F.nullif(n, F.lit(0)), F.lit(0.0)), 6).alias("precision"), F.round(F.coalesce(t / F.nullif(F.col("truth"), F.lit(0)), F.lit(0.0)), 6).alias("recall"),
        F.round(_ratio(n - t, t), 6).alias("false_positive_ratio"), F.round(F.coalesce(n / F.nullif(F.col("cells"), F.lit(0)), F.lit(0.0)), 6).alias("alert_rate"), dn.alias("delta_alerts"), dt.alias("delta_true_positives"),
        F.round(F.when(dt != 0, F.abs(dn) / F.nullif(F.abs(dt), F.lit(0))).when(dn != 0, INF).otherwise(0.0), 6).alias("marginal_reviews_per_extra_hit"),
    )


def sweep_all(some: dict[str, Scenario], tx: DataFrame, cust: DataFrame, risk: DataFrame, labels: DataFrame) -> DataFrame:
    return union_all([sweep(s, tx, cust, risk, labels) for s in some.values()])


def recommend(swept: DataFrame, most: float = 40.0) -> DataFrame:
    """One row a rule: the setting with the best recall among those whose false-positive ratio stays within
    ``most`` (ties: the highest value), else the one with the least ratio; and the baseline beside it."""
    within = F.col("false_positive_ratio") <= most
    order = Window.partitionBy("rule_id").orderBy(within.desc(), F.when(within, F.col("recall")).desc_nulls_last(), F.when(within, F.col("param_value")).desc_nulls_last(), "false_positive_ratio", F.desc("param_value"))
    base = Window.partitionBy("rule_id")
    of = lambda c: F.max(F.when(F.col("position") == "BASELINE", F.col(c))).over(base)
    d = swept.select("*", F.row_number().over(order).alias("_k"), of("param_value").alias("baseline_value"), of("recall").alias("baseline_recall"), of("false_positive_ratio").alias("baseline_ratio"), within.alias("within_limit"))
    return d.where("_k = 1").select(
        "rule_id", "param_name", "baseline_value", F.col("param_value").alias("recommended_value"), "baseline_recall", F.col("recall").alias("recommended_recall"),
        "baseline_ratio", F.col("false_positive_ratio").alias("recommended_ratio"), "within_limit", F.col("alert_volume").alias("recommended_volume"),
        (F.col("param_value") != F.col("baseline_value")).alias("changed"),
    )


def rule_performance(alerts: DataFrame, labels: DataFrame) -> DataFrame:
    """Confusion counts by rule at its current setting."""
    truth = labels.agg(F.count(F.lit(1)).alias("cells"), F.count(F.when(F.col("is_true"), 1)).alias("truth"))
    hit = alerts.join(labels.where("is_true").select("customer_id", "period", F.lit(1).alias("hit")), ["customer_id", "period"], "left")
    d = hit.groupBy("rule_id").agg(F.count(F.lit(1)).alias("alert_volume"), F.count("hit").alias("true_positives")).crossJoin(F.broadcast(truth))  # one row
    n, t = F.col("alert_volume"), F.col("true_positives")
    return d.select(
        "rule_id", n, t, (n - t).alias("false_positives"), (F.col("truth") - t).alias("false_negatives"), F.round(t / n, 6).alias("precision"),
        F.round(F.coalesce(t / F.nullif(F.col("truth"), F.lit(0)), F.lit(0.0)), 6).alias("recall"), F.round(_ratio(n - t, t), 6).alias("false_positive_ratio"), F.round(n / F.col("cells"), 6).alias("alert_rate"),
    )


def union_recall(alerts: DataFrame, labels: DataFrame) -> DataFrame:
    """One row: how many true cells any rule alerts on, of how many."""
    cells = alerts.select("customer_id", "period").distinct()
    truth = labels.where("is_true").select("customer_id", "period")
    d = truth.join(cells.withColumn("hit", F.lit(1)), ["customer_id", "period"], "left").agg(F.count(F.lit(1)).alias("true_cells"), F.count("hit").alias("detected_cells"))
    return d.select("true_cells", "detected_cells", F.round(F.coalesce(F.col("detected_cells") / F.nullif(F.col("true_cells"), F.lit(0)), F.lit(0.0)), 6).alias("union_recall"))
