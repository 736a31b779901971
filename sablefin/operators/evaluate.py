"""Rank metrics as relational plans over (score, y) rows.

Orders over all rows are taken on distinct scores: counts fold per score before any window, so what
one window sees is a row per distinct score, and scores may be rounded to bound that. Running sums are
two-level: within a slice of the score range, and over slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.operators.ordering import kth, upto
from sablefin.operators.quantile import _cell
from sablefin.session import settle

SLICES = 64


def steps(df: DataFrame, score: str = "score", y: str = "y", n: str | None = None) -> DataFrame:
    """(score, n, p, cum_n, cum_p, below_n): a row per distinct score, descending running counts.

    ``cum_*`` count rows with this score or higher, ``below_n`` rows with a lower one. Folded rows stand for as many as ``n`` says.
    """
    each = F.lit(1).cast("long") if n is None else F.col(n)
    per = df.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("score")).agg(F.sum(each).alias("n"), F.sum(F.col(y).cast("long") * each).alias("p"))
    per = settle(per, "score-steps")  # read four times
    low, high = per.agg(F.min("score"), F.max("score")).first()
    if low is None:
        return per.select("score", "n", "p", F.lit(0).cast("long").alias("cum_n"), F.lit(0).cast("long").alias("cum_p"), F.lit(0).cast("long").alias("below_n"))
    width = (high - low) / SLICES or 1.0
    per = per.withColumn("_s", F.least(F.floor((F.lit(high) - F.col("score")) / width), F.lit(SLICES - 1)))
    inside = Window.partitionBy("_s").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    over = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)  # SLICES rows
    starts = per.groupBy("_s").agg(F.sum("n").alias("sn"), F.sum("p").alias("sp"))
    starts = starts.select("_s", F.coalesce(F.sum("sn").over(over), F.lit(0)).alias("bn"), F.coalesce(F.sum("sp").over(over), F.lit(0)).alias("bp"))
    total = per.agg(F.sum("n").alias("all_n"))
    out = per.join(F.broadcast(starts), "_s").crossJoin(F.broadcast(total))  # SLICES rows, one row
    cum = (F.sum("n").over(inside) + F.col("bn")).alias("cum_n")
    return out.select("score", "n", "p", cum, (F.sum("p").over(inside) + F.col("bp")).alias("cum_p"), "all_n").select(
        "score", "n", "p", "cum_n", "cum_p", (F.col("all_n") - F.col("cum_n")).alias("below_n")
    )


def roc_auc(df: DataFrame, score: str = "score", y: str = "y", n: str | None = None) -> DataFrame:
    """One row: roc_auc, by the rank sum with average ranks for ties; null if a class is missing. ``n`` as in ``steps``."""
    r = steps(df, score, y, n).agg(
        F.sum(F.col("p") * (F.col("below_n") + (F.col("n") + 1) / 2)).alias("ranks"), F.sum("p").alias("pos"), F.sum("n").alias("all")
    )
    neg = F.col("all") - F.col("pos")
    return r.select(((F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2) / F.nullif(F.col("pos") * neg, F.lit(0))).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", y: str = "y") -> DataFrame:
    """One row: average_precision, stepwise over distinct scores."""
    r = steps(df, score, y).agg(F.sum(F.col("p") * F.col("cum_p") / F.col("cum_n")).alias("s"), F.sum("p").alias("pos"))
    return r.select((F.col("s") / F.nullif(F.col("pos"), F.lit(0))).alias("average_precision"))


def by_slice(df: DataFrame, by: list[str], score: str = "score", y: str = "y", least: int = 0) -> DataFrame:
    """(``by``, rows, positives, roc_auc, average_precision): rank metrics of every group in one pass.

    Rows fold to a row per group and distinct score; running sums are taken within cells of scores and over cells, so no task
    holds a whole group. Metrics are null in groups of fewer than ``least`` positives or of one class; null scores don't count.
    """
    per = df.where(F.col(score).isNotNull()).groupBy(*by, F.col(score).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(y).cast("long")).alias("p"))
    per = settle(per.withColumn("_c", _cell(F.col("_v"))), "slice-steps")
    inside = Window.partitionBy(*by, "_c").orderBy(F.desc("_v")).rowsBetween(Window.unboundedPreceding, 0)
    cells = per.groupBy(*(F.col(c).alias(f"_{c}") for c in by), F.col("_c").alias("_k")).agg(F.sum("n").alias("sn"), F.sum("p").alias("sp"))
    group = Window.partitionBy(*(f"_{c}" for c in by))
    above = group.orderBy(F.desc("_k")).rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("*", *(F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"b{c}") for c in ("sn", "sp")), F.sum("sn").over(group).alias("_all"))
    on = F.col("_c") == F.col("_k")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_{c}"))
    d = per.join(cells, on).select(*by, "n", "p", (F.sum("n").over(inside) + F.col("bsn")).alias("cn"), (F.sum("p").over(inside) + F.col("bsp")).alias("cp"), "_all")
    below = F.col("_all") - F.col("cn")
    r = d.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.sum("p").alias("positives"), F.sum(F.col("p") * (below + (F.col("n") + 1) / 2)).alias("_ranks"), F.sum(F.col("p") * F.col("cp") / F.col("cn")).alias("_steps")
    )
    pos, neg = F.col("positives"), F.col("rows") - F.col("positives")
    enough = (pos >= max(least, 1)) & (neg > 0)
    return r.select(
        *by, "rows", "positives", F.when(enough, (F.col("_ranks") - pos * (pos + 1) / 2) / (pos * neg)).alias("roc_auc"), F.when(enough, F.col("_steps") / pos).alias("average_precision")
    )


#: Fewest positives on which a slice of the latest months is judged.
LEAST_POSITIVES = 5


def out_of_time_report(scores: DataFrame, months: int, least: int = LEAST_POSITIVES) -> DataFrame:
    """(model, slice, rows, positives, roc_auc, average_precision, best) of ``scores``(model, period, score, y).

    Slices are 'test', all rows, and 'out_of_time', those of the last ``months`` periods of all; both come from one set of running
    sums. ``best`` marks the model of the highest average precision on the test slice, the first by name on ties. Metrics of the latest
    months are null with fewer than ``least`` positives or where all are.
    """
    last = scores.select("period").distinct().orderBy(F.desc("period")).limit(months)  # ``months`` rows
    d = scores.join(F.broadcast(last.select(F.col("period").alias("_p"))), F.col("period") == F.col("_p"), "left")
    d = d.withColumn("slice", F.explode(F.when(F.col("_p").isNotNull(), F.array(F.lit("test"), F.lit("out_of_time"))).otherwise(F.array(F.lit("test")))))
    r = settle(by_slice(d, ["model", "slice"]), "slices")
    thin = (F.col("slice") == "out_of_time") & (F.col("positives") < least)
    r = r.select("model", "slice", "rows", "positives", *(F.when(~thin, F.col(c)).alias(c) for c in ("roc_auc", "average_precision")))
    # a row per model
    top = r.where("slice = 'test'").orderBy(F.desc_nulls_last("average_precision"), "model").limit(1).select(F.col("model").alias("_best"))
    return r.join(F.broadcast(top), F.col("model") == F.col("_best"), "left").select(*r.columns, F.col("_best").isNotNull().alias("best"))


def _point(rows: DataFrame, positives: int) -> DataFrame:
    """(threshold, alert_volume, tp, fp, recall, precision, fp_ratio) of a prefix of the ranking."""
    tp, n = F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0)), F.count(F.lit(1))
    r = rows.agg(F.min("score").alias("threshold"), n.alias("alert_volume"), tp.alias("true_positives"))
    fp = F.col("alert_volume") - F.col("true_positives")
    return r.select(
        "threshold", "alert_volume", "true_positives", fp.alias("false_positives"), (F.col("true_positives") / F.lit(max(positives, 1))).alias("recall"),
        (F.col("true_positives") / F.nullif(F.col("alert_volume"), F.lit(0))).alias("precision"),
        F.when(F.col("true_positives") == 0, F.lit(float("inf"))).otherwise(fp / F.nullif(F.col("true_positives"), F.lit(0))).alias("fp_ratio"),
    )


def at_recall(df: DataFrame, target: float, tie: list[str], score: str = "score", y: str = "y") -> DataFrame:
    """Shortest prefix of the ranking (score descending, then ``tie``) that reaches ``target`` recall.

    The row that reaches it is the ceil(target P)-th positive in order; all rows at or before it count. That row is
    found by histograms, so no task sorts more than a bounded remainder. Rows equal in score and ``tie`` go together.
    """
    d = settle(df.select(F.col(score).alias("score"), F.col(y).cast("boolean").alias("y"), *tie), "ranking")
    pos = d.where("y").count()
    if pos == 0:
        raise ValueError("no positives")
    need = next((k for k in range(max(1, int(target * pos) - 1), pos + 1) if k / pos >= target), pos)
    order = [("score", True), *((c, False) for c in tie)]
    return _point(d.where(upto(order, kth(d.where("y"), order, need))), pos)


def at_budget(df: DataFrame, share: float, tie: list[str], score: str = "score", y: str = "y") -> DataFrame:
    """The top max(1, round-half-even(share n)) rows; ``tie`` is to make the order total. Cut like ``at_recall``."""
    d = settle(df.select(F.col(score).alias("score"), F.col(y).cast("boolean").alias("y"), *tie), "ranking")
    n, pos = d.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    order = [("score", True), *((c, False) for c in tie)]
    last = kth(d, order, max(1, round(share * n)))
    return _point(d.where(upto(order, last)) if last else d, pos)


def percentile_rank(df: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """``df`` with pct_rank: average rank over n, ties sharing their mean. Without groups, ranks come from ``steps``."""
    by = by or []
    if by:
        per = df.groupBy(*by, column).agg(F.count(F.lit(1)).alias("_n"))
        w = Window.partitionBy(*by)
        below = F.coalesce(F.sum("_n").over(w.orderBy(column).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        per = per.withColumn("pct_rank", (below + (F.col("_n") + 1) / 2) / F.sum("_n").over(w)).drop("_n")
    else:
        each = steps(df.withColumn("_y", F.lit(False)), column, "_y")
        per = each.select(F.col("score").alias(column), ((F.col("below_n") + (F.col("n") + 1) / 2) / (F.col("below_n") + F.col("cum_n"))).alias("pct_rank"))
    return df.join(per, [*by, column])


def separability(df: DataFrame, score: str = "score") -> DataFrame:
    """Mean percentile of each ``kind`` and the AUC of 'anomaly' against each other kind, with a verdict:
    whether the score can tell true anomalies from near misses.

    ``df`` is read once: all measures follow from how many rows each kind has of each score.
    """
    per = settle(df.where(F.col(score).isNotNull()).groupBy("kind", F.col(score).alias("score")).agg(F.count(F.lit(1)).alias("k")), "kind-scores")
    each = steps(per.withColumn("_y", F.lit(False)), "score", "_y", "k")
    rank = each.select("score", ((F.col("below_n") + (F.col("n") + 1) / 2) / (F.col("below_n") + F.col("cum_n"))).alias("pct_rank"))
    p = per.join(rank, "score").groupBy("kind").agg((F.sum(F.col("pct_rank") * F.col("k")) / F.sum("k")).alias("mean_percentile"))
    # all pairs of kinds in one plan: ranks within (anomaly or this kind)
    kinds = [r["kind"] for r in per.select("kind").distinct().collect() if r["kind"] != "anomaly"]
    out = None
    for k in sorted(kinds):
        one = roc_auc(per.where(F.col("kind").isin("anomaly", k)).withColumn("y", F.col("kind") == "anomaly"), "score", "y", "k").withColumn("kind", F.lit(k))
        out = one if out is None else out.unionByName(one)
    base = p.join(out, "kind", "left") if out is not None else p.withColumn("roc_auc", F.lit(None).cast("double"))
    return base.withColumn("separable", F.when(F.col("roc_auc").isNull(), None).otherwise(F.abs(F.col("roc_auc") - 0.5) > 0.08))
