"""Exact quantiles of groups of any size.

``percentile`` gathers every value of a group in one task. Here a mergeable histogram finds the cell that holds the
quantile: cells are slices of an octave, the same for all data, so counts fold before they are shuffled. A second pass
takes only what lies in that cell, a few thousandths of a group, as distinct values with counts, so values that
repeat however often are one row. Finer cells shrink that pass but swell the histogram each task emits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.session import settle

#: Cells an octave; a double has at most 2,100 octaves of either sign.
CELLS = 256
_TOP = 4096 * CELLS


def _cell(x: Column) -> Column:
    """A long that never falls as ``x`` rises. Not-a-number lies above all numbers."""
    size = F.floor(F.log2(F.abs(x)) * CELLS) + 1100 * CELLS
    finite = F.when(x > 0, size).when(x < 0, -size).when(x == 0, F.lit(0))
    return F.when(F.isnan(x), F.lit(_TOP + 1)).when(x == float("inf"), F.lit(_TOP)).when(x == float("-inf"), F.lit(-_TOP)).otherwise(finite).cast("long")


def exact_quantiles(df: DataFrame, by: list[str], columns: list[str], q: float, prefix: str = "q_", grand: bool = False) -> DataFrame:
    """(``by``, ``prefix`` + column): linearly interpolated exact quantiles, nulls ignored; null for no values.

    ``by`` may be empty. With ``grand`` one more row, whose ``by`` are null, holds those of all rows; ``by`` must not be
    null elsewhere then.
    """
    value = lambda c: F.col(c).cast("double")
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("c"), value(c).alias("v")) for k, c in enumerate(columns)))).alias("_e")
    long = df.select(*(F.col(g).alias(f"_{g}") for g in by), each).select(*(f"_{g}" for g in by), F.col("_e.c").alias("c"), F.col("_e.v").alias("v"))
    long = long.withColumn("cell", _cell(F.col("v")))
    keys = [f"_{g}" for g in by]
    # a row per cell and group, nulls in a cell of their own
    cells = settle(long.groupBy(*keys, "c", "cell").agg(F.count(F.lit(1)).alias("n")), "quantile-cells")
    out = _read_off(long, cells, keys, q)
    wide = [F.max(F.when(F.col("c") == k, F.col("value"))).alias(prefix + c) for k, c in enumerate(columns)]
    names = [F.col(f"_{g}").alias(g) for g in by]
    got = out.groupBy(*keys).agg(*wide)
    if by:  # groups without values have a row too
        groups = cells.select(*(F.col(k).alias(f"{k}_g") for k in keys)).distinct()
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"{k}_g"))
        got = groups.join(got, on, "left").select(*(F.col(f"{k}_g").alias(g) for k, g in zip(keys, by, strict=True)), *(prefix + c for c in columns))
    if grand and by:
        total = cells.groupBy("c", "cell").agg(F.sum("n").alias("n"))
        top = _read_off(long, total, [], q).groupBy().agg(*wide)
        got = got.unionByName(top.select(*(F.lit(None).cast(df.schema[g].dataType).alias(g) for g in by), *(prefix + c for c in columns)))
    return got if by else got.select(*names, *(prefix + c for c in columns))


def _read_off(long: DataFrame, cells: DataFrame, keys: list[str], q: float) -> DataFrame:
    """(``keys``, c, value) of ``long``(keys, c, v, cell), whose histogram is ``cells``(keys, c, cell, n)."""
    group = Window.partitionBy(*keys, "c")
    run = cells.where("cell is not null").withColumn("upto", F.sum("n").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
    place = (F.col("size") - 1) * F.lit(q)
    run = run.withColumn("size", F.sum("n").over(group)).withColumn("lo", F.floor(place)).withColumn("hi", F.ceil(place)).withColumn("part", place - F.floor(place))
    ends = run.groupBy(*keys, "c", "lo", "hi", "part").agg(
        F.min(F.when(F.col("upto") > F.col("lo"), F.col("cell"))).alias("c_lo"), F.min(F.when(F.col("upto") > F.col("hi"), F.col("cell"))).alias("c_hi"),
        F.coalesce(F.max(F.when(F.col("upto") <= F.col("lo"), F.col("upto"))), F.lit(0)).alias("below"),
    )
    ends = ends.withColumnsRenamed({k: f"{k}_b" for k in (*keys, "c")})
    on = (F.col("c") == F.col("c_b")) & F.col("cell").between(F.col("c_lo"), F.col("c_hi"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"{k}_b"))
    near = long.join(ends, on).groupBy(*keys, "c", "lo", "hi", "part", "below", "v").agg(F.count(F.lit(1)).alias("n"))
    upto = F.col("below") + F.sum("n").over(group.orderBy("v").rowsBetween(Window.unboundedPreceding, 0))
    near = near.withColumn("upto", upto)
    at = lambda r: F.min(F.when(F.col("upto") > F.col(r), F.col("v")))
    two = near.groupBy(*keys, "c", "part").agg(at("lo").alias("a"), at("hi").alias("b"))
    value = F.when(F.col("part") == 0, F.col("a")).otherwise((1 - F.col("part")) * F.col("a") + F.col("part") * F.col("b"))
    return two.select(*keys, "c", value.alias("value"))
