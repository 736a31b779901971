"""Connected components of an undirected edge table by alternating stars.

Kiveris et al., "Connected Components in MapReduce and Beyond" (2014). Every round is two
aggregations and two joins over the edges; nothing is gathered on the driver but two numbers that
tell whether the edge set still changes. The minima are settled before each join, so that both
sides of it are plain shuffles and adaptive execution can split a hub's edges over tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sablefin.session import settle


def _state(edges: DataFrame) -> tuple:
    mark = F.xxhash64("a", "b")
    r = edges.agg(F.count(F.lit(1)), F.bit_xor(mark)).first()
    return r[0], r[1]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = settle(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "large-low")
    return both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # every edge runs from its larger end a to its smaller end b here
    low = settle(edges.groupBy("a").agg(F.min("b").alias("m")), "small-low")
    moved = edges.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges``(a, b) of orderable nodes -> (node, label): the smallest node each one reaches.

    Self loops and repeated edges are allowed; null ends are dropped. Nodes without an edge to
    another node aren't returned.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = settle(now, "edges")
    state = _state(now)
    while True:
        now = settle(_small_star(settle(_large_star(now), "large")), "small")
        state, before = _state(now), state
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
