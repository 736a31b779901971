"""Exact top-k inner-product search by MaxScore over sharded postings.

Vectors are dealt to shards and queries to blocks, both of bounded size; each (shard, block) pair is
one task's work. In a shard every dimension is a posting list with score bounds (``topk_kernel``). A
task returns at most k rows a query, and shards merge by rank. Nothing is gathered on the driver and no
side is broadcast; an integer score is exact whatever the order of its terms.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.llm import topk_kernel as kernel
from sablefin.llm.common import table
from sablefin.session import settle

K = 20
SHARD = 20_000
#: Queries that meet a shard at once: candidates are copied once for each block.
BLOCK = 8192


def usable(v: Column) -> Column:
    """True for vectors that are not null and hold finite components only."""
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return v.isNotNull() & ~F.coalesce(broken, F.lit(True))


def scaled(v: Column, factor: int) -> Column:
    return F.transform(v, lambda x: F.floor(x.cast("double") * factor).cast("long"))


def search(
    vectors: DataFrame, is_query: Column, k: int = K, vec_id: str = "vec_id", vector: str = "embedding", factor: int = 64,
    shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score of the ``k`` best of every query.

    Queries are the rows for which ``is_query`` holds (null: no), candidates all rows but the query's own
    row; another row with the query's id or vector is a candidate like any other. Components become
    floor(``factor`` x); vectors that are null or hold null or non-finite components take no part. Shorter
    vectors count as padded with zeros. Ties go to the smaller id, null ids last. Scores are exact whatever their size; one that a long
    can't hold is the nearest long, and so is a component.
    """
    rows = vectors.where(usable(F.col(vector))).select(
        F.monotonically_increasing_id().alias("_row"), F.col(vec_id).cast("long").alias("_id"), scaled(F.col(vector), factor).alias("_v"),
        F.coalesce(is_query, F.lit(False)).alias("_q"),
    )
    rows = settle(rows, "topk-vectors")
    wide = lambda c: c.cast("decimal(20,0)")  # noqa: E731  the least long has no opposite
    far = F.greatest(wide(F.array_max("_v")), -wide(F.array_min("_v")))
    n, m, width, most = rows.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(F.col("_q").cast("long")), F.lit(0)), F.coalesce(F.max(F.size("_v")), F.lit(0)), F.coalesce(F.max(far), F.lit(0))
    ).first()
    kind = kernel.exact_type(width, int(most))
    shards, blocks = max(1, -(-n // shard)), max(1, -(-m // block))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    place = F.xxhash64("_row")
    candidates = rows.select("_row", "_id", "_v", F.pmod(place, F.lit(shards)).cast("int").alias("_s"), every(blocks).alias("_b"))
    queries = rows.where("_q").select("_row", "_id", "_v", every(shards).alias("_s"), F.pmod(place, F.lit(blocks)).cast("int").alias("_b"))

    def part(t: pa.Table):
        t = t.combine_chunks()
        v = t.column("_v").combine_chunks()
        lengths = np.asarray(pc.list_value_length(v).to_numpy(zero_copy_only=False), np.int64)
        ids = t.column("_id").combine_chunks()
        known = np.asarray(ids.is_valid().to_numpy(zero_copy_only=False))
        return t.column("_row").to_numpy(), ids.fill_null(0).to_numpy(), known, kernel.matrix(np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.int64).astype(kind), lengths, width)

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        rows_, ids, known, x = part(left)
        q_rows, q_ids, _, q = part(right)
        own = kernel.Shard(ids, rows_, x)
        out: dict[str, list] = {c: [] for c in ("_q", "query_id", "vec_id", "score")}
        for r, i, v in zip(q_rows.tolist(), q_ids.tolist(), q, strict=True):
            at, scores = kernel.best(ids, known, *own.top(v, r, k), k)
            out["_q"] += [r] * len(at)
            out["query_id"] += [i] * len(at)
            out["vec_id"] += [int(ids[p]) if known[p] else None for p in at.tolist()]
            out["score"] += scores.tolist()
        return pa.table({c: pa.array(x, pa.int64()) for c, x in out.items()})

    found = candidates.groupBy("_s", "_b").cogroup(queries.groupBy("_s", "_b")).applyInArrow(work, "_q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_q").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


ORACLE = """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score,
    row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.e, v.e) DESC, v.vec_id NULLS LAST) AS rank
  FROM v q JOIN v ON q.r <> v.r WHERE q.vec_id % 20 = 0) WHERE rank <= 20"""
