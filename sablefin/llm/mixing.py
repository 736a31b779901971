"""Mixing sources to target weights by pivotal dependent rounding.

Every document starts with a fractional number of copies, its source's target over its source's
size. The whole part is taken for certain; the fractional part is settled by pivotal steps: two
documents that are both still fractional meet, one of two transfers is drawn so that each keeps its
expectation, and at least one of them becomes whole. Mass is counted in words, not in documents, so
a step moves no words into or out of the source: what a source takes differs from its target by at
most half of one document, the last one left, which goes to the nearer side.

The steps form a reduction tree. Leaves are hash buckets of a source's documents; each leaf is
reduced by one task to whole decisions and one fractional residual, and the residuals meet in ever
fewer nodes up to one per source. A source with a third of all rows has proportionally many leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.llm.common import n_words, spread, table
from sablefin.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
LIMIT = 2
#: Documents a leaf holds on average, and residuals a node of the tree merges at most on average.
LEAF = 4096


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, limit: float = LIMIT) -> dict[str | None, float]:
    """source -> words to take. Sources by code point, null last, weigh ``weights`` in turn and share
    ``share`` of all sizes; no target exceeds ``limit`` times its source's size, the excess goes to the
    others by weight until none is above. Runs over sources, not rows."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    left = share * sum(n for _, n in order)
    open_ = {s: (weights[k % len(weights)], limit * n) for k, (s, n) in enumerate(order)}
    out: dict[str | None, float] = {}
    while open_:
        total = sum(w for w, _ in open_.values())
        full = [s for s, (w, most) in open_.items() if left * w / total > most]
        if not full:
            out |= {s: float(left * w / total) for s, (w, _) in open_.items()}
            break
        for s in full:
            out[s] = float(open_.pop(s)[1])
            left -= out[s]
    return out


def _seed(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode(), digest_size=8).digest(), "little")


def pivot(size: np.ndarray, share: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, int]:
    """Settle fractional ``share`` of documents of ``size`` words, in the order given.

    Returns the shares, all 0 or 1 but that of the index returned (-1: none is left). The sum of
    size * share stays what it was, and each share keeps its expectation.
    """
    p, w = share.astype(float).copy(), size.astype(float)
    draws = rng.random(len(p))
    i = -1
    for j in range(len(p)):
        if w[j] == 0:  # no words to move: decided alone
            p[j] = float(draws[j] < p[j])
            continue
        if not 0 < p[j] < 1:
            continue
        if i < 0:
            i = j
            continue
        a, b = w[i] * p[i], w[j] * p[j]
        up, down = min(w[i] - a, b), min(a, w[j] - b)  # words that can go from j to i, from i to j
        if draws[j] * (up + down) < down:
            i_full, j_full = up == w[i] - a, up == b
            p[i], p[j] = (1.0 if i_full else (a + up) / w[i]), (0.0 if j_full else (b - up) / w[j])
        else:
            i_full, j_full = down == a, down == w[j] - b
            p[i], p[j] = (0.0 if i_full else (a - down) / w[i]), (1.0 if j_full else (b + down) / w[j])
        if not 0 < p[i] < 1:
            i = j if 0 < p[j] < 1 else -1
    return p, i


def _reduce(parts: Iterator[pd.DataFrame], seed: int, level: int) -> Iterator[pd.DataFrame]:
    """Settles each (source, node) run of rows sorted by source, node and order."""
    rest: pd.DataFrame | None = None

    def settle_run(g: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng(_seed(seed, level, int(g["_sid"].iat[0]), int(g["_node"].iat[0])))
        p, left = pivot(g["size"].to_numpy(), g["_share"].to_numpy(), rng)
        done = np.ones(len(g), bool)
        if left >= 0:
            done[left] = False
        return g.assign(_share=p, _done=done)

    for part in parts:
        rest = part if rest is None or rest.empty else pd.concat([rest, part], ignore_index=True)
        if rest.empty:
            continue
        key = rest[["_sid", "_node"]].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield settle_run(rest.iloc[a:b])
        if len(cuts):
            rest = rest.iloc[cuts[-1] :].reset_index(drop=True)
    if rest is not None and not rest.empty:
        yield settle_run(rest)


def _level(rows: DataFrame, parts: int, seed: int, level: int) -> DataFrame:
    """One level of the tree over rows that carry their ``_node``."""
    dealt = rows.repartition(parts, "_sid", "_node").sortWithinPartitions("_sid", "_node", F.desc("size"), "_order")
    return dealt.mapInPandas(lambda it: _reduce(it, seed, level), rows.schema.add("_done", "boolean"))


def copies(docs: DataFrame, size: Column, keep: tuple[str, ...] = ("doc_id",), **how) -> DataFrame:
    """One row per row of ``docs``: ``keep``, size, source_size (long), target (double), copies (int).

    Copies are 0 to ``limit``. Bucketing and draws depend on the seed, the ``order`` columns and the
    sizes alone, so reruns agree; rows equal in all of these are interchangeable. Documents of no
    words get copies by a draw of their own. The targets are worked out on the driver, from a row a source, so a source is to be a
    feed and not a host. Null sources are one source, last. A source whose
    documents have no words has target 0.
    """
    got = _copied(docs, size, keep, **how)
    return got.select("_keep.*", *(c for c in got.columns if c != "_keep"))


def _copied(
    docs: DataFrame, size: Column, keep: tuple[str, ...], source: str = "source", weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE, limit: int = LIMIT, seed: int = 17, leaf: int = LEAF, order: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    spark = docs.sparkSession
    tag = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in order), F.lit(seed))
    rows = settle(
        docs.select(
            F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(c) for c in keep)).alias("_keep"),
            F.col(source).cast("string").alias("_source"), size.cast("long").alias("size"), tag.alias("_order"),
        ),
        "mix-rows",
    )
    # a row per source: as many as there are sources, which the targets are defined over
    per = rows.groupBy("_source").agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    if not per:
        return rows.select("_keep", "size", F.lit(0).cast("long").alias("source_size"), F.lit(0.0).alias("target"), F.lit(0).alias("copies"))
    per.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    want = targets([(r["_source"], r["n"]) for r in per], weights, share, limit)
    plan = [(r["_source"], k, r["n"], want[r["_source"]], max(1, -(-r["rows"] // leaf))) for k, r in enumerate(per)]
    per_source = spark.createDataFrame(plan, "_src string, _sid long, source_size long, target double, _leaves long")
    exact = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(exact + 1e-12)
    start = rows.select("_row", "_source", "size", "_order").join(per_source, F.col("_source").eqNullSafe(F.col("_src")))
    start = start.select(
        "_row", "_sid", "size", "_order", F.pmod("_order", "_leaves").alias("_node"),
        F.greatest(exact - whole, F.lit(0.0)).alias("_share"), whole.cast("int").alias("_whole"), "source_size", "target",
    )
    start = settle(start, "mix-start")
    slim = start.select("_row", "_sid", "size", "_order", "_node", "_share")
    n, nodes, level, decided = start.count(), max(p[4] for p in plan), 0, []
    while True:
        done = settle(_level(slim, spread(spark, n, 500_000), seed, level), f"mix-level-{level}")
        decided.append(done.where("_done").select("_row", F.col("_share").alias("_took")))
        if nodes == 1:
            last = done.where(~F.col("_done"))
            break
        nodes, level = -(-nodes // leaf), level + 1
        slim = done.where(~F.col("_done")).select("_row", "_sid", "size", "_order", F.expr(f"_node div {leaf}").alias("_node"), "_share")
        n = slim.count()
    # one document of each source can still be fractional: it goes where its source's sum is nearer
    decided.append(last.select("_row", F.round("_share").alias("_took")))
    took = decided[0]
    for more in decided[1:]:
        took = took.unionByName(more)
    counts = start.join(took, "_row").select("_row", "source_size", "target", (F.col("_whole") + F.col("_took")).cast("int").alias("copies"))
    # copies grow with the corpus: merged at every size, never broadcast
    out = rows.select("_row", "_keep", "size").join(settle(counts, "mix-copies").hint("merge"), "_row")
    return out.select("_keep", "size", "source_size", "target", "copies")


def mix(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs``, same columns, each row as often as the mix takes it (0 to the limit)."""
    got = _copied(docs, n_words(F.col(text)), tuple(docs.columns), **how)
    again = F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("_copy")
    return got.where("copies > 0").select("_keep", again).select("_keep.*")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = copies(docs, n_words(F.col("text")))
    return got.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")
