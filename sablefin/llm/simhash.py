"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint is eight positional bytes. Two fingerprints that differ in at most four bits differ
in at most four bytes, so they share at least four positional bytes: that is the guaranteed minimum
the count filter asks for. Posting lists of single (position, byte) terms would hold 1/256 of the
corpus each, so the index posts *triples* of positions: every set of four positions contains one of
20 triples (a Turan design on eight points), so a pair that reaches the minimum meets in at least
one of 20 lists keyed by 24 bits. Inside a list the shared positional bytes of each pair are
tallied, pairs under the minimum fall away, the rest are verified by Hamming distance, and only a
spanning star of what is linked leaves the task: as many rows as there are members, not pairs.

Equal fingerprints are merged first, so a group of exact copies of any size is one posting.
A list longer than ``list_limit`` isn't read by one task. Its members go another, equally exact
way: two fingerprints lie within four bits if and only if some 64-bit point lies within two bits
of both. Each member posts the 2,081 points around it; all members around one point are mutually
linked, and there are at most 2,081 of them, so these lists can't become hot whatever the data.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.llm.common import spread, table
from sablefin.llm.components import components
from sablefin.llm.jaccard import near_copies
from sablefin.llm.simhash_kernel import fingerprint, linked_pairs
from sablefin.session import settle

MAX_BITS = 4
MIN_BYTES = 8 - MAX_BITS
LIST_LIMIT = 2048


def position_triples() -> list[tuple[int, int, int]]:
    """20 triples of byte positions of which every 4 of the 8 positions contain one.

    Positions fall into three classes. Taken are the triples inside a class and those with two
    positions in a class and one in the next, cyclically.
    """
    classes = [(0, 1, 2), (3, 4, 5), (6, 7)]
    inside = [t for c in classes for t in combinations(c, 3)]
    across = [(*two, one) for k, c in enumerate(classes) for two in combinations(c, 2) for one in classes[(k + 1) % 3]]
    return sorted(tuple(sorted(t)) for t in inside + across)


def with_fingerprint(docs: DataFrame, keep: list[str], width: int, seed: int, text: str = "text") -> DataFrame:
    """``keep`` columns of every row and ``fp`` long, the fingerprint of its whole text's bits.

    Null and wordless texts get zero.
    """
    src = docs.select(*keep, F.col(text).cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            got = [fingerprint(t, width, seed) for t in b.column("_text").to_pylist()]
            fps = pa.array(np.array(got, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), fps], names=[*keep, "fp"])

    schema = docs.select(*keep).schema.add("fp", "long")
    return src.mapInArrow(run, schema)


def _byte(fp: Column, p: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255))


def _postings(fps: DataFrame) -> DataFrame:
    """(key int, fp): a row for each of the 20 lists of each fingerprint."""
    fp = F.col("fp")
    keys = [
        (F.lit(n << 24) + _byte(fp, a) * 65536 + _byte(fp, b) * 256 + _byte(fp, c)).cast("int")
        for n, (a, b, c) in enumerate(position_triples())
    ]
    return fps.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _runs(batches, key: str):
    """(keys, fps) arrays of whole runs of equal keys from a stream sorted by key."""
    rest_k, rest_f = np.empty(0, np.int64), np.empty(0, np.int64)
    for b in batches:
        k = np.concatenate([rest_k, b.column(key).to_numpy(zero_copy_only=False).astype(np.int64)])
        f = np.concatenate([rest_f, b.column("fp").to_numpy(zero_copy_only=False)])
        if not len(k):
            continue
        cut = int(np.searchsorted(k, k[-1], "left"))
        yield k[:cut], f[:cut]
        rest_k, rest_f = k[cut:], f[cut:]
    if len(rest_k):
        yield rest_k, rest_f


def _bounds(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    last = np.r_[first[1:], len(k)]
    many = last - first > 1
    return first[many], last[many]


def _star(fps: np.ndarray, max_bits: int, min_bytes: int):
    """(member, smallest) of each linked set of one list."""
    root = list(range(len(fps)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in linked_pairs(fps.view(np.uint64), max_bits, min_bytes):
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                root[max(x, y)] = min(x, y)
    for x in range(len(fps)):
        if (r := find(x)) != x:
            yield int(fps[x]), int(fps[r])


_EDGE = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edge_batch(edges: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*edges, strict=True) if edges else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_EDGE)


def _list_edges(postings: DataFrame, parts: int, max_bits: int, min_bytes: int) -> DataFrame:
    def run(batches):
        for k, f in _runs(batches, "key"):
            first, last = _bounds(k)
            pair = last - first == 2
            x, y = f[first[pair]], f[first[pair] + 1]
            near = np.bitwise_count((x ^ y).view(np.uint64)) <= max_bits
            yield _edge_batch(list(zip(x[near].tolist(), y[near].tolist(), strict=True)))
            for a, b in zip(first[~pair].tolist(), last[~pair].tolist(), strict=True):
                yield _edge_batch(list(_star(f[a:b], max_bits, min_bytes)))

    return postings.repartition(parts, "key").sortWithinPartitions("key", "fp").mapInArrow(run, "a long, b long")


def ball_masks(radius: int) -> list[int]:
    """All 64-bit masks of at most ``radius`` ones, as signed longs."""
    masks = [sum(1 << p for p in some) for r in range(radius + 1) for some in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _ball_edges(fps: DataFrame, parts: int, max_bits: int) -> DataFrame:
    """Exact links of ``fps`` by shared points within half of ``max_bits`` (even)."""
    masks = np.array(ball_masks(max_bits // 2), np.int64)

    def post(batches):
        for b in batches:
            for f in b.column("fp").to_numpy(zero_copy_only=False):
                yield pa.RecordBatch.from_arrays([pa.array(f ^ masks), pa.array(np.full(len(masks), f))], names=["point", "fp"])

    def meet(batches):
        for k, f in _runs(batches, "point"):
            first, last = _bounds(k)
            yield _edge_batch([(int(x), int(f[a])) for a, b in zip(first.tolist(), last.tolist(), strict=True) for x in f[a + 1 : b]])

    posted = fps.mapInArrow(post, "point long, fp long")
    return posted.repartition(parts, "point").sortWithinPartitions("point", "fp").mapInArrow(meet, "a long, b long").distinct()


def links(fps: DataFrame, max_bits: int = MAX_BITS, list_limit: int = LIST_LIMIT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``fps``(fp): their connected sets are those of
    all pairs within ``max_bits`` (at most 4) bits; transitive links may stand for direct ones."""
    if not 0 <= max_bits <= MAX_BITS or max_bits % 2:
        raise ValueError("max_bits must be 0, 2 or 4: the triples guarantee no more")
    spark = fps.sparkSession
    n = fps.count()
    parts = spread(spark, 20 * n, 2_000_000)
    postings = _postings(fps)
    hot = settle(postings.groupBy("key").count().where(F.col("count") > list_limit).select("key"), "hot-lists")
    if hot.isEmpty():
        return _list_edges(postings, parts, max_bits, MIN_BYTES)
    cold = postings.join(hot, "key", "left_anti")
    dense = settle(postings.join(hot, "key", "left_semi").select("fp").distinct(), "hot-members")
    wide = spread(spark, 2081 * dense.count(), 2_000_000)
    return _list_edges(cold, parts, max_bits, MIN_BYTES).union(_ball_edges(dense, wide, max_bits))


def simhash_components(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, seed: int = 42,
    max_bits: int = MAX_BITS, list_limit: int = LIST_LIMIT, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep``, ``fp`` long, ``component_id``.

    Texts are lower-cased (A-Z), cut into words ``[^\\x20\\x09-\\x0D]+`` and shingles of ``width``
    words (fewer: the whole sequence; none: fingerprint zero, linked like any other). Null texts
    count as empty. ``component_id`` is the smallest doc_id reachable; rows with a null doc_id take
    part and get their component's id, null only if no member has one. Repeated rows stay repeated.
    Other columns of ``docs`` are ignored, whatever their names.
    """
    cols = list(dict.fromkeys([doc_id, *keep]))
    marked = settle(with_fingerprint(docs, cols, width, seed, text), "fingerprints")
    reps = settle(marked.groupBy("fp").agg(F.min(doc_id).alias("_low")), "distinct-fp")
    labels = settle(components(links(reps.select("fp"), max_bits, list_limit)).select(F.col("node").alias("fp"), "label"), "labels")
    linked = reps.join(labels, "fp")
    low = settle(linked.groupBy("label").agg(F.min("_low").alias("_comp")), "component-low")
    wide = settle(linked.join(low, "label").select("fp", "_comp"), "linked-fp")
    target = settle(reps.join(wide, "fp", "left").select("fp", F.when(F.col("_comp").isNull(), F.col("_low")).otherwise(F.col("_comp")).alias("component_id")), "fp-component")
    return marked.join(target.hint("merge"), "fp").select(*cols, "fp", "component_id")


def dedup(docs: DataFrame, width: int = 5) -> DataFrame:
    """``docs``, same columns, without near-copies: of each component the row with the smallest doc_id.

    Near-copies have a Jaccard similarity of 0.8 or more over shingles of ``width`` words. The index here
    gives the texts whose fingerprints link; an exact check of their similarity follows. Near-copies that
    differ in more bits than the index reaches are added by ``jaccard``.
    Rows without a doc_id have no identity to group by and all stay. Of several rows with the keeping
    doc_id one stays, the last in the order of its comparable columns.
    """
    comp = settle(near_copies(docs.select("doc_id", "text"), width=width, links=links), "dedup-components")
    kept = comp.where("doc_id = component_id").groupBy("doc_id").count()
    kept = settle(kept, "dedup-kept")
    # ids grow with the corpus: merged at every size, never broadcast
    once = docs.join(kept.select("doc_id").hint("merge"), "doc_id", "left_semi")
    cols = docs.columns
    if not kept.where("count > 1").isEmpty():
        rest = [c for c in cols if c != "doc_id"]
        order = [f.name for f in docs.schema if f.name in rest and isinstance(f.dataType, T.AtomicType)]
        one = once.groupBy("doc_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
        once = one.select(*(F.col("doc_id") if c == "doc_id" else F.col("_r")[c].alias(c) for c in cols))
    return once.select(*cols).union(docs.where("doc_id is null"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = simhash_components(docs, width=4)
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
