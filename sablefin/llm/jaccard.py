"""Near copies: documents whose sets of word shingles have a Jaccard similarity of 0.8 or more.

Given the SimHash operator's ``links``, texts whose fingerprints it links come first: they are verified on
the exact sets and joined into components. Most pairs near 0.8 differ in more bits than it reaches. Those
meet in lists keyed by bands of minima, of which only pairs that the fingerprints left apart are verified,
on the exact sets too, so nothing below 0.8 is linked. A pair at 0.8 fails to meet in a band with a
probability of 5e-8 (1 - 0.8^4 in each of 32 bands), a closer one with less.

Texts of equal words are merged first. A list of at most ``list_limit`` members posts all its pairs.
A longer one first posts a star and a chain, as many pairs as members. Once those are verified and
joined into components, the lists that still hold unlike labels are read with their sets: a task
compares members of unlike labels exactly and returns a link for each two components that meet, fewer
rows than members. Lists over an eighth of ``block`` members are compared by pairs of blocks.

Sets aren't stored for all documents: a second pass over the texts builds those of candidates only,
picked by a bloom filter of fixed size; the join drops what it lets through by chance.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.llm import jaccard_kernel as kernel
from sablefin.llm.common import spread
from sablefin.llm.components import components
from sablefin.llm.simhash_kernel import majority, shingle_hashes
from sablefin.session import settle

LIST_LIMIT = 16
BLOCK = 4096
_BITS = 25
_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _marked(docs: DataFrame, doc_id: str, text: str, width: int, seed: int) -> DataFrame:
    src = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            texts = b.column("_text").to_pylist()
            fps, sets = [], []
            for t in texts:
                hashes = shingle_hashes(t or b"", width, seed)
                fps.append(majority(hashes))
                sets.append(np.unique(hashes))
            made = [
                pa.array([kernel.identity(t, seed) for t in texts], pa.int64()), pa.array(map(len, sets), pa.int64()),
                pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(map(kernel.bands, sets), pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *made], names=["doc_id", "w", "n", "fp", "bands"])

    schema = src.select("doc_id").schema.add("w", "long").add("n", "long").add("fp", "long").add("bands", T.ArrayType(T.LongType()))
    return src.mapInArrow(run, schema)


def _lists(batches):
    """Tables of one key's rows each, at least two, from a stream sorted by key."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = (t if rest is None else pa.concat_tables([rest, t])).combine_chunks()
        if not t.num_rows:
            continue
        k = t.column("key").to_numpy()
        first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        last = np.r_[first[1:], len(k)]
        for x, y in zip(first[:-1].tolist(), last[:-1].tolist(), strict=True):
            if y - x > 1:
                yield t.slice(x, y - x)
        rest = t.slice(int(first[-1]))
    if rest is not None and rest.num_rows > 1:
        yield rest


def _pairs_of(table: pa.Table, i, j) -> pa.RecordBatch:
    w = table.column("w").to_numpy()
    x, y = w[np.asarray(i, np.int64)], w[np.asarray(j, np.int64)]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], schema=_PAIR)


def _first_pairs(postings: DataFrame, parts: int, limit: int) -> DataFrame:
    def run(batches):
        for t in _lists(batches):
            m, n = t.num_rows, t.column("n").to_numpy()
            pairs = list(combinations(range(m), 2)) if m <= limit else [(0, k) for k in range(1, m)] + [(k, k + 1) for k in range(1, m - 1)]
            i, j = np.array(pairs).T
            fits = kernel.similar(np.minimum(n[i], n[j]), n[i], n[j])
            yield _pairs_of(t, i[fits], j[fits])

    return postings.repartition(parts, "key").sortWithinPartitions("key", "w").mapInArrow(run, "a long, b long").distinct()


def _print_pairs(reps: DataFrame, links: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Pairs of texts whose fingerprints are equal or linked by ``links``: a star for each fingerprint, a pair for each
    edge between two."""
    least = settle(reps.groupBy("fp").agg(F.min("w").alias("m")), "print-texts")
    same = reps.select("fp", "w").join(least.hint("merge"), "fp").where("w <> m").select(F.col("m").alias("a"), F.col("w").alias("b"))
    left, right = (least.select(F.col("fp").alias(c), F.col("m").alias(f"_{c}")) for c in "ab")
    near = links(least.select("fp")).join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return same.union(near.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose ends ``labels``(w, label) doesn't join."""
    x, y = (labels.select(F.col("w").alias(c), F.col("label").alias(f"_{c}")) for c in "ab")
    both = pairs.join(x.hint("merge"), "a", "left").join(y.hint("merge"), "b", "left")
    return both.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _rest_edges(members: DataFrame, sets: DataFrame, parts: int, block: int) -> DataFrame:
    """Links between unlike labels of each list of ``members``(key, w, label)."""
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("l"), F.max("label").alias("h"))
    # lists of middling size are cut in about four, so that no task has a whole one; longer ones by ``block``
    own_block = F.least(F.lit(float(block)), F.greatest(F.lit(block / 8), F.col("m") / 4))
    sizes = sizes.where("l <> h").select("key", F.ceil(F.col("m") / own_block).cast("int").alias("_blocks"))
    own, last = F.pmod(F.xxhash64("w"), F.col("_blocks")), F.col("_blocks") - 1
    dealt = members.join(sizes.hint("merge"), "key").select(
        "key", "w", "label", own.alias("_own"), F.explode(F.sequence(F.lit(0), last)).alias("_other")
    )
    key = F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other"))
    whole = dealt.select(key.alias("key"), "w", "label").join(sets.hint("merge"), "w").select("key", "w", "label", "hashes")

    def run(batches):
        for t in _lists(batches):
            label = t.column("label").to_numpy()
            if (label != label[0]).any():
                links = kernel.bridges(label, t.column("hashes").to_pylist())
                if links:
                    yield _pairs_of(t, *np.array(links).T)

    return whole.repartition(parts, "key").sortWithinPartitions("key", "w").mapInArrow(run, "a long, b long").distinct()


def _bits(ids: DataFrame) -> bytes:
    """A bloom filter of ``ids``(w), of fixed size whatever their number."""

    def run(batches):
        bits = np.zeros(1 << _BITS, bool)
        for b in batches:
            for p in _places(b.column("w").to_numpy()):
                bits[p] = True
        yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])

    out = np.zeros(1 << (_BITS - 3), np.uint8)
    for r in ids.coalesce(8).mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(r["bits"], np.uint8)
    return out.tobytes()


def _places(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << _BITS) - 1
    return w & mask, (w >> 32) & mask


def _sets(docs: DataFrame, ids: DataFrame, text: str, width: int, seed: int) -> DataFrame:
    """(w, hashes): the sorted shingle hashes of ``ids``(w)."""
    held = docs.sparkSession.sparkContext.broadcast(_bits(ids))  # of fixed size

    def run(batches):
        bits, seen = np.frombuffer(held.value, np.uint8), set()
        for b in batches:
            texts = b.column("_text").to_pylist()
            w = np.array([kernel.identity(t, seed) for t in texts], np.int64)
            p, q = _places(w)
            may = (bits[p >> 3] >> (7 - (p & 7)) & 1) & (bits[q >> 3] >> (7 - (q & 7)) & 1)
            fresh = []
            for k in np.flatnonzero(may).tolist():
                if (x := int(w[k])) not in seen:
                    seen.add(x)
                    fresh.append(k)
            sets = [kernel.shingle_set(texts[k], width, seed).astype("<u8").tobytes() for k in fresh]
            yield pa.RecordBatch.from_arrays([pa.array(w[fresh], pa.int64()), pa.array(sets, pa.binary())], names=["w", "hashes"])

    found = docs.select(F.col(text).cast("binary").alias("_text")).mapInArrow(run, "w long, hashes binary")
    return settle(found.join(ids.hint("merge"), "w", "left_semi").groupBy("w").agg(F.first("hashes").alias("hashes")), "candidate-sets")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    left = sets.select(F.col("w").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("w").alias("b"), F.col("hashes").alias("y"))
    both = pairs.join(left.hint("merge"), "a").join(right.hint("merge"), "b").select("a", "b", "x", "y")

    def run(batches):
        for b in batches:
            ok = [kernel.near(x, y) for x, y in zip(b.column("x").to_pylist(), b.column("y").to_pylist(), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, seed: int = 42, list_limit: int = LIST_LIMIT, block: int = BLOCK,
    links: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id`` and ``component_id``, the smallest doc_id reachable
    over pairs whose shingle sets have a Jaccard similarity of 0.8 or more.

    Words and shingles are those of the SimHash operator. Texts without words are copies of each
    other. Rows with a null doc_id take part. ``links``: edges (a, b) between near ones of distinct
    fingerprints (fp), tried before the bands.
    """
    spark = docs.sparkSession
    marked = settle(_marked(docs, doc_id, text, width, seed), "shingle-bands")
    reps = marked.groupBy("w").agg(F.min("doc_id").alias("_low"), *(F.first(c).alias(c) for c in ("n", "fp", "bands")))
    reps = settle(reps, "distinct-texts")
    postings = reps.select(F.explode("bands").alias("key"), "w", "n")
    parts = spread(spark, kernel.BANDS * reps.count(), 2_000_000)
    pairs = settle(_first_pairs(postings, parts, list_limit), "near-pairs")
    hot = settle(postings.groupBy("key").count().where(F.col("count") > list_limit).select("key"), "hot-bands")
    members = settle(postings.join(hot.hint("merge"), "key").select("key", "w"), "hot-members")
    prints = pairs.limit(0) if links is None else settle(_print_pairs(reps, links), "print-pairs")
    ids = pairs.union(prints).select(F.explode(F.array("a", "b")).alias("w")).union(members.select("w")).distinct()
    sets = _sets(docs, settle(ids, "candidates"), text, width, seed)
    if links is None:
        edges = settle(_verified(pairs, sets), "near-edges")
    else:
        linked = settle(_verified(prints, sets), "print-edges")
        known = settle(components(linked).select(F.col("node").alias("w"), "label"), "print-labels")
        edges = linked.union(settle(_verified(_apart(pairs, known), sets), "near-edges"))
    labels = settle(components(edges).select(F.col("node").alias("w"), "label"), "near-labels")
    if not hot.isEmpty():
        marked_members = members.join(labels.hint("merge"), "w", "left").select("key", "w", F.coalesce("label", "w").alias("label"))
        more = settle(_rest_edges(settle(marked_members, "hot-labels"), sets, parts, block), "far-edges")
        labels = settle(components(edges.union(more)).select(F.col("node").alias("w"), "label"), "all-labels")
    linked = reps.select("w", "_low").join(labels, "w")
    low = settle(linked.groupBy("label").agg(F.min("_low").alias("_comp")), "near-low")
    wide = linked.join(low, "label").select("w", "_comp")
    target = reps.select("w", "_low").join(wide, "w", "left")
    target = settle(target.select("w", F.when(F.col("_comp").isNull(), F.col("_low")).otherwise(F.col("_comp")).alias("component_id")), "near-component")
    return marked.select("doc_id", "w").join(target.hint("merge"), "w").select(F.col("doc_id").alias(doc_id), "component_id")
