"""Vector code compression: product codes from codebooks learned by integer k-means.

Vectors are cut into equal parts; each part position has a codebook of at most 256 entries. A round
assigns every part to its nearest entry in tasks (``code_kernel``: annular norm pruning), adds up counts
and sums a task and entry, and folds those by a small aggregation. What reaches the driver and goes to
tasks is the codebooks: entries times width, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.llm import code_kernel as kernel
from sablefin.llm.common import table
from sablefin.llm.topk import usable
from sablefin.session import settle

PARTS = 4
ENTRIES = 256
ROUNDS = 4
FACTOR = 1024
#: Scaled components lie within this on both sides.
MOST = 1 << 62
LONG = (1 << 63) - 1


def scaled(v: Column, factor: int) -> Column:
    """floor(``factor`` x) of each component as long, within MOST."""
    bound = F.lit(float(MOST))
    return F.transform(v, lambda x: F.floor(F.greatest(F.least(x.cast("double") * factor, bound), -bound)).cast("long"))


def _matrix(v: pa.ListArray, width: int) -> np.ndarray:
    """Rows of integers, short ones filled up with zeros."""
    lengths = np.asarray(pc.list_value_length(v).to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(v.flatten().to_numpy(zero_copy_only=False), np.int64)
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _assign(books: list[kernel.Codebook], x: np.ndarray):
    """(index, squared distance) by part."""
    w = x.shape[1] // len(books)
    return [b.nearest(x[:, p * w : (p + 1) * w]) for p, b in enumerate(books)]


def _count(rows: DataFrame, books: list[np.ndarray], width: int) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """(part, entry) -> count and sums of the vectors' parts assigned to it. The result has a row per
    entry, whatever the number of rows; tasks hand over one row per entry they used."""
    held = rows.sparkSession.sparkContext.broadcast(books)  # entries x width integers

    def run(batches):
        own = [kernel.Codebook(b) for b in held.value]
        w = width // len(own)
        counts = [np.zeros(len(b.entries), np.int64) for b in own]
        totals = [np.zeros((len(b.entries), w), object) for b in own]
        for b in batches:
            x = _matrix(b.column("_v"), width)
            for p, (index, _) in enumerate(_assign(own, x)):
                n, s = kernel.sums(x[:, p * w : (p + 1) * w], index, len(own[p].entries))
                counts[p] += n
                totals[p] += s
        out = [(p, e, int(n), [int(t) for t in totals[p][e]]) for p in range(len(own)) for e, n in enumerate(counts[p]) if n]
        part, entry, n, s = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(part, pa.int32()), pa.array(entry, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.list_(pa.decimal128(38, 0)))],
            names=["part", "entry", "n", "s"],
        )

    each = rows.select("_v").mapInArrow(run, "part int, entry int, n long, s array<decimal(38,0)>")
    flat = each.select("part", "entry", F.posexplode(F.concat(F.array(F.col("n").cast("decimal(38,0)")), "s")).alias("at", "x"))
    total = flat.groupBy("part", "entry", "at").agg(F.sum("x").cast("decimal(38,0)").alias("x"))
    folded = total.groupBy("part", "entry").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("s"))  # ``at`` is below the width
    got = {}
    for r in folded.collect():  # parts x entries rows
        n, *s = (int(x["x"]) for x in r["s"])
        got[r["part"], r["entry"]] = (n, s)
    return got


def learn(rows: DataFrame, width: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks by part from ``rows``(_id, _v): they start as the parts of the ``entries`` smallest ids (null ids
    last, ties by components) and take floored means ``rounds`` times; unused entries stay."""
    first = rows.orderBy(F.asc_nulls_last("_id"), "_v").limit(entries).select("_v").collect()  # ``entries`` rows
    start = np.zeros((len(first), width), np.int64)
    for k, r in enumerate(first):
        start[k, : len(r["_v"])] = r["_v"]
    w = width // parts
    books = [start[:, p * w : (p + 1) * w].copy() for p in range(parts)]
    for _ in range(rounds):
        for (p, e), (n, s) in _count(rows, books, width).items():
            books[p][e] = [x // n for x in s]
    return books


def encode(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", keep: tuple[str, ...] = ("vec_id",),
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR,
) -> DataFrame:
    """One row per vector that takes part: ``keep``, codes array<int>, code (two hex digits a part), error (long),
    label_error (long), codebooks_sha256.

    Vectors that are null or hold null or non-finite components are dropped. Shorter vectors count as
    padded with zeros to the longest, and all to a multiple of ``parts``; empty ones are zero vectors.
    Components beyond 2^62 after scaling count as 2^62. Errors are exact; one that a long can't hold is the largest
    long. Repeated rows stay repeated; null labels are one label. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    kept = vectors.where(usable(F.col(vector))).select(
        F.struct(*(F.col(c) for c in keep)).alias("_keep"), F.col(vec_id).cast("long").alias("_id"), F.col(label).alias("_label"), scaled(F.col(vector), factor).alias("_v"),
    )
    rows = settle(kept, "code-vectors")
    width = rows.agg(F.max(F.size("_v"))).first()[0] or 0
    width = max(-(-width // parts) * parts, parts)
    books = learn(rows, width, parts, entries, rounds)
    mark = hashlib.sha256(",".join(str(int(x)) for b in books for e in b for x in e).encode()).hexdigest()
    held = spark.sparkContext.broadcast(books)

    def run(batches):
        own = [kernel.Codebook(b) for b in held.value]
        for b in batches:
            got = _assign(own, _matrix(b.column("_v"), width))
            codes = np.stack([i for i, _ in got], axis=1).reshape(-1)
            error = sum(s.astype(object) for _, s in got)
            error = pa.array([min(int(x), LONG) for x in error], pa.int64())
            at = pa.array(np.arange(b.num_rows + 1) * len(own), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("_keep"), b.column("_label"), pa.ListArray.from_arrays(at, pa.array(codes, pa.int32())), error], names=["_keep", "_label", "codes", "error"])

    schema = rows.select("_keep", "_label").schema.add("codes", T.ArrayType(T.IntegerType())).add("error", "long")
    coded = settle(rows.select("_keep", "_label", "_v").mapInArrow(run, schema), "codes")
    # a row per label: sums fold before they shuffle; a hot label's rows stay where they are if the sums are few
    per = coded.groupBy("_label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("_sum"))
    per = settle(per.select(F.col("_label").alias("_l"), F.least("_sum", F.lit(LONG).cast("decimal(38,0)")).cast("long").alias("label_error")), "label-errors")
    out = coded.join(per, F.col("_label").eqNullSafe(F.col("_l")))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return out.select("_keep.*", "codes", code.alias("code"), "error", "label_error", F.lit(mark).alias("codebooks_sha256"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, factor: int = FACTOR) -> str:
    nearest = """near{k} AS MATERIALIZED (SELECT r, part, arg_min(entry, d * 1000 + entry) AS entry, min(d) AS d FROM (
  SELECT p.r, p.part, b.entry, list_sum(list_transform(list_zip(p.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM part p JOIN book{k} b USING (part)) GROUP BY r, part)"""
    book = """book{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
  SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY place) AS x FROM (SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM (
    SELECT part, entry, unnest(x) AS x, generate_subscripts(x, 1) AS place FROM near{k} JOIN part USING (r, part)) GROUP BY part, entry, place) GROUP BY part, entry) m USING (part, entry))"""
    steps = [nearest.format(k=0)]
    for k in range(rounds):
        steps += [book.format(k=k, n=k + 1), nearest.format(k=k + 1)]
    return f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({factor} * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
part AS MATERIALIZED (SELECT r, p AS part, e[p * (len(e) // {parts}) + 1:(p + 1) * (len(e) // {parts})] AS x FROM v, range({parts}) t(p)),
first AS MATERIALIZED (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v QUALIFY entry < {entries}),
book0 AS MATERIALIZED (SELECT part, entry, x FROM first JOIN part USING (r)), {", ".join(steps)},
coded AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY r),
mark AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS m FROM book{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, (SELECT m FROM mark) AS codebooks_sha256 FROM coded JOIN v USING (r)"""


ORACLE = _oracle()
