"""Best-fit packing of token sequences by a configuration program.

One pass tokenizes and cuts; it leaves a small row per piece, settled. The length histogram, at
most one count per length, goes to the driver, which solves the plan (see ``packing_plan``). Pieces
then get a rank among those of their length, in two steps so that a length shared by a third
of all pieces isn't ranked by one task: a rank within a hash bucket, plus the number of pieces of that
length in the buckets before. The plan, whose size is bounded by the lengths and not the documents,
maps (length, rank) to a sequence and a place in it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.llm import token_kernel as kernel
from sablefin.llm.common import spread, table
from sablefin.llm.packing_plan import make_plan
from sablefin.session import settle

CAPACITY = 4096
END_ID = 1


def tokenized(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece: ``doc_id``, piece int, start, length, ids_crc32 (long).

    A document is its ids and ``end_id``; only documents over ``capacity`` are cut. Null texts are empty:
    one piece of one token. Repeated rows give repeated pieces.
    """
    src = docs.select(doc_id, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        encoder = kernel.encoder(path)
        for b in batches:
            rows, out = [], []
            for k, t in enumerate(b.column("_text").to_pylist()):
                for p in kernel.pieces(encoder.ids(t), end_id, capacity):
                    rows.append(k)
                    out.append(p)
            piece, start, length, crc = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column(doc_id).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=[doc_id, "piece", "start", "length", "ids_crc32"],
            )

    schema = docs.select(doc_id).schema.add("piece", "integer").add("start", "long").add("length", "long").add("ids_crc32", "long")
    return src.mapInArrow(run, schema)


def _ranked(pieces: DataFrame, doc_id: str) -> DataFrame:
    """``pieces`` with ``_rank``, from 0 within each length."""
    spark = pieces.sparkSession
    n = pieces.count()
    buckets = max(64, -(-n // 200_000))
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64(doc_id, "piece", "ids_crc32"), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = pieces.groupBy("length", "_bucket").count()
    starts = settle(counts.select(F.col("length").alias("_l"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start")), "length-starts")
    inside = Window.partitionBy("length", "_bucket").orderBy(doc_id, "piece", "ids_crc32")
    # starts have a row a length and bucket, so they grow with the pieces: merged at every size
    ranked = pieces.repartition(spread(spark, n, 1_000_000), "length", "_bucket").withColumn("_in", F.row_number().over(inside) - 1)
    return ranked.join(starts.hint("merge"), (F.col("length") == F.col("_l")) & (F.col("_bucket") == F.col("_b"))).withColumn("_rank", F.col("_start") + F.col("_in"))


def pack(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece: ``doc_id``, piece, start, length, ids_crc32, sequence_id, offset (long).

    Sequences hold at most ``capacity`` tokens, pieces gapless from offset 0. An empty table gives an
    empty result. Rows with equal or null ids stay apart.
    """
    spark = docs.sparkSession
    pieces = settle(tokenized(docs, path, doc_id, text, capacity, end_id), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    whole = int(counts[capacity])
    counts[capacity] = 0
    segments, _ = make_plan(counts, capacity)
    if whole:  # full pieces fill a sequence each, before the others
        segments[:, 4] += whole
        segments = np.vstack([segments, [[capacity, 0, whole, 1, 0, 0]]])
    segments = segments[np.lexsort((segments[:, 1], segments[:, 0]))] if len(segments) else segments
    plan = spark.sparkContext.broadcast(segments)  # bounded by the lengths: a few segments each

    cols = [doc_id, "piece", "start", "length", "ids_crc32"]

    def place(batches):
        seg = plan.value
        key = seg[:, 0] * (1 << 44) + seg[:, 1]
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("_rank").to_numpy()
            s = seg[np.searchsorted(key, length * (1 << 44) + rank, "right") - 1]
            nth = rank - s[:, 1]
            sequence, offset = s[:, 4] + nth // s[:, 3], s[:, 5] + nth % s[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in cols), pa.array(sequence), pa.array(offset)], names=[*cols, "sequence_id", "offset"])

    ranked = _ranked(pieces, doc_id).select(*cols, F.col("_rank").cast("long").alias("_rank"))
    return ranked.mapInArrow(place, pieces.schema.add("sequence_id", "long").add("offset", "long"))


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), kernel.default_path())
