"""Token counts: pieces counted once per distinct pre-token, joined to per-document frequencies.

No token ids are kept. A first pass finds the pre-tokens that make up most of the corpus with
a mergeable heavy-hitter summary; their piece counts form a table of at most ``head`` rows and a bounded
number of bytes that every task can hold. A second pass turns each document into pre-token frequencies and joins
them to that table on the spot. What it doesn't hold goes the exact way for the rest: (row,
pre-token, frequency) is shuffled by pre-token, counted once per distinct one in sorted runs, and
summed by row. A pre-token of the rest can't be hot, because every hot one is a heavy hitter, however
long, up to ``HUGE`` bytes; longer ones cost less to count where they are found than to move, and are.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.llm import token_kernel as kernel
from sablefin.llm.common import spread, table
from sablefin.session import settle

HEAD = 200_000
LOCAL = 40_000
LIMIT = 2048
_PRUNE = 600_000
#: Pre-tokens over this many bytes are counted on the spot.
HUGE = 65_536
#: Bytes of pre-tokens that the held table and a task's report may have.
HELD_BYTES, REPORT_BYTES = 64 << 20, 16 << 20


def heavy_hitters(texts: DataFrame, head: int, local: int, held_bytes: int = HELD_BYTES) -> list[bytes]:
    """At most ``head`` pre-tokens (bytes) of ``texts``(text binary), by frequency over all rows, of ``held_bytes`` in all.

    A task counts every pre-token it sees. Past a bound on memory it forgets those seen
    once, and it reports its ``local`` most frequent: a pre-token with a share of the corpus above
    1/``local`` is never missed. Only a choice of what to hold in memory depends on this list.
    """

    def run(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in b.column("text").to_pylist():
                seen.update(p for p in kernel.parts(t or b"") if len(p) <= HUGE)
                if len(seen) > _PRUNE:
                    floor = 1
                    while len(seen) > _PRUNE // 2:
                        seen = Counter({p: n for p, n in seen.items() if n > floor})
                        floor *= 2
        top, room = [], REPORT_BYTES  # the most frequent first; the rest of the room goes to shorter ones
        for p, n in seen.most_common(local):
            if len(p) <= room:
                top.append((p, n))
                room -= len(p)
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], names=["p", "n"])

    got = settle(texts.mapInArrow(run, "p binary, n long").groupBy("p").agg(F.sum("n").alias("n")), "heavy-hitters")
    # the least frequency of which at most ``head`` have as much, from a histogram of a few hundred cells;
    # a sort would send every task's best to the driver
    low = F.greatest(F.length(F.bin("n")) - 5, F.lit(0))
    cell = F.call_function("shiftleft", F.call_function("shiftright", F.col("n"), low), low)
    least, held, room = None, 0, held_bytes
    for r in sorted(got.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("count"), F.sum(F.octet_length("p")).alias("bytes")).collect(), key=lambda r: -r["c"]):
        held += r["count"]
        room -= r["bytes"]
        if held > head or room < 0:
            break
        least = r["c"]
    return [] if least is None else sorted(bytes(r["p"]) for r in got.where(F.col("n") >= least).select("p").collect())


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), head: int = HEAD, local: int = LOCAL,
) -> DataFrame:
    """One row per row of ``docs``: ``keep``, n_bytes, n_tokens (long).

    Counts are those of the library's own encoding of the whole text without added special tokens;
    special strings inside a text count as the library reads them by default. Null and empty texts
    have none. Rows with equal or null ids stay apart.
    """
    spark = docs.sparkSession
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    held = heavy_hitters(docs.select(body.alias("text")), head, local)
    table_ = spark.sparkContext.broadcast(dict(zip(held, kernel.count_pieces(path, held), strict=True)))  # at most ``head`` short strings

    def run(batches):
        known = table_.value
        for b in batches:
            sums, rest, sizes = [], [], []
            for t in b.column("_text").to_pylist():
                t = t or b""
                total, other = 0, []
                for p, n in kernel.frequencies(t).items():
                    k = known.get(p)
                    if k is None and len(p) > HUGE:
                        k = kernel.count_pieces(path, [p])[0]
                    if k is None:
                        other.append({"p": p, "n": n})
                    else:
                        total += k * n
                sums.append(total)
                rest.append(other)
                sizes.append(len(t))
            yield pa.RecordBatch.from_arrays(
                [b.column("_row"), b.column("_keep"), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(rest, pa.list_(pa.struct([("p", pa.binary()), ("n", pa.int64())])))],
                names=["_row", "_keep", "n_bytes", "_sum", "_rest"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(c) for c in keep)).alias("_keep"), body.alias("_text"))
    schema = rows.select("_row", "_keep").schema.add("n_bytes", "long").add("_sum", "long").add("_rest", T.ArrayType(T.StructType().add("p", "binary").add("n", "long")))
    rows = settle(rows.mapInArrow(run, schema), "token-frequencies")
    tail = rows.select("_row", F.explode("_rest").alias("_e")).select("_row", "_e.p", "_e.n")
    size = rows.agg(F.sum(F.size("_rest"))).first()[0] or 0

    def match(batches):
        last, pieces = None, 0
        for b in batches:
            ps, out = b.column("p").to_pylist(), []
            fresh = list(dict.fromkeys(p for p in ps if p != last))
            counts = dict(zip(fresh, kernel.count_pieces(path, fresh), strict=True))
            for p in ps:
                if p != last:
                    last, pieces = p, counts[p]
                out.append(pieces)
            yield pa.RecordBatch.from_arrays([b.column("_row"), pc.multiply(pa.array(out, pa.int64()), b.column("n"))], names=["_row", "m"])

    dealt = tail.repartition(spread(spark, size, 2_000_000), "p").sortWithinPartitions("p")
    more = dealt.mapInArrow(match, "_row long, m long").groupBy("_row").agg(F.sum("m").alias("m")).withColumnRenamed("_row", "_r")
    slim = rows.select("_row", "_keep", "n_bytes", "_sum")
    out = slim.join(more, F.col("_row") == F.col("_r"), "left")
    return out.select("_keep.*", "n_bytes", (F.col("_sum") + F.coalesce("m", F.lit(0))).alias("n_tokens"))


def op7_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = count_tokens(table(spark, sf_dir, "documents"), kernel.default_path())
    return got.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
