"""Information-theoretic sanitisation of personal data.

Patterns find the protected entities. The corpus then tells which words near them give them away
(Sanchez & Batet, "C-sanitized", 2016): with document frequencies over all documents, the pointwise
mutual information PMI(e; t) = ln(df(e,t) N / (df(e) df(t))) is how much of the entity's information
IC(e) = ln(N / df(e)) the term t reveals. A term that reveals at least ``remove_at`` of it beside
that entity is removed, one that reveals at least ``general_at`` is generalised. Evidence must come
from ``support`` different windows, so that copies of one passage prove nothing.

Two passes read texts. The first leaves spans and contexts, settled. Pairs with enough support name
candidate terms; a bloom filter of bounded size, made by tasks, carries them to the second pass, which counts their
document frequency over the whole corpus; false positives fall out in the join. Tallies fold before
they are shuffled, so an entity that a third of all rows hold costs a few partial sums.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.llm import pii_kernel as kernel
from sablefin.llm.common import replaced, table
from sablefin.session import settle

WIDTH, REACH, LEAST = 5, 256, 3
SUPPORT = 3
GENERAL_AT, REMOVE_AT = 0.6, 0.9
#: Kinds in written order; the last two are what the method adds.
KINDS = (*kernel.KINDS, "generalised", "removed")

_SPANS = T.ArrayType(T.StructType().add("start", "integer").add("rank", "integer").add("end", "integer"))
_NEAR = T.ArrayType(T.StructType().add("e", "long").add("t", "string").add("start", "integer").add("end", "integer").add("window", "long"))


def _found(docs: DataFrame, keep: tuple[str, ...], text: str, width: int, reach: int, least: int) -> DataFrame:
    src = docs.select(F.monotonically_increasing_id().alias("_row"), F.struct(*(F.col(c) for c in keep)).alias("_keep"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("rank", pa.int32()), ("end", pa.int32())]))
    near_type = pa.list_(pa.struct([("e", pa.int64()), ("t", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("window", pa.int64())]))

    def run(batches):
        for b in batches:
            spans, near = [], []
            for t in b.column("_text").to_pylist():
                own = kernel.base_spans(t)
                spans.append([{"start": a, "rank": k, "end": z} for a, k, z in own])
                near.append([dict(zip(("e", "t", "start", "end", "window"), x, strict=True)) for x in kernel.contexts(t, own, width, reach, least)] if own else [])
            yield pa.RecordBatch.from_arrays([b.column("_row"), b.column("_keep"), pa.array(spans, span_type), pa.array(near, near_type)], names=["_row", "_keep", "_spans", "_near"])

    return src.mapInArrow(run, src.select("_row", "_keep").schema.add("_spans", _SPANS).add("_near", _NEAR))


def document_frequency(texts: DataFrame, bloom: kernel.Bloom) -> DataFrame:
    """(t, df): rows of ``texts``(text) that hold each term the filter lets pass."""
    held = texts.sparkSession.sparkContext.broadcast(bloom)  # of bounded size

    def flush(tally: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(tally), pa.string()), pa.array(list(tally.values()), pa.int64())], names=["t", "n"])

    def run(batches):
        maybe, tally = held.value, Counter()
        memo: dict[str, str] = {}
        for b in batches:
            for text in b.column("text").to_pylist():
                mine = set()
                for w in set(kernel._WORD.findall(text)):
                    t = memo.get(w)
                    if t is None:
                        t = kernel.term(w)
                        t = t if t in maybe else ""
                        if len(memo) > 300_000:
                            memo.clear()
                        if len(w) < 100:
                            memo[w] = t
                    if t:
                        mine.add(t)
                tally.update(mine)
            if len(tally) > 200_000:
                yield flush(tally)
                tally = Counter()
        yield flush(tally)

    return texts.mapInArrow(run, "t string, n long").groupBy("t").agg(F.sum("n").alias("df"))


def candidate_filter(terms: DataFrame) -> kernel.Bloom:
    """A filter that lets every one of ``terms``(_t) pass and few others. Tasks set its bits, which fold before they are shuffled;
    the driver gets its words, whose number follows from that of the terms and has a bound."""
    log2 = kernel.log2_bits(terms.count())
    h, mask = F.xxhash64("_t"), (1 << log2) - 1
    place = F.explode(F.array(h.bitwiseAND(F.lit(mask)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(mask)))).alias("p")
    word = F.shiftright("p", 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(F.lit(63)).cast("int"))
    got = terms.select(place).groupBy(word.cast("int").alias("w")).agg(F.bit_or(bit).alias("bits"))
    return kernel.Bloom(log2, [(r["w"], r["bits"]) for r in got.collect()])


def disclosing(rows: DataFrame, texts: DataFrame, support: int, general_at: float, remove_at: float) -> DataFrame:
    """(e, t, rank): pairs whose term discloses the entity, with the rank of the verdict's kind."""
    spark = rows.sparkSession
    n = rows.count()
    # one row per document and pair (its first window), one per document and entity
    own = rows.where(F.size("_near") > 0).select(F.explode(F.array_distinct(F.transform("_near", lambda x: F.struct(x["e"].alias("e"), x["t"].alias("t"), x["window"].alias("w"))))).alias("p"), "_row").select("_row", "p.e", "p.t", "p.w")
    per_window = own.groupBy("e", "t", "w", "_row").count().groupBy("e", "t", "w").agg(F.count(F.lit(1)).alias("docs"))
    pairs = per_window.groupBy("e", "t").agg(F.sum("docs").alias("both"), F.count(F.lit(1)).alias("windows")).where(F.col("windows") >= support)
    pairs = settle(pairs.select(F.col("e").alias("_e"), F.col("t").alias("_t"), "both"), "pii-pairs")
    ent = rows.where(F.size("_near") > 0).select(F.explode(F.array_distinct(F.transform("_near", lambda x: x["e"]))).alias("e")).groupBy("e").agg(F.count(F.lit(1)).alias("df_e"))
    df = document_frequency(texts, candidate_filter(settle(pairs.select("_t").distinct(), "pii-terms")))
    scored = pairs.join(df, F.col("_t") == F.col("t")).join(ent, F.col("_e") == F.col("e"))
    pmi = F.log(F.least(F.col("both"), F.col("df"), F.col("df_e")) * F.lit(float(n)) / (F.col("df_e") * F.col("df")))
    ic = F.log(F.lit(float(n)) / F.col("df_e"))
    ratio = F.when(ic > 0, pmi / ic).otherwise(0.0)
    rank = F.when(ratio >= remove_at, KINDS.index("removed")).when(ratio >= general_at, KINDS.index("generalised"))
    return settle(scored.select("_e", "_t", rank.alias("_rank")).where(F.col("_rank").isNotNull()), "pii-disclosing")


def find(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **how) -> DataFrame:
    """One row per row of ``docs``: ``keep`` and ``spans``: array<struct(start, rank, end)> in order, rank
    an index into KINDS.

    Null texts are empty. Rows with equal or null ids stay apart. A document without protected entities
    gets no spans at all: terms disclose only beside the entity they disclose.
    """
    return _located(docs, keep, **how).select("_keep.*", "spans")


def _located(
    docs: DataFrame, keep: tuple[str, ...], text: str = "text", width: int = WIDTH, reach: int = REACH, least: int = LEAST,
    support: int = SUPPORT, general_at: float = GENERAL_AT, remove_at: float = REMOVE_AT,
) -> DataFrame:
    rows = settle(_found(docs, keep, text, width, reach, least), "pii-found")
    texts = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    bad = disclosing(rows, texts, support, general_at, remove_at)
    near = rows.where(F.size("_near") > 0).select("_row", F.explode("_near").alias("x")).select("_row", "x.e", "x.t", "x.start", "x.end")
    hit = near.join(bad, (F.col("e") == F.col("_e")) & (F.col("t") == F.col("_t")))
    more = hit.groupBy(F.col("_row").alias("_r")).agg(F.collect_set(F.struct("start", F.col("_rank").alias("rank"), "end")).alias("_more"))
    more = more.select("_r", F.col("_more").cast(_SPANS).alias("_more"))
    slim = rows.select("_row", "_keep", "_spans")
    out = slim.join(more, F.col("_row") == F.col("_r"), "left")

    def strongest(spans):  # one word near two entities can have both verdicts: removal counts
        return F.filter(spans, lambda s: ~((s["rank"] == KINDS.index("generalised")) & F.exists(spans, lambda o: (o["rank"] == KINDS.index("removed")) & (o["start"] == s["start"]))))

    every = F.when(F.col("_more").isNull(), F.col("_spans")).otherwise(F.sort_array(F.concat("_spans", strongest(F.col("_more")))))
    return out.select("_keep", every.alias("spans"))


def sanitise(docs: DataFrame, text: str = "text", **how) -> DataFrame:
    """``docs``, same columns: entities become their kind in brackets, generalised terms their shape,
    removed terms vanish. Overlapping spans are cut once, by the earliest."""
    cols = docs.columns
    got = _located(docs, tuple(cols), text=text, **how)
    body = F.col("_keep")[text]

    def instead(s, word):
        shape = F.when(word.rlike("[0-9]"), "[NUMBER]").when(word.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
        name = F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, kernel.KINDS)), F.least(s["rank"], F.lit(3)) + 1)), F.lit("]"))
        return F.when(s["rank"] < 4, name).when(s["rank"] == KINDS.index("generalised"), shape).otherwise("")

    cut = replaced(body, F.col("spans"), instead)
    return got.select(*(F.when(F.size("spans") > 0, cut).otherwise(body).alias(c) if c == text else F.col("_keep")[c].alias(c) for c in cols))


def _written(spans):
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(rank: int):
    return lambda s: s["rank"] == rank


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < 4)
    return got.select(
        "doc_id", *(F.size(F.filter("spans", _is(k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)),
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", _is(4))).cast("long").alias("n_generalised"), F.size(F.filter("spans", _is(5))).cast("long").alias("n_removed"),
    )
