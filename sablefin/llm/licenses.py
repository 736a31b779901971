"""Licence scan: Aho-Corasick for tags and notice phrases, shunting-yard for licence expressions.

One pass in tasks over whole texts, without a shuffle: what a text yields depends on that text alone. The
kernel is linear in the text, however many tags, phrases or parentheses it holds.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.llm import license_kernel as kernel
from sablefin.llm.common import table

_PLACE = pa.struct([("word", pa.int64()), ("n_words", pa.int32()), ("kind", pa.string()), ("label", pa.string())])
_EXPRESSION = pa.struct([("word", pa.int64()), ("postfix", pa.string()), ("openness", pa.float64()), ("labels", pa.list_(pa.string()))])
_RESULT = (
    "n_words long, found array<struct<word:bigint,n_words:int,kind:string,label:string>>, "
    "expressions array<struct<word:bigint,postfix:string,openness:double,labels:array<string>>>, "
    "labels array<string>, score double, openness double"
)


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``keep`` and

    - n_words: words of the whole text (null: empty);
    - found: every place of a phrase, in order, overlapping ones included: first word, words, kind
      (base, notice, name) and label;
    - expressions: those that follow a tag in its line and are well formed: the word they begin at, in postfix
      order, their openness and the labels that bind;
    - labels: all labels of phrases and of identifiers in expressions, malformed ones included, distinct, sorted;
    - score: 0 to 1, how surely the text carries a licence (none found: 0);
    - openness: 0 to 1, of the strictest expression, or without any of the strictest label (none found: null).

    Rows with equal or null ids stay apart; an empty table gives an empty result; other columns aren't touched.
    """
    rows = docs.select(F.struct(*(F.col(c) for c in keep)).alias("_keep"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))

    def run(batches):
        for b in batches:
            n, found, read, labels, scores, open_ = [], [], [], [], [], []
            for t in b.column("_text").to_pylist():
                k, places, expressions, named = kernel.find(t)
                places.sort()
                every = sorted(named | {p.label for p in places})
                n.append(k)
                found.append([p._asdict() for p in places])
                read.append([e._asdict() for e in expressions])
                labels.append(every)
                scores.append(kernel.score({(p.kind, p.label) for p in places} | {("expression", e.postfix) for e in expressions}))
                open_.append(min((e.openness for e in expressions), default=min((kernel.OPENNESS[x] for x in every), default=None)))
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("_keep"), pa.array(n, pa.int64()), pa.array(found, pa.list_(_PLACE)), pa.array(read, pa.list_(_EXPRESSION)),
                    pa.array(labels, pa.list_(pa.string())), pa.array(scores, pa.float64()), pa.array(open_, pa.float64()),
                ],
                names=["_keep", "n_words", "found", "expressions", "labels", "score", "openness"],
            )

    schema = rows.select("_keep").schema
    for f in docs.sparkSession.createDataFrame([], _RESULT).schema:
        schema = schema.add(f)
    got = rows.mapInArrow(run, schema)
    return got.select("_keep.*", *(c for c in got.columns if c != "_keep"))


def _joined(names: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(names)), ",")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda p: p["kind"] == "base")
    starts = F.transform(base, lambda p: p["word"])
    return got.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _joined(F.transform(base, lambda p: p["label"])).alias("base_labels"), _joined(F.col("labels")).alias("labels"), "score", "openness",
        F.array_join(F.transform("expressions", lambda e: e["postfix"]), "; ").alias("expressions"),
    )
