"""People and a watchlist from the given tables, with planted hits: as many names as the tables have rows.

Names are made of the words of ``documents``: its distinct words, numbered in order, are dealt to customers and
parts by their keys. Every formula is stated twice, for Spark and as SQL, so that both engines screen the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.config import Screening
from sablefin.operators.ordering import numbered
from sablefin.session import settle
from sablefin.sources.tables import read_table

#: ASCII words of a text; those that normalisation would remove aren't names.
WORD = "[A-Za-z]{4,12}"
_REMOVED = sorted(Screening().honorifics | Screening().legal_forms | Screening().particles)
#: Which word is the first and which the last of a customer's, a part's and an alias's name: (factor, shift).
_OF = {"c": ((7919, 0), (104729, 13)), "p": ((15485863, 5), (32452843, 0)), "a": ((49979687, 1), (32452843, 0))}


def vocabulary(spark: SparkSession, d: str) -> DataFrame:
    """(word, nth from 0): distinct lower-case words of all documents in order."""
    every = read_table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORD), F.lit(0))).alias("w"))
    words = every.select(F.lower("w").alias("word")).distinct().where(~F.col("word").isin(_REMOVED))
    return numbered(settle(words, "words"), ["word"], "nth")


def _with_words(df: DataFrame, words: DataFrame, n: int, key: str, kind: str) -> DataFrame:
    """``df`` with <kind>_first and <kind>_last."""
    for name, (factor, shift) in zip(("first", "last"), _OF[kind], strict=True):
        w = words.select(F.col("nth").alias("_n"), F.col("word").alias(f"{kind}_{name}"))
        df = df.join(w, (F.col(key) * factor + shift) % n == F.col("_n")).drop("_n")
    return df


def _born(k: Column) -> Column:
    year = (1950 + k % 40).cast("string")
    return F.when(k % 3 == 0, year).when(k % 3 == 1, F.concat(year, F.lpad((1 + k % 12).cast("string"), 3, "-0"), F.lit("-15")))


_BORN = "CASE {k} % 3 WHEN 0 THEN (1950 + {k} % 40)::VARCHAR WHEN 1 THEN (1950 + {k} % 40)::VARCHAR || lpad((1 + {k} % 12)::VARCHAR, 3, '-0') || '-15' END"


def watchlist(spark: SparkSession, d: str, words: DataFrame) -> DataFrame:
    """uid, name, aliases, program, dob, nationality, national_id and the name's words: a row a part."""
    p, n = read_table(spark, d, "part").select(F.col("p_partkey").alias("k"), "p_brand"), words.count()
    p = _with_words(_with_words(p, words, n, "k", "p"), words, n, "k", "a")
    k = F.col("k")
    return p.select(
        F.concat(F.lit("P"), k.cast("string")).alias("uid"), F.concat_ws(" ", "p_first", "p_last").alias("name"),
        F.when(k % 4 == 0, F.concat_ws("|", F.concat_ws(" ", "a_first", "a_last"), F.lit(""))).alias("aliases"), F.col("p_brand").alias("program"),
        _born(k).alias("dob"), F.when(k % 5 != 0, F.chr(65 + k % 25)).alias("nationality"), F.when(k % 10 == 0, F.concat(F.lit("N"), (k % 50).cast("string"))).alias("national_id"),
        "k", "p_first", "p_last",
    )


def people(spark: SparkSession, d: str, words: DataFrame, watch: DataFrame) -> DataFrame:
    """subject_id, name, dob, nationality, national_id, planted_uid, near_miss: a row a customer.

    One in twenty is planted, under the words of a part in the other order or without a letter; as many are near misses,
    who share a last word with a part and nothing else.
    """
    c, n, parts = read_table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_nationkey"), words.count(), watch.count()
    c = _with_words(c, words, n, "k", "c").withColumn("_p", 1 + F.col("k") % parts)
    w = watch.select(F.col("k").alias("_k"), "uid", "p_first", "p_last", F.col("dob").alias("p_dob"))
    c = c.join(w, F.col("_p") == F.col("_k"), "left")
    k, planted, near = F.col("k"), (F.col("k") % 20 == 0) & F.col("uid").isNotNull(), (F.col("k") % 20 == 1) & F.col("uid").isNotNull()
    cut = F.substring("p_last", F.lit(1), F.length("p_last") - 1)
    name = F.when(planted & (k % 40 == 0), F.concat_ws(" ", "p_last", "p_first")).when(planted, F.concat_ws(" ", F.col("p_first"), cut)).when(near, F.concat_ws(" ", "c_first", "p_last"))
    return c.select(
        F.concat(F.lit("C"), k.cast("string")).alias("subject_id"), F.coalesce(name, F.concat_ws(" ", "c_first", "c_last")).alias("name"),
        F.when(planted, F.col("p_dob")).otherwise(_born(k)).alias("dob"), F.when(k % 7 != 0, F.chr(65 + F.col("c_nationkey"))).alias("nationality"),
        F.when(k % 10 == 0, F.concat(F.lit("N"), (k % 50).cast("string"))).alias("national_id"), F.when(planted, F.col("uid")).alias("planted_uid"), near.alias("near_miss"),
    )


def feed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(people, watchlist, truth(subject_id, uid)), settled."""
    words = settle(vocabulary(spark, d), "vocabulary")
    watch = settle(watchlist(spark, d, words), "watchlist")
    who = settle(people(spark, d, words, watch), "people")
    return who, watch.drop("k", "p_first", "p_last"), who.where("planted_uid is not null").select("subject_id", F.col("planted_uid").alias("uid"))


def _place(k: str, kind: str, which: int) -> str:
    factor, shift = _OF[kind][which]
    return f"({k} * {factor} + {shift}) % (SELECT count(*) FROM words)"


def _sql() -> str:
    """WITH-list of words, watch, who and truth."""
    removed = ", ".join(f"'{w}'" for w in _REMOVED)
    return f"""WITH words AS MATERIALIZED (SELECT word, row_number() OVER (ORDER BY word) - 1 AS nth FROM (SELECT DISTINCT lower(w) AS word FROM (
  SELECT unnest(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS w FROM documents)) WHERE word NOT IN ({removed})),
watch AS MATERIALIZED (SELECT 'P' || p_partkey AS uid, x.word || ' ' || y.word AS name, CASE WHEN p_partkey % 4 = 0 THEN z.word || ' ' || y.word END AS alias, p_brand AS program,
  {_BORN.format(k="p_partkey")} AS dob, CASE WHEN p_partkey % 5 <> 0 THEN chr((65 + p_partkey % 25)::INTEGER) END AS nationality, CASE WHEN p_partkey % 10 = 0 THEN 'N' || (p_partkey % 50) END AS national_id,
  p_partkey AS k, x.word AS p_first, y.word AS p_last
  FROM part JOIN words x ON x.nth = {_place("p_partkey", "p", 0)} JOIN words y ON y.nth = {_place("p_partkey", "p", 1)} JOIN words z ON z.nth = {_place("p_partkey", "a", 0)}),
cw AS (SELECT c_custkey AS k, c_nationkey, x.word AS c_first, y.word AS c_last, uid, p_first, p_last, dob AS p_dob, c_custkey % 20 = 0 AND uid IS NOT NULL AS planted, c_custkey % 20 = 1 AND uid IS NOT NULL AS near_miss
  FROM customer JOIN words x ON x.nth = {_place("c_custkey", "c", 0)} JOIN words y ON y.nth = {_place("c_custkey", "c", 1)} LEFT JOIN watch w ON w.k = 1 + c_custkey % (SELECT count(*) FROM watch)),
who AS MATERIALIZED (SELECT 'C' || k AS subject_id, CASE WHEN planted AND k % 40 = 0 THEN p_last || ' ' || p_first WHEN planted THEN p_first || ' ' || p_last[:-2]
    WHEN near_miss THEN c_first || ' ' || p_last ELSE c_first || ' ' || c_last END AS name, CASE WHEN planted THEN p_dob ELSE {_BORN.format(k="k")} END AS dob,
  CASE WHEN k % 7 <> 0 THEN chr(65 + c_nationkey) END AS nationality, CASE WHEN k % 10 = 0 THEN 'N' || (k % 50) END AS national_id, CASE WHEN planted THEN uid END AS planted_uid, near_miss FROM cw),
truth AS MATERIALIZED (SELECT subject_id, planted_uid AS uid FROM who WHERE planted_uid IS NOT NULL)"""


SQL = _sql()
