"""Queries over name screening and models, with oracles where SQL can state them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.config import Screening
from sablefin.operators import models, screening as sc
from sablefin.plans.features import SEGMENTS, settled_base, transformed
from sablefin.session import forget, settle, settled_under
from sablefin.sources import generator, given, tables as t
from sablefin.operators.features import BASE, PEER, SELF

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _add(name: str, query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        ORACLE_SQL[name] = sql


def alerts_of(df: DataFrame) -> DataFrame:
    """Alerts with the names of what corroborates them, as maps don't compare."""
    return df.withColumn("corroboration", F.array_join(F.array_sort(F.map_keys("corroboration")), ","))


def part_names(spark: SparkSession, d: str) -> DataFrame:
    return t.read_table(spark, d, "part").select(F.col("p_name").alias("name")).distinct()


def name_tokens_sorted_key(spark: SparkSession, d: str) -> DataFrame:
    n = sc.normalized(F.col("name"), Screening())
    return part_names(spark, d).select("name", n.alias("n")).select("name", F.size("n.tokens").cast("long").alias("tokens"), "n.sorted_key", "n.initials")


_N = "SELECT DISTINCT p_name AS name, list_filter(string_split(lower(p_name), ' '), lambda x: x <> '') AS w FROM part"
_add("name_tokens_sorted_key", name_tokens_sorted_key, f"SELECT name, len(w) AS tokens, array_to_string(list_sort(w), ' ') AS sorted_key, array_to_string(list_transform(w, lambda x: x[1]), '') AS initials FROM ({_N})")


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of names that share their first letter: an equi-join, as a block would make them."""
    n = part_names(spark, d).withColumn("k", F.lower(F.substring("name", 1, 1)))
    return n.select(F.col("name").alias("a"), "k").join(n.select(F.col("name").alias("b"), "k"), "k").where("a < b")


_PAIRS = "SELECT x.name AS a, y.name AS b FROM (SELECT DISTINCT p_name AS name FROM part) x JOIN (SELECT DISTINCT p_name AS name FROM part) y ON lower(x.name[1]) = lower(y.name[1]) WHERE x.name < y.name"
_words = lambda c: F.split(F.lower(c), " ")
_add(
    "initials_similarity", lambda s, d: _pairs(s, d).select("a", "b", F.round(sc.initials_similarity(_words(F.col("a")), _words(F.col("b"))), 9).alias("initials")),
    f"""SELECT a, b, round(len(list_intersect(i, j)) / greatest(len(i), len(j)), 9) AS initials FROM (SELECT a, b, list_distinct(list_transform(string_split(lower(a), ' '), lambda x: x[1])) AS i,
  list_distinct(list_transform(string_split(lower(b), ' '), lambda x: x[1])) AS j FROM ({_PAIRS}))""",
)
_add("jaro_winkler_pairs", lambda s, d: _pairs(s, d).select("a", "b", F.round(sc._jw(F.lower("a"), F.lower("b")), 9).alias("jw")), f"SELECT a, b, round(jaro_winkler_similarity(lower(a), lower(b)), 9) AS jw FROM ({_PAIRS})")


def shortlist_top40(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).withColumn("jw", F.round(sc._jw(F.lower("a"), F.lower("b")), 9)).where("jw >= 0.62")
    k = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("jw"), "b"))
    return p.withColumn("k", k).where("k <= 40").select("a", "b", "jw", "k")


_add("shortlist_top40", shortlist_top40, f"SELECT a, b, jw, k::INTEGER AS k FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY jw DESC, b) AS k FROM (SELECT a, b, round(jaro_winkler_similarity(lower(a), lower(b)), 9) AS jw FROM ({_PAIRS})) WHERE jw >= 0.62) WHERE k <= 40")


def _feed(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """People, watchlist and planted truth, named by the words of the given documents."""
    return given.feed(spark, d)


def _generated(spark: SparkSession, d: str) -> DataFrame:
    """A generated watchlist of all scripts."""
    return generator.watchlist(spark, max(t.read_table(spark, d, "customer").count() // 5, 50))


_add("normalize_names", lambda s, d: _generated(s, d).select("uid", "name", sc.normalized(F.col("name"), Screening()).alias("n")).select("uid", "name", "n.normalized", "n.sorted_key", "n.script", "n.lossy"))
_add("block_keys", lambda s, d: _feed(s, d)[1].select("uid", F.explode(sc.normalized(F.col("name"), Screening())["keys"]).alias("key")))
_add("double_metaphone", lambda s, d: part_names(s, d).select("name", F.array_join(sc.normalized(F.col("name"), Screening(strategies=("PA",)))["keys"], " ").alias("keys")))


def block_candidates(spark: SparkSession, d: str) -> DataFrame:
    c, w, _ = _feed(spark, d)
    cfg = Screening()
    return sc.candidate_counts(sc.subjects(c, cfg), settle(sc.references(w, cfg), "references"), cfg)


_add("block_candidates", block_candidates)
_add("blocking_stats", lambda s, d: sc.blocking_stats(*_feed(s, d)[:2]))


def blocking_recall(spark: SparkSession, d: str) -> DataFrame:
    c, w, truth = _feed(spark, d)
    return sc.blocking_recall(truth, c, w)


_add("blocking_recall", blocking_recall)
_add("token_set", lambda s, d: _pairs(s, d).select("a", "b", F.round(sc.signals(Screening())(F.lower("a"), F.lower("b"))["token_set"], 9).alias("token_set")))
_add("screen_many", lambda s, d: alerts_of(sc.screen_many(*_feed(s, d)[:2])))


def screening_sweep(spark: SparkSession, d: str) -> DataFrame:
    c, w, truth = _feed(spark, d)
    return sc.screening_sweep(settle(sc.screen_many(c, w, digits=None), "alerts"), truth)


_add("screening_sweep", screening_sweep)


def screening_metrics(spark: SparkSession, d: str) -> DataFrame:
    c, w, truth = _feed(spark, d)
    return sc.screening_metrics(settle(sc.screen_many(c, w, digits=None), "alerts"), c, truth)


_add("screening_metrics", screening_metrics)
_add("key_counts", lambda s, d: sc.key_counts(sc.references(_feed(s, d)[1], Screening())))
MODEL_FEATURES = [*BASE, *(f"peer_ratio_{c}" for c in PEER), *SELF, *(f"segment_{x}" for x in SEGMENTS)]


def _matrices(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    base = settled_base(spark, d)
    x = transformed(spark, d, base).select("customer_id", "period", *MODEL_FEATURES)
    month = F.substring("period", 6, 2).cast("int")
    # a label that depends on the features, so that there is something to learn
    y = (F.col("cash_share") > 0.5) & ((F.col("customer_id") * 31 + month) % 3 != 0)
    x = settle(x.withColumn("y", y), "model-matrix")  # every round of fitting reads it
    forget(spark, settled_under(base))  # and nothing the table it was made from
    return x.where("customer_id % 4 <> 0"), x.where("customer_id % 4 = 0")


KEY = ["customer_id", "period"]


def _boosted(conf: models.Boosting):
    return lambda spark, d: models.boosted_scores(*_matrices(spark, d), MODEL_FEATURES, conf, KEY)[0]


_add("gbt_scores", _boosted(models.SHALLOW))
_add("gbt_deep_scores", _boosted(models.DEEP))
_add("isolation_scores", lambda s, d: models.isolation_scores(*_matrices(s, d), MODEL_FEATURES, KEY))


def generated_labels(spark: SparkSession, d: str) -> DataFrame:
    """Labelled cells by typology of a generated feed with as many customers and transactions as the tables hold."""
    n, tx = (t.read_table(spark, d, name).count() for name in ("customer", "lineitem"))
    return generator.labels(generator.transactions(spark, n, tx)).groupBy("typology").agg(F.count(F.lit(1)).alias("cells"))


_add("generated_labels", generated_labels)
