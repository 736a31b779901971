"""Name screening as joins: normalise, block, shortlist, score, corroborate, decide, rank.

Text work runs in Arrow-batched kernels over distinct names; everything else is relational. Watchlist names
and subjects meet by an equi-join on block keys; blocks over a size limit are split by a second letter on
both sides, so no key gathers an unbounded block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from sablefin.config import SCREENING_GRID, Screening
from sablefin.functions import metaphone, names, nearest, similarity
from sablefin.session import settle, ship

#: Digits in which scores that rank are told apart: beyond them, the order of float operations decides.
TIE = 9
NAME_TYPE = (
    "latin string, normalized string, tokens array<string>, sorted_key string, initials string, script string, is_organization boolean, "
    "honorifics array<string>, particles array<string>, lossy boolean, keys array<string>, refine string"
)


def block_keys(n: names.Name, cfg: Screening) -> list[str]:
    """PS: sound of the first and last word; SP: sorted pair of both; IB: first two of the sorted initials;
    PA: sound of any word. OR-ed."""
    words = [t for t in n.tokens if len(t) >= cfg.min_token] or n.tokens
    if not words:
        return []
    # sounds are kept by worker, so they are taken only where a strategy asks for them
    head, tail = (metaphone.keys(words[0]), metaphone.keys(words[-1])) if {"PS", "SP"} & set(cfg.strategies) else ((), ())
    out: set[str] = set()
    for s in cfg.strategies:
        if s == "PS":
            out |= {f"PS:{k}" for k in (*head, *tail)}
        elif s == "SP":
            out |= {"SP:" + "|".join(sorted((a, b))) for a in head or ("",) for b in tail or ("",)}
        elif s == "IB":
            out.add("IB:" + "".join(sorted({t[0] for t in words})[:2]))
        elif s == "PA":
            out |= {f"PA:{k}" for t in words for k in metaphone.keys(t)}
        else:
            raise ValueError(f"unknown blocking strategy {s}")
    return sorted(out)


def _as_row(raw: str | None, cfg: Screening, readings: dict[str, str] | None = None) -> dict:
    try:
        n = names.normalize(raw, cfg, readings)
    except names.NameError_:
        n = names.EMPTY
    return {
        "latin": n.latin, "normalized": n.normalized, "tokens": n.tokens, "sorted_key": n.sorted_key, "initials": n.initials, "script": n.script,
        "is_organization": n.is_organization, "honorifics": n.honorifics, "particles": n.particles, "lossy": n.lossy,
        "keys": block_keys(n, cfg), "refine": min(n.tokens)[0] if n.tokens else "_",
    }


def _readings(spark: SparkSession) -> Broadcast:
    """Readings of Han characters in every task: a table of fixed size, made once a context."""
    sc = spark.sparkContext
    if getattr(sc, "_sablefin_readings", None) is None:
        sc._sablefin_readings = sc.broadcast(names.han_readings(spark))
    return sc._sablefin_readings


#: Names whose rows a worker holds at a time, however many a batch has.
HELD = 500


def _normalized(parts: Iterator[pd.Series], cfg: Screening, readings: dict[str, str]) -> Iterator[pd.DataFrame]:
    cols = [c.split()[0] for c in NAME_TYPE.split(", ")]
    for batch in parts:
        for k in range(0, max(len(batch), 1), HELD):
            s = batch.iloc[k : k + HELD]
            seen = {x: _as_row(x, cfg, readings) for x in s.unique()}
            yield pd.DataFrame([seen[x] for x in s], columns=cols)


def normalized(name: Column, cfg: Screening) -> Column:
    """struct(NAME_TYPE) of a name; a name without a Latin form has no tokens."""
    held = _readings(SparkSession.active())

    @F.pandas_udf(NAME_TYPE)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        yield from _normalized(parts, cfg, held.value)

    return run.asNondeterministic()(name)


def references(watchlist: DataFrame, cfg: Screening) -> DataFrame:
    """A row per usable name: the entity's columns, pos (0: primary), matched_on and n.

    ``watchlist``: uid, name, aliases (pipe-separated), program, dob, nationality, national_id.
    """
    ship(watchlist.sparkSession)
    more = F.filter(F.split(F.coalesce("aliases", F.lit("")), r"\|"), lambda x: F.trim(x) != "")
    w = watchlist.select("uid", F.col("name").alias("entity_name"), "program", F.col("dob").alias("w_dob"), F.col("nationality").alias("w_nat"), F.col("national_id").alias("w_id"), F.posexplode(F.concat(F.array("name"), more)).alias("pos", "ref_name"))
    w = w.withColumn("n", normalized(F.col("ref_name"), cfg)).where(F.size("n.tokens") > 0)
    return w.withColumn("matched_on", F.when(F.col("pos") == 0, "primary").otherwise("alias"))


def subjects(df: DataFrame, cfg: Screening) -> DataFrame:
    """``df``: subject_id, name, dob, nationality, national_id -> with n, nameless ones dropped."""
    s = df.select("subject_id", F.col("name").alias("subject_name"), F.col("dob").alias("s_dob"), F.col("nationality").alias("s_nat"), F.col("national_id").alias("s_id"))
    return s.withColumn("n", normalized(F.col("subject_name"), cfg)).where(F.size("n.tokens") > 0)


def refined_keys(refs: DataFrame, cfg: Screening) -> DataFrame:
    """(key): blocks of more than ``max_block`` reference names."""
    return refs.select(F.explode("n.keys").alias("key")).groupBy("key").count().where(F.col("count") > cfg.max_block).select("key", F.lit(True).alias("big"))


def _keyed(df: DataFrame, big: DataFrame, *cols: str) -> DataFrame:
    k = df.select(*cols, F.col("n.refine").alias("_r"), F.explode("n.keys").alias("key")).join(big, "key", "left")
    return k.select(*cols, F.when(F.col("big"), F.concat_ws("|", "key", "_r")).otherwise(F.col("key")).alias("key"))


def candidates(subs: DataFrame, refs: DataFrame, cfg: Screening) -> DataFrame:
    """Distinct (subject_id, uid, pos) that share a block."""
    big = refined_keys(refs, cfg)
    left, right = _keyed(subs, big, "subject_id"), _keyed(refs, big, "uid", "pos")
    return left.join(right, "key").select("subject_id", "uid", "pos").distinct()


def _sets(held: DataFrame) -> DataFrame:
    """``held``(keys, ...) with ``sets``: every set of its keys but the empty one."""
    grown = F.aggregate("keys", F.array(F.slice("keys", 1, 0)), lambda acc, k: F.concat(acc, F.transform(acc, lambda x: F.array_append(x, k))))
    return held.withColumn("sets", F.filter(grown, lambda x: F.size(x) > 0))


def candidate_counts(subs: DataFrame, refs: DataFrame, cfg: Screening, few: int = 64, most: int = 8) -> DataFrame:
    """(subject_id, candidates): how many distinct (uid, pos) of ``candidates`` each subject has, subjects without one left out.

    Which references a subject meets follows from its block keys alone, so classes of equal keys are met, not their members.
    Keys that more than ``few`` references have are common ones. Who shares a common key is counted without pairs, by
    inclusion and exclusion over sets of common keys; who shares only rarer ones is met at the first, and no rare key has
    more than ``few``. So the work grows with the rows and not with the pairs. Classes of more than ``most`` common keys, whose sets
    would be too many, are met as pairs of classes. ``refs`` are read twice, so they had better be settled.
    """
    big = settle(refined_keys(refs, cfg), "refined-keys")
    keyed = settle(_keyed(refs, big, "uid", "pos").distinct(), "reference-keys")
    common = settle(keyed.groupBy("key").agg((F.count(F.lit(1)) > few).alias("common")), "common-keys")

    def classes(k: DataFrame, *who: str) -> DataFrame:
        # keys that no reference has meet nothing
        each = k.join(common, "key").groupBy(*who).agg(F.sort_array(F.collect_set(F.when(F.col("common"), F.col("key")))).alias("keys"), F.sort_array(F.collect_set(F.when(~F.col("common"), F.col("key")))).alias("rare"))
        return each.withColumn("many", F.size("keys") > most)

    held = settle(classes(_keyed(subs, big, "subject_id"), "subject_id"), "subject-keys")
    left = settle(held.select("keys", "rare", "many").distinct(), "subject-classes")
    right = settle(classes(keyed, "uid", "pos").groupBy("keys", "rare", "many").agg(F.count(F.lit(1)).alias("n")), "reference-classes")
    theirs = right.select(F.col("keys").alias("_keys"), F.col("rare").alias("_rare"), F.col("many").alias("_many"), "n")
    # sets of common keys, each with the number of references that have them all
    having = _sets(right.where(~F.col("many"))).select(F.explode("sets").alias("set"), "n").groupBy("set").agg(F.sum("n").alias("n"))
    mine = _sets(left.where(~F.col("many"))).select("keys", "rare", F.explode("sets").alias("set"))
    sets = mine.join(having, "set").select("keys", "rare", F.when(F.size("set") % 2 == 1, F.col("n")).otherwise(-F.col("n")).alias("n"))
    # rare keys, for those who share no common one
    met = left.where(~F.col("many")).withColumn("key", F.explode("rare")).join(theirs.where(~F.col("_many")).withColumn("key", F.explode("_rare")), "key")
    met = met.where(~F.arrays_overlap("keys", "_keys") & (F.col("key") == F.array_min(F.array_intersect("rare", "_rare")))).select("keys", "rare", "n")
    # classes of too many common keys
    pairs, every, all_ = [], lambda a, b: F.explode(F.concat(a, b)), lambda a, b: F.concat(a, b)
    for one, other in ((left.where("many"), theirs), (left.where(~F.col("many")), theirs.where("_many"))):
        p = one.withColumn("key", every("keys", "rare")).join(other.withColumn("key", every("_keys", "_rare")), "key")
        pairs.append(p.where(F.col("key") == F.array_min(F.array_intersect(all_("keys", "rare"), all_("_keys", "_rare")))).select("keys", "rare", "n"))
    per = sets.unionAll(met).unionAll(pairs[0]).unionAll(pairs[1]).groupBy("keys", "rare").agg(F.sum("n").alias("candidates"))
    return held.join(settle(per, "class-candidates"), ["keys", "rare"]).select("subject_id", "candidates")


@F.pandas_udf(T.DoubleType())
def _compare(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series(similarity.jaro_winkler_many(a.fillna("").tolist(), b.fillna("").tolist()))


#: Kernels are marked as not deterministic so that a filter on their result isn't planned as a second evaluation.
_jw = _compare.asNondeterministic()


#: Distinct names of one block, subjects' and references', that a task compares at a time.
TILE = (8_192, 65_536)
#: Pairs of a tile that isn't worth a bound.
SMALL = 4_000


def likely(subs: DataFrame, refs: DataFrame, cfg: Screening, tile: tuple[int, int] = TILE) -> DataFrame:
    """(s_name, r_name, pre): the distinct names that share a block and whose sorted keys are alike enough.

    With a prefilter, only those that can be on the shortlist of a subject's name or show that it is cut: the first names by ``pre``
    and by their first (uid, pos), one more than it holds. They are the first of the first ones of each block, so blocks are met in
    tiles, whose tasks skip pairs by a bound and return no more than the lists.
    """
    big = settle(refined_keys(refs, cfg), "refined-keys")
    left = _keyed(subs.select("n", F.col("n.normalized").alias("s_name"), F.col("n.sorted_key").alias("s_key")), big, "s_name", "s_key").distinct()
    right = refs.select("n", F.col("n.normalized").alias("r_name"), F.col("n.sorted_key").alias("r_key"), F.struct("uid", "pos").alias("first"))
    right = _keyed(right, big, "r_name", "r_key", "first").groupBy("r_name", "r_key", "key").agg(F.min("first").alias("first"))
    if cfg.prefilter <= 0:
        return left.join(right, "key").select("s_name", "r_name").distinct().withColumn("pre", F.lit(1.0))
    left, right = settle(left, "subject-names"), settle(right, "reference-names")
    count = lambda df, name: df.groupBy("key").agg(F.count(F.lit(1)).alias(name))
    tiles = lambda c, size: F.ceil(F.col(c) / size).cast("int")
    blocks = count(left, "nl").join(count(right, "nr"), "key").select("key", "nl", "nr", tiles("nl", tile[0]).alias("tl"), tiles("nr", tile[1]).alias("tr"))
    blocks = settle(blocks, "blocks")
    rows, pairs = blocks.agg(F.coalesce(F.sum(F.col("nl") * F.col("tr") + F.col("nr") * F.col("tl")), F.lit(0)), F.coalesce(F.sum(F.col("nl").cast("double") * F.col("nr")), F.lit(0.0))).first()
    parts = int(max(24, rows // 100_000, pairs // 100_000_000))
    at = lambda df, name, mine, other: df.join(blocks.select("key", "tl", "tr"), "key").withColumn(mine[0], F.pmod(F.xxhash64(name), mine[1])).withColumn(other[0], F.explode(F.sequence(F.lit(0), F.col(other[1]) - 1)))
    tile_id = F.concat_ws("/", "key", "_l", "_r")
    dealt = lambda df, *cols: df.select(F.pmod(F.xxhash64(tile_id), F.lit(parts)).alias("_part"), tile_id.alias("tile"), *cols).repartition(parts, "_part")
    one = dealt(at(left, "s_name", ("_l", F.col("tl")), ("_r", "tr")), "s_name", "s_key")
    two = dealt(at(right, "r_name", ("_r", F.col("tr")), ("_l", "tl")), "r_name", "r_key", F.col("first.uid").alias("uid"), F.col("first.pos").alias("pos"))
    most, floor = cfg.shortlist + 1, cfg.prefilter

    def run(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        b = b.sort_values(["uid", "pos"], na_position="first")
        # pairs of small tiles are compared together
        size = a.groupby("tile").size().mul(b.groupby("tile").size()).dropna()
        small, out = size[size <= SMALL], []
        for _, some in small.groupby(small.cumsum() // (100 * SMALL)):
            x = a[a["tile"].isin(some.index)].merge(b, on="tile")
            x["pre"] = similarity.jaro_winkler_many(x["s_key"].tolist(), x["r_key"].tolist())
            out.append(x.loc[x["pre"] >= floor, ["s_name", "r_name", "pre", "uid", "pos"]])
        large = size.index[size > SMALL]
        theirs = dict(iter(b[b["tile"].isin(large)].groupby("tile", sort=False)))
        for key, x in a[a["tile"].isin(large)].groupby("tile", sort=False):
            y = theirs[key]
            i, j, pre = nearest.nearest(x["s_key"].tolist(), y["r_key"].tolist(), floor, most, TIE)
            out.append(pd.DataFrame({"s_name": x["s_name"].to_numpy()[i], "r_name": y["r_name"].to_numpy()[j], "pre": pre, "uid": y["uid"].to_numpy()[j], "pos": y["pos"].to_numpy()[j]}))
        return pd.concat(out) if out else pd.DataFrame({c: [] for c in ("s_name", "r_name", "pre", "uid", "pos")})

    uid = refs.schema["uid"].dataType.simpleString()
    near = one.groupBy("_part").cogroup(two.groupBy("_part")).applyInPandas(run, f"s_name string, r_name string, pre double, uid {uid}, pos int")
    # a name found in several blocks has one rank
    first = F.dense_rank().over(Window.partitionBy("s_name").orderBy(F.desc(F.round("pre", TIE)), "uid", "pos", "r_name"))
    return near.withColumn("_k", first).where(F.col("_k") <= most).select("s_name", "r_name", "pre").distinct()


def shortlist(pairs: DataFrame, refs: DataFrame, cfg: Screening) -> DataFrame:
    """(s_name, r_name, uid, pos, pre, cut): at most ``shortlist`` references a subject's name; ``cut`` says it had more.

    A shortlist follows from the name alone, so it is taken once a distinct name and not once a subject who bears it. Only
    one reference more than it holds is kept a name, and that before the shuffle; of a name that many references bear, the first ones.
    """
    held = refs.select("uid", "pos", F.col("n.normalized").alias("r_name"))
    if cfg.prefilter <= 0:
        return pairs.join(held, "r_name").select("s_name", "r_name", "uid", "pos", "pre").withColumn("cut", F.lit(False))
    held = held.withColumn("_k", F.row_number().over(Window.partitionBy("r_name").orderBy("uid", "pos"))).where(F.col("_k") <= cfg.shortlist + 1).drop("_k")
    d = pairs.join(held, "r_name").select("s_name", "r_name", "uid", "pos", "pre")
    w = Window.partitionBy("s_name")
    d = d.withColumn("_k", F.row_number().over(w.orderBy(F.desc(F.round("pre", TIE)), "uid", "pos"))).where(F.col("_k") <= cfg.shortlist + 1)
    return d.withColumn("cut", F.max("_k").over(w) > cfg.shortlist).where(F.col("_k") <= cfg.shortlist).drop("_k")


def signals(cfg: Screening):
    """Kernel for the signals of pairs of names, whose words single blanks part: jw, token_set, phonetic, initials, order_swapped."""

    @F.pandas_udf("jw double, token_set double, phonetic double, initials double, order_swapped boolean")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        a, b = a.tolist(), b.tolist()
        # what a name has of its own is made once however many pairs it is in
        held = {t: (metaphone.sounds(w), {x[0] for x in w if x}, " ".join(sorted(w))) for t in {*a, *b} for w in (t.split(" "),)}
        each = [(held[l], held[r]) for l, r in zip(a, b, strict=True)]
        direct, swapped = (similarity.jaro_winkler_many(x, y, cfg.prefix_weight) for x, y in ((a, b), ([l[2] for l, _ in each], [r[2] for _, r in each])))
        return pd.DataFrame({
            "jw": np.maximum(direct, swapped), "token_set": similarity.token_set_many(a, b), "phonetic": [metaphone.sound_similarity(l[0], r[0]) for l, r in each],
            "initials": [len(l[1] & r[1]) / max(len(l[1]), len(r[1]), 1) for l, r in each], "order_swapped": swapped > direct + 1e-9,
        })

    return run.asNondeterministic()


def initials_similarity(a: Column, b: Column) -> Column:
    """Shared first letters over the larger set, from two arrays of words; JVM only."""
    i, j = (F.array_distinct(F.transform(x, lambda t: F.substring(t, 1, 1))) for x in (a, b))
    return F.coalesce(F.size(F.array_intersect(i, j)) / F.nullif(F.greatest(F.size(i), F.size(j)), F.lit(0)), F.lit(0.0))


def _year(c: Column) -> Column:
    return F.when(F.trim(c).rlike("^[0-9]{4}"), F.substring(F.trim(c), 1, 4))


def corroborated(df: DataFrame, cfg: Screening) -> DataFrame:
    """name_score, corroboration_delta, final_score, decision, corroboration (map label -> delta).

    Absent data never counts. A strong name can't fall under the floor. Decisions are taken before rounding.
    """
    s = F.col("sig")
    name = cfg.jaro_winkler * s["jw"] + cfg.token_set * s["token_set"] + cfg.phonetic * s["phonetic"] + cfg.initials * s["initials"]
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    dob = has("s_dob") & has("w_dob")
    exact = dob & (F.col("s_dob") == F.col("w_dob"))
    year = dob & ~exact & _year(F.col("s_dob")).eqNullSafe(_year(F.col("w_dob")))
    nat = has("s_nat") & has("w_nat")
    same = nat & (F.col("s_nat") == F.col("w_nat"))
    rules = {
        "dob_exact": (exact, cfg.dob_exact), "dob_year_only": (year, cfg.dob_year_only), "dob_mismatch": (dob & ~exact & ~year, cfg.dob_mismatch),
        "nationality_match": (same, cfg.nationality_match), "nationality_mismatch": (nat & ~same, cfg.nationality_mismatch),
        "id_exact": (has("s_id") & has("w_id") & (F.col("s_id") == F.col("w_id")), cfg.id_exact), "single_token": (F.size("ns.tokens") <= 1, cfg.single_token),
    }
    delta = F.lit(0.0)
    for test, v in rules.values():
        delta = delta + F.when(test, v).otherwise(0.0)
    d = df.withColumn("name_score", name).withColumn("corroboration_delta", delta)
    plain = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("name_score") + F.col("corroboration_delta")))
    final = F.when(F.col("name_score") >= cfg.strong_name_floor, F.greatest(plain, F.lit(cfg.strong_name_floor_score))).otherwise(plain)
    applied = F.map_filter(F.create_map(*(x for k, (t, v) in rules.items() for x in (F.lit(k), F.when(t, F.lit(v))))), lambda k, v: v.isNotNull())
    lift = F.map_filter(F.create_map(F.lit("strong_name_floor"), final - plain), lambda k, v: v > 0)
    d = d.withColumn("final_score", final).withColumn("corroboration", F.map_concat(applied, lift))
    return d.withColumn("decision", F.when(F.col("final_score") >= cfg.escalate, "ESCALATE").when(F.col("final_score") >= cfg.review, "REVIEW").otherwise("DISCARD"))


ALERT = (
    "subject_id", "subject_name", "watchlist_uid", "watchlist_name", "program", "matched_on", "name_score", "corroboration_delta", "final_score", "decision",
    "jaro_winkler", "token_set", "phonetic", "initials", "order_swapped", "corroboration",
)


def screen_many(people: DataFrame, watchlist: DataFrame, cfg: Screening | None = None, top_n: int = 3, min_score: float = 0.70, digits: int | None = 6) -> DataFrame:
    """ALERT rows: per subject the ``top_n`` entities of at least ``min_score``, one row an entity."""
    cfg = cfg or Screening()
    # normalised once: blocks, keys and details are read from the tables
    refs, subs = settle(references(watchlist, cfg), "references"), settle(subjects(people, cfg), "subjects")
    # names are compared and scored once however many bear them; subjects and details join what the shortlist leaves
    s_name, r_name = F.col("s_name"), F.col("r_name")
    short = shortlist(likely(subs, refs, cfg), refs, cfg).withColumn("sig", signals(cfg)(s_name, r_name)).drop("r_name")
    short = short.join(refs.withColumnRenamed("n", "nr"), ["uid", "pos"])
    people = subs.withColumn("s_name", F.col("n.normalized")).withColumnRenamed("n", "ns")
    scored = corroborated(short.join(people, "s_name"), cfg)
    scored = scored.where(F.col("final_score") >= min_score)
    best = Window.partitionBy("subject_id", "uid").orderBy(F.desc(F.round("final_score", TIE)), F.when(F.col("cut"), -F.round("pre", TIE)), "pos")
    one = scored.withColumn("_b", F.row_number().over(best)).where("_b = 1")
    top = one.withColumn("_t", F.row_number().over(Window.partitionBy("subject_id").orderBy(F.desc(F.round("final_score", TIE)), "uid"))).where(F.col("_t") <= top_n)
    r = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    return top.select(
        "subject_id", "subject_name", F.col("uid").alias("watchlist_uid"), F.col("entity_name").alias("watchlist_name"), "program", "matched_on",
        r(F.col("name_score")).alias("name_score"), r(F.col("corroboration_delta")).alias("corroboration_delta"), r(F.col("final_score")).alias("final_score"), "decision",
        r(F.col("sig.jw")).alias("jaro_winkler"), r(F.col("sig.token_set")).alias("token_set"), r(F.col("sig.phonetic")).alias("phonetic"), r(F.col("sig.initials")).alias("initials"), F.col("sig.order_swapped").alias("order_swapped"), "corroboration",
    )


def blocking_stats(people: DataFrame, watchlist: DataFrame, cfg: Screening | None = None) -> DataFrame:
    """One row: queries, references, candidate_pairs, mean, p95 (nearest rank) and most candidates a query, blocks,
    largest block, refined blocks, reduction. Nameless subjects count as queries without candidates."""
    cfg = cfg or Screening()
    refs, subs = settle(references(watchlist, cfg), "references"), subjects(people, cfg)
    big = refined_keys(refs, cfg)
    blocks = _keyed(refs, big, "uid", "pos").groupBy("key").count().agg(F.count(F.lit(1)).alias("blocks"), F.coalesce(F.max("count"), F.lit(0)).alias("largest_block"))
    per = people.select("subject_id").join(candidate_counts(subs, refs, cfg), "subject_id", "left").select(F.coalesce("candidates", F.lit(0)).alias("n"))
    # p95 by nearest rank from the histogram of counts: a row per distinct count
    hist = per.groupBy("n").agg(F.count(F.lit(1)).alias("k"))
    w = Window.orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    cum = hist.withColumn("upto", F.sum("k").over(w)).crossJoin(hist.agg(F.sum("k").alias("queries")))
    at = F.least(F.col("queries") - 1, F.floor(F.col("queries") * 0.95)) + 1
    q = cum.agg(F.max("queries").alias("queries"), F.sum(F.col("n") * F.col("k")).alias("candidate_pairs"), F.max("n").alias("max_candidates"), F.min(F.when(F.col("upto") >= at, F.col("n"))).alias("p95_candidates"))
    out = q.crossJoin(blocks).crossJoin(refs.agg(F.count(F.lit(1)).alias("references"))).crossJoin(big.agg(F.count(F.lit(1)).alias("refined_blocks")))
    return out.withColumn("mean_candidates", F.col("candidate_pairs") / F.nullif(F.col("queries"), F.lit(0))).withColumn("reduction", 1 - F.col("candidate_pairs") / F.nullif(F.col("queries") * F.col("references"), F.lit(0)))


def key_counts(refs: DataFrame) -> DataFrame:
    """(strategy, blocks, entries): distinct block keys of reference names by the strategy that made them, and how often names have them."""
    each = refs.select(F.explode("n.keys").alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy(F.substring_index("key", ":", 1).alias("strategy")).agg(F.count(F.lit(1)).alias("blocks"), F.sum("n").alias("entries"))


def blocking_recall(truth: DataFrame, people: DataFrame, watchlist: DataFrame, cfg: Screening | None = None) -> DataFrame:
    """One row: how many (subject_id, uid) of ``truth`` share a block.

    Driven by the truth: only the keys of its own pairs meet, on (pair, key), so what is written grows with the truth and not with the
    candidates. Which blocks are refined still follows from all references.
    """
    cfg = cfg or Screening()
    pairs = settle(truth.select("subject_id", "uid"), "planted")
    refs = settle(references(watchlist, cfg).select("uid", "pos", "n.keys", "n.refine"), "reference-keys")
    refs = refs.select("uid", "pos", F.struct("keys", "refine").alias("n"))
    big = settle(refined_keys(refs, cfg), "refined-keys")
    subs = subjects(people.join(pairs.select("subject_id").distinct(), "subject_id", "left_semi"), cfg)
    left = pairs.distinct().join(_keyed(subs, big, "subject_id").distinct(), "subject_id")
    right = _keyed(refs.join(pairs.select("uid").distinct(), "uid", "left_semi"), big, "uid").distinct()
    got = left.join(right, ["uid", "key"]).select("subject_id", "uid").distinct()
    d = pairs.join(got.withColumn("hit", F.lit(1)), ["subject_id", "uid"], "left").agg(F.count(F.lit(1)).alias("truth"), F.count("hit").alias("found"))
    return d.withColumn("recall", F.coalesce(F.col("found") / F.nullif(F.col("truth"), F.lit(0)), F.lit(0.0)))


def screening_sweep(alerts: DataFrame, truth: DataFrame, grid: tuple[float, ...] = SCREENING_GRID) -> DataFrame:
    """A row per threshold: alert_rows, alerted_subjects, escalations, detected, recall, precision, fp_ratio.

    A planted subject is detected if its own entity is among its alerts. One pass: a subject counts at every
    threshold up to its best score, so thresholds are read off maxima.
    """
    hit = truth.select("subject_id", F.col("uid").alias("watchlist_uid"), F.lit(True).alias("hit"))
    a = alerts.join(hit, ["subject_id", "watchlist_uid"], "left")
    per = a.groupBy("subject_id").agg(F.max("final_score").alias("best"), F.max(F.when(F.col("hit"), F.col("final_score"))).alias("found"))
    rows = a.agg(*(F.count(F.when(F.col("final_score") >= t, 1)).alias(f"r{k}") for k, t in enumerate(grid)), *(F.count(F.when((F.col("final_score") >= t) & (F.col("decision") == "ESCALATE"), 1)).alias(f"e{k}") for k, t in enumerate(grid)))
    subs = per.agg(*(F.count(F.when(F.col("best") >= t, 1)).alias(f"s{k}") for k, t in enumerate(grid)), *(F.count(F.when(F.col("found") >= t, 1)).alias(f"d{k}") for k, t in enumerate(grid)))
    wide = rows.crossJoin(subs).crossJoin(truth.agg(F.count(F.lit(1)).alias("planted")))
    cells = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"r{k}").alias("alert_rows"), F.col(f"s{k}").alias("alerted_subjects"), F.col(f"e{k}").alias("escalations"), F.col(f"d{k}").alias("detected")) for k, t in enumerate(grid)]
    d = wide.select("planted", F.inline(F.array(*cells)))
    fp = F.col("alerted_subjects") - F.col("detected")
    return d.select(
        "threshold", "alert_rows", "alerted_subjects", "escalations", "detected", F.round(F.coalesce(F.col("detected") / F.nullif(F.col("planted"), F.lit(0)), F.lit(0.0)), 6).alias("recall"),
        F.round(F.coalesce(F.col("detected") / F.nullif(F.col("alerted_subjects"), F.lit(0)), F.lit(0.0)), 6).alias("precision"),
        F.round(F.when(F.col("detected") == 0, float("inf")).otherwise(fp / F.nullif(F.col("detected"), F.lit(0))), 6).alias("fp_ratio"),
    )


def screening_metrics(alerts: DataFrame, people: DataFrame, truth: DataFrame, grid: tuple[float, ...] = (0.86,)) -> DataFrame:
    """All thirteen measures of alerts from each threshold on: those of ``screening_sweep`` under their own names, and

    alert_rate over all ``people``(subject_id, near_miss), and how many planted near misses there are and alert.
    Rates are 0 where nothing was planted; fp_ratio is infinite where nothing is detected.
    """
    base = screening_sweep(alerts, truth, grid)
    n, near = people.agg(F.count(F.lit(1)), F.count(F.when(F.col("near_miss"), 1))).first()
    best = alerts.groupBy("subject_id").agg(F.max("final_score").alias("best")).join(people.where("near_miss").select("subject_id"), "subject_id", "left_semi")
    hits = best.agg(*(F.count(F.when(F.col("best") >= t, 1)).alias(f"n{k}") for k, t in enumerate(grid)))
    hits = hits.select(F.inline(F.array(*(F.struct(F.lit(float(t)).alias("_t"), F.col(f"n{k}").alias("near_misses_alerted")) for k, t in enumerate(grid)))))
    d = base.join(F.broadcast(hits), F.col("threshold") == F.col("_t"))  # a row per threshold
    planted = truth.count()
    share = lambda a, b: F.round(F.coalesce(a / F.nullif(F.lit(float(b)), F.lit(0.0)), F.lit(0.0)), 6)
    return d.select(
        "threshold", F.lit(planted).cast("long").alias("planted_true_matches"), F.col("detected").alias("detected_true_matches"), "recall", "alerted_subjects", "alert_rows",
        share(F.col("alerted_subjects"), n).alias("alert_rate"), "precision", F.round("fp_ratio", 4).alias("false_positive_ratio"), F.lit(near).cast("long").alias("planted_near_misses"),
        "near_misses_alerted", share(F.col("near_misses_alerted"), near).alias("near_miss_alert_rate"), "escalations",
    )


def transaction_flags(tx: DataFrame, risk: DataFrame, near: tuple[float, float] = (8200.0, 9900.0), ctr: float = 10000.0) -> DataFrame:
    """txn_id and flags: CTR_REPORTABLE, else NEAR_CTR_CASH; HIGH_RISK_CORRIDOR; ROUND_VALUE. ``high``: one of them
    is of high severity, the corridor's."""
    high = risk.where("tier = 'HIGH'").select("country_key", F.lit(True).alias("_h"))
    t = tx.join(high, "country_key", "left")
    a, cash = F.col("amount"), F.col("channel") == "CASH"
    big, close, hot = a >= ctr, cash & a.between(*near), F.coalesce("_h", F.lit(False))
    whole = F.col("channel").isin("WIRE", "ACH") & (a >= 1000) & (a == F.round(a / 1000.0) * 1000.0)
    flags = F.array_compact(F.array(F.when(big, "CTR_REPORTABLE").when(close, "NEAR_CTR_CASH"), F.when(hot, "HIGH_RISK_CORRIDOR"), F.when(whole, "ROUND_VALUE")))
    return t.select("txn_id", F.array_join(flags, ",").alias("flags"), hot.alias("high"))
