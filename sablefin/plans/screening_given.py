"""Screening that SQL can state end to end: one blocking strategy, by initials, and Jaro-Winkler as the only signal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.config import SCREENING_GRID, Screening
from sablefin.operators import screening as sc
from sablefin.plans.screening import alerts_of
from sablefin.session import settle
from sablefin.sources import given, tables as t

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
#: No word is removed from a name: the SQL keeps them all, those too that a planted name's cut turns into titles, legal forms or particles.
CFG = Screening(strategies=("IB",), jaro_winkler=1.0, token_set=0.0, phonetic=0.0, initials=0.0, honorifics=frozenset(), legal_forms=frozenset(), particles=frozenset())


def _add(name: str, query, sql: str) -> None:
    QUERIES[name] = query
    ORACLE_SQL[name] = sql


_KEY = "'IB:' || array_to_string(list_sort(list_distinct(list_transform(t, lambda x: x[1])))[1:2], '')"
_KEYED = f"""{given.SQL},
refs AS MATERIALIZED (SELECT *, {_KEY} AS key FROM (SELECT uid, pos, ref_name AS r_name, list_sort(string_split(ref_name, ' ')) AS t FROM (
  SELECT uid, 0 AS pos, name AS ref_name FROM watch UNION ALL SELECT uid, 1, alias FROM watch WHERE alias IS NOT NULL))),
subs AS MATERIALIZED (SELECT *, {_KEY} AS key FROM (SELECT *, list_sort(string_split(name, ' ')) AS t FROM who)),
big AS MATERIALIZED (SELECT key FROM refs GROUP BY key HAVING count(*) > {CFG.max_block}),
rk AS MATERIALIZED (SELECT * REPLACE (CASE WHEN key IN (SELECT key FROM big) THEN key || '|' || t[1][1] ELSE key END AS key) FROM refs),
sk AS MATERIALIZED (SELECT * REPLACE (CASE WHEN key IN (SELECT key FROM big) THEN key || '|' || t[1][1] ELSE key END AS key) FROM subs)"""
_PER = "SELECT subject_id, count(uid) AS n FROM sk LEFT JOIN rk USING (key) GROUP BY 1"


def initial_keys(spark: SparkSession, d: str) -> DataFrame:
    refs = sc.references(given.feed(spark, d)[1], CFG)
    return refs.select("uid", F.col("pos").cast("int").alias("pos"), "n.normalized", "n.sorted_key", "n.initials", "n.script", F.array_join("n.keys", " ").alias("keys"))


_add("initial_keys", initial_keys, f"{_KEYED} SELECT uid, pos, r_name AS normalized, array_to_string(t, ' ') AS sorted_key, r_name[1] || split_part(r_name, ' ', 2)[1] AS initials, 'LATIN' AS script, key AS keys FROM refs")


def initial_candidates(spark: SparkSession, d: str) -> DataFrame:
    c, w, _ = given.feed(spark, d)
    return sc.candidate_counts(sc.subjects(c, CFG), settle(sc.references(w, CFG), "references"), CFG)


_add("initial_candidates", initial_candidates, f"{_KEYED} SELECT subject_id, n AS candidates FROM ({_PER}) WHERE n > 0")
_add(
    "initial_blocking_stats", lambda s, d: sc.blocking_stats(*given.feed(s, d)[:2], CFG),
    f"""{_KEYED}, per AS MATERIALIZED ({_PER}), a AS (SELECT count(*) AS queries, sum(n)::BIGINT AS candidate_pairs, max(n) AS max_candidates,
  list_sort(list(n))[least(count(*) - 1, floor(count(*) * 0.95))::BIGINT + 1] AS p95_candidates, (SELECT count(*) FROM refs) AS "references" FROM per),
b AS (SELECT count(*) AS blocks, max(n) AS largest_block FROM (SELECT count(*) AS n FROM rk GROUP BY key))
SELECT *, (SELECT count(*) FROM big) AS refined_blocks, candidate_pairs / queries AS mean_candidates, 1 - candidate_pairs / (queries * "references") AS reduction FROM a, b""",
)
_add("initial_key_counts", lambda s, d: sc.key_counts(sc.references(given.feed(s, d)[1], CFG)), f"{_KEYED} SELECT 'IB' AS strategy, count(DISTINCT key) AS blocks, count(*) AS entries FROM refs")


def initial_recall(spark: SparkSession, d: str) -> DataFrame:
    c, w, truth = given.feed(spark, d)
    return sc.blocking_recall(truth, c, w, CFG)


_add("initial_recall", initial_recall, f"{_KEYED} SELECT count(*) AS truth, count(*) FILTER (hit) AS found, count(*) FILTER (hit) / count(*) AS recall FROM (SELECT subject_id, uid, EXISTS (SELECT 1 FROM sk JOIN rk USING (key) WHERE sk.subject_id = p.subject_id AND rk.uid = p.uid) AS hit FROM truth p)")

_JW = "jaro_winkler_similarity({a}, {b})"
_HAS = "coalesce({c}, '') <> ''"
_BOTH = " AND ".join
_ALERTS = f"""{_KEYED},
pairs AS (SELECT DISTINCT s.name AS s_name, s.t AS st, r.r_name, r.t AS rt FROM sk s JOIN rk r USING (key)),
near AS (SELECT *, {_JW.format(a="array_to_string(st, ' ')", b="array_to_string(rt, ' ')")} AS pre, {_JW.format(a="s_name", b="r_name")} AS direct FROM pairs WHERE pre >= {CFG.prefilter}),
short AS MATERIALIZED (SELECT s_name, r_name, uid, pos, pre, greatest(direct, pre) AS name_score, pre > direct + 1e-9 AS order_swapped, row_number() OVER (PARTITION BY s_name ORDER BY round(pre, 9) DESC, uid, pos) AS k,
  count(*) OVER (PARTITION BY s_name) > {CFG.shortlist} AS cut FROM near JOIN refs USING (r_name) QUALIFY k <= {CFG.shortlist}),
tested AS (SELECT s.*, p.subject_id, w.name AS watchlist_name, program, p.dob <> '' AND w.dob <> '' AS both_dob, p.dob = w.dob AS same_dob, p.dob[1:4] = w.dob[1:4] AS same_year,
  p.nationality = w.nationality AS same_nat, p.nationality <> w.nationality AS other_nat, p.national_id = w.national_id AS same_id FROM short s JOIN who p ON p.name = s.s_name JOIN watch w USING (uid)),
signs AS (SELECT *, coalesce(both_dob AND same_dob, false) AS d1, coalesce(both_dob AND NOT same_dob AND same_year, false) AS d2, coalesce(both_dob AND NOT same_dob AND NOT same_year, false) AS d3,
  coalesce(same_nat, false) AS n1, coalesce(other_nat, false) AS n2, coalesce(same_id, false) AS i1 FROM tested),
scored AS (SELECT *, CASE WHEN d1 THEN {CFG.dob_exact} ELSE 0::DOUBLE END + CASE WHEN d2 THEN {CFG.dob_year_only} ELSE 0 END + CASE WHEN d3 THEN {CFG.dob_mismatch} ELSE 0 END
  + CASE WHEN n1 THEN {CFG.nationality_match} ELSE 0 END + CASE WHEN n2 THEN {CFG.nationality_mismatch} ELSE 0 END + CASE WHEN i1 THEN {CFG.id_exact} ELSE 0 END AS delta, least(1, greatest(0, name_score + delta)) AS plain,
  CASE WHEN name_score >= {CFG.strong_name_floor} THEN greatest(plain, {CFG.strong_name_floor_score}) ELSE plain END AS final_score FROM signs),
one AS (SELECT * FROM scored WHERE final_score >= 0.70 QUALIFY row_number() OVER (PARTITION BY subject_id, uid ORDER BY round(final_score, 9) DESC, CASE WHEN cut THEN -round(pre, 9) END NULLS FIRST, pos) = 1),
alerts AS MATERIALIZED (SELECT *, CASE WHEN final_score >= {CFG.escalate} THEN 'ESCALATE' WHEN final_score >= {CFG.review} THEN 'REVIEW' ELSE 'DISCARD' END AS decision FROM one
  QUALIFY row_number() OVER (PARTITION BY subject_id ORDER BY round(final_score, 9) DESC, uid) <= 3)"""


def alerts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Alerts, with scores to nine digits so that thresholds cut alike in any engine, people and truth."""
    c, w, truth = given.feed(spark, d)
    return settle(sc.screen_many(c, w, CFG, digits=sc.TIE), "alerts"), c, truth


def initial_alerts(spark: SparkSession, d: str) -> DataFrame:
    got = alerts_of(sc.screen_many(*given.feed(spark, d)[:2], CFG))
    return got.drop("token_set", "phonetic", "initials")


_WHY = "array_to_string(list_sort(list_filter([CASE WHEN d1 THEN 'dob_exact' END, CASE WHEN d2 THEN 'dob_year_only' END, CASE WHEN d3 THEN 'dob_mismatch' END, CASE WHEN n1 THEN 'nationality_match' END, CASE WHEN n2 THEN 'nationality_mismatch' END, CASE WHEN i1 THEN 'id_exact' END, CASE WHEN final_score > plain THEN 'strong_name_floor' END], lambda x: x IS NOT NULL)), ',')"
_add(
    "initial_alerts", initial_alerts,
    f"""{_ALERTS} SELECT subject_id, s_name AS subject_name, uid AS watchlist_uid, watchlist_name, program, CASE WHEN pos = 0 THEN 'primary' ELSE 'alias' END AS matched_on, round(name_score, 6) AS name_score, round(delta, 6) AS corroboration_delta,
  round(final_score, 6) AS final_score, decision, round(name_score, 6) AS jaro_winkler, order_swapped, {_WHY} AS corroboration FROM alerts""",
)
_GRID = "(VALUES " + ", ".join(f"({x}::DOUBLE)" for x in SCREENING_GRID) + ") g(threshold)"
_CUT = f"""{_ALERTS}, m AS (SELECT threshold, count(uid) AS alert_rows, count(DISTINCT a.subject_id) AS alerted_subjects, count(*) FILTER (decision = 'ESCALATE') AS escalations,
  count(DISTINCT a.subject_id) FILTER (hit) AS detected, count(DISTINCT a.subject_id) FILTER (near_miss) AS near_hit FROM {_GRID} LEFT JOIN (
    SELECT alerts.*, t.uid IS NOT NULL AS hit, near_miss FROM alerts LEFT JOIN truth t USING (subject_id, uid) JOIN who USING (subject_id)) a ON round(final_score, 9) >= threshold GROUP BY 1)"""
_RATES = "round(detected / (SELECT count(*) FROM truth), 6) AS recall, CASE WHEN alerted_subjects = 0 THEN 0 ELSE round(detected / alerted_subjects, 6) END AS precision"
_FP = "CASE WHEN detected = 0 THEN 'inf'::DOUBLE ELSE (alerted_subjects - detected) / detected END"


def initial_sweep(spark: SparkSession, d: str) -> DataFrame:
    a, _, truth = alerts(spark, d)
    return sc.screening_sweep(a, truth)


_add("initial_sweep", initial_sweep, f"{_CUT} SELECT threshold, alert_rows, alerted_subjects, escalations, detected, {_RATES}, round({_FP}, 6) AS fp_ratio FROM m")
_add(
    "initial_metrics", lambda s, d: sc.screening_metrics(*alerts(s, d), SCREENING_GRID),
    f"""{_CUT} SELECT threshold, (SELECT count(*) FROM truth) AS planted_true_matches, detected AS detected_true_matches, {_RATES}, alerted_subjects, alert_rows, round(alerted_subjects / (SELECT count(*) FROM who), 6) AS alert_rate,
  round({_FP}, 4) AS false_positive_ratio, (SELECT count(*) FILTER (near_miss) FROM who) AS planted_near_misses, near_hit AS near_misses_alerted,
  round(near_hit / (SELECT count(*) FILTER (near_miss) FROM who), 6) AS near_miss_alert_rate, escalations FROM m""",
)


def normalized_words(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct word of the documents, accents and all, as a name."""
    words = t.read_table(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(_LETTERS), F.lit(0))).alias("name")).distinct()
    return words.select("name", sc.normalized(F.col("name"), CFG).alias("n")).select("name", "n.normalized", "n.initials", "n.script", F.array_join("n.keys", " ").alias("keys"))


_LETTERS = "[A-Za-zÀ-ÖØ-öø-ÿ]{2,}"
_add(
    "normalized_words", normalized_words,
    f"""SELECT name, n AS normalized, n[1] AS initials, 'LATIN' AS script, 'IB:' || n[1] AS keys FROM (SELECT name, replace(lower(strip_accents(name)), 'ß', 'ss') AS n FROM (
  SELECT DISTINCT unnest(regexp_extract_all(coalesce(text, ''), '{_LETTERS}')) AS name FROM documents))""",
)
