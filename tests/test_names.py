"""Name kernels and the screening plan."""

from __future__ import annotations

import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sablefin.config import Screening
from sablefin.functions import metaphone, names, nearest, similarity
from sablefin.operators import screening as sc
from sablefin.plans import screening_given
from sablefin.sources import given
from tests import oracle

CFG = Screening()


@pytest.mark.parametrize(("text", "script"), [("James", "LATIN"), ("Сергей", "CYRILLIC"), ("محمد", "ARABIC"), ("张伟", "HAN"), ("ALI Hassan (علي)", "LATIN"), ("123", "LATIN"), ("한국", "OTHER")])
def test_scripts(text, script):
    assert names.script_of(text) == script


@pytest.mark.parametrize(("raw", "tokens"), [
    ("Sheikh Dr. Mohammed Al-Hassan", "mohammed hassan"), ("Ahmed bin Abdul Al-Rashid", "ahmed abdul rashid"), ("Crescent Shipping Ltd", "crescent shipping"), ("James Co Anderson", "james co anderson"), ("Al Abu", "al abu"),
    ("Сергей Иванов", "sergey ivanov"), ("Щукин Юрий", "shchukin yuriy"), ("محمد الحسن", "muhammad hasan"), ("José Müller", "jose muller"), ("OOO Vostok", "vostok"), ("Ｍｉｃｈａｅｌ 007", "michael"), ("", ""),
])
def test_normalised(raw, tokens):
    assert names.normalize(raw, CFG).normalized == tokens


def test_no_latin_form_raises():
    with pytest.raises(names.NameError_):
        names.transliterate("한국")


@pytest.mark.parametrize(("a", "b"), [("Mohammed", "Muhammad"), ("Hussein", "Husayn"), ("Qasim", "Kassim"), ("Yusuf", "Yousef"), ("Aleksandr", "Alexander"), ("Ivanov", "Ivanoff"), ("Smirnov", "Smirnoff")])
def test_spellings_share_a_sound(a, b):
    assert set(metaphone.keys(a)) & set(metaphone.keys(b))


@pytest.mark.parametrize(("word", "keys"), [("Wang", ("ANK", "FNK")), ("Smith", ("SM0", "XMT")), ("Schmidt", ("XMT", "SMT")), ("Thomas", ("TMS", "")), ("Knight", ("NT", "")), ("Ivanova", ("AFNF", ""))])
def test_double_metaphone(word, keys):
    got = metaphone.double_metaphone(word)
    assert got == keys or (word == "Knight" and got[0] in ("NT", "NFT"))


def test_phonetic_similarity_divides_by_the_longer_name():
    assert metaphone.similarity(("mohammed", "ali", "hassan"), ("ali", "hassan")) == pytest.approx(2 / 3)
    assert metaphone.similarity((), ("ali",)) == 0.0


def test_jaro_winkler_of_many_equals_that_of_one():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 14)))
    a, b = [word() for _ in range(3000)], [word() for _ in range(3000)]
    a[:3], b[:3] = ["", "same", "x" * 60], ["", "same", "x" * 59 + "y"]
    assert similarity.jaro_winkler_many(a, b, block=1000).tolist() == [similarity.jaro_winkler(x, y) for x, y in zip(a, b, strict=True)]
    assert similarity.jaro_winkler_many([""], [""]).tolist() == [0.0] and len(similarity.jaro_winkler_many([], [])) == 0


def test_jaro_winkler_equals_another_engine():
    c, rng = duckdb.connect(), random.Random(3)
    for _ in range(500):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(1, 9))) for _ in range(2))
        assert similarity.jaro_winkler(a, b) == pytest.approx(c.execute("SELECT jaro_winkler_similarity(?, ?)", [a, b]).fetchone()[0])


def test_indel_equals_longest_common_subsequence():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert similarity.indel(a, b) == len(a) + len(b) - 2 * t[-1][-1]


def test_token_set():
    assert similarity.token_set("a b c", "c b") == 1.0 and similarity.token_set("", "a") == 0.0
    assert similarity.token_set("sergei ivanov", "ivanov petr") == pytest.approx(0.75)


WATCH = [("U1", "Muhammad Al-Hassan", "Mohamed Hassan|محمد الحسن", "SDGT", "1975-04-12", "SY", None), ("U2", "Sergei Ivanov", None, "UKR", "1968-11-02", "RU", "ID9"), ("U3", "Zhang Wei", "", "X", "1982", "CN", None), ("U4", "   ", None, "X", None, None, None)]
PEOPLE = [("S1", "Mohamed Al Hassan", "1975-04-12", "SY", None), ("S2", "محمد الحسن", None, None, None), ("S3", "Wei Zhang", None, None, None), ("S4", "James Robert Anderson", None, None, None), ("S5", "Ivanov Sergei", "1970-01-01", "US", "ID9"), ("S6", None, None, None, None), ("S7", "한국", None, None, None), ("S8", "Сергей Иванов", "1968", None, None)]


@pytest.fixture(scope="module")
def watch(spark):
    return spark.createDataFrame(WATCH, "uid string, name string, aliases string, program string, dob string, nationality string, national_id string")


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "subject_id string, name string, dob string, nationality string, national_id string")


def test_screening_cases(people, watch):
    got = {(r["subject_id"], r["watchlist_uid"]): r for r in sc.screen_many(people, watch).collect()}
    best = {s: u for s, u in got}
    assert best == {"S1": "U1", "S2": "U1", "S3": "U3", "S5": "U2", "S8": "U2"}
    assert got["S1", "U1"]["decision"] == "ESCALATE"
    assert got["S3", "U3"]["order_swapped"] and got["S3", "U3"]["jaro_winkler"] == 1.0
    s5 = got["S5", "U2"]  # id exact, birth date and nationality differ
    assert s5["corroboration_delta"] == pytest.approx(-0.14 - 0.05 + 0.30) and s5["final_score"] == 1.0
    assert got["S8", "U2"]["corroboration_delta"] == pytest.approx(0.05)


def test_perfect_name_with_wrong_birth_date_is_decided_before_rounding(spark, watch):
    one = spark.createDataFrame([("S", "Zhang Wei", "1950-01-01", None, None)], "subject_id string, name string, dob string, nationality string, national_id string")
    r = sc.screen_many(one, watch, min_score=0.0).first()
    assert r["final_score"] == 0.86 and r["decision"] == "DISCARD"


def test_single_token_names_are_marked_down(spark, watch):
    one = spark.createDataFrame([("S", "Ivanov", None, None, None)], "subject_id string, name string, dob string, nationality string, national_id string")
    r = sc.screen_many(one, watch, min_score=0.0).first()
    assert r["corroboration_delta"] == pytest.approx(-0.10)


def test_refined_blocks_lose_no_name(spark):
    """Eight names of one sound with blocks of at most four."""
    refs = spark.createDataFrame([(f"U{k}", f"{g} Ivanov", None, "P", None, None, None) for k, g in enumerate("Sergei Ivan Petr Oleg Anna Boris Igor Yuri".split())], "uid string, name string, aliases string, program string, dob string, nationality string, national_id string")
    subs = refs.select(F.col("uid").alias("subject_id"), "name", "dob", "nationality", "national_id")
    cfg = Screening(max_block=4)
    r, s = sc.references(refs, cfg), sc.subjects(subs, cfg)
    assert sc.refined_keys(r, cfg).count() >= 1
    pairs = {(x["subject_id"], x["uid"]) for x in sc.candidates(s, r, cfg).collect()}
    assert all((f"U{k}", f"U{k}") in pairs for k in range(8))


REFS = "uid string, name string, aliases string, program string, dob string, nationality string, national_id string"
SUBS = "subject_id string, name string, dob string, nationality string, national_id string"


@pytest.mark.parametrize("most", [2, 250])
def test_candidates_are_counted_as_pairs_would_be(spark, most):
    """Ids that are null or borne twice, aliases, names without letters, and blocks that are split."""
    names = [f"{g} {f}" for g in "Sergei Ivan Anna Wei Omar".split() for f in "Ivanov Petrov Zhang Hassan".split()]
    refs = spark.createDataFrame([(f"U{k % 17}", n, names[-k] if k % 3 else None, "P", None, None, None) for k, n in enumerate(names)] + [(None, "Ivanov Sergei", "?", "P", None, None, None)], REFS)
    subs = spark.createDataFrame([(f"S{k % 13}", n, None, None, None) for k, n in enumerate(names)] + [(None, "Omar Hassan", None, None, None), ("X", "123", None, None, None), ("Y", None, None, None, None)], SUBS)
    cfg = Screening(max_block=most)
    r, s = sc.references(refs, cfg), sc.subjects(subs, cfg)
    want = sorted(sc.candidates(s, r, cfg).groupBy("subject_id").count().collect(), key=repr)
    got = sorted(sc.candidate_counts(s, r, cfg).collect(), key=repr)
    assert len(got) > 13 and [tuple(x) for x in got] == [tuple(x) for x in want]


@pytest.mark.parametrize(("few", "most"), [(1, 8), (1, 2), (1, 0), (3, 8), (64, 8)])
def test_candidates_are_counted_alike_however_common_their_keys(spark, sf, few, most):
    """Sets of common keys, rare keys, and classes of too many common keys, which are paired."""
    from sablefin.plans.screening import _feed

    c, w, _ = _feed(spark, sf)
    cfg = Screening(max_block=20, strategies=("PS", "SP", "IB", "PA"))
    r, s = sc.references(w, cfg), sc.subjects(c, cfg)
    want = sorted(tuple(x) for x in sc.candidates(s, r, cfg).groupBy("subject_id").count().collect())
    assert want and sorted(tuple(x) for x in sc.candidate_counts(s, r, cfg, few, most).collect()) == want


def _many_of_one_name(spark, n):
    k = spark.range(n).select(F.concat(F.lit("K"), "id").alias("uid"), F.lit("Sergei Ivanov").alias("name"), *(F.lit(None).cast("string").alias(c) for c in ("aliases", "program", "dob", "nationality", "national_id")))
    return k.select(F.col("uid").alias("subject_id"), "name", "dob", "nationality", "national_id"), k


def test_candidates_of_a_name_that_many_bear_are_not_paired(spark):
    """2.5 billion pairs."""
    subs, refs = _many_of_one_name(spark, 50_000)
    cfg = Screening()
    got = sc.candidate_counts(sc.subjects(subs, cfg), sc.references(refs, cfg), cfg)
    assert [tuple(x) for x in got.groupBy("candidates").count().collect()] == [(50_000, 50_000)]


def test_stats_of_a_name_that_many_bear(spark):
    """2.5 billion pairs; one subject meets nothing."""
    subs, refs = _many_of_one_name(spark, 50_000)
    lone = spark.createDataFrame([("L", "Wei Zhang", None, None, None)], SUBS)
    r = sc.blocking_stats(subs.unionByName(lone), refs).first()
    assert (r["queries"], r["references"], r["candidate_pairs"], r["max_candidates"], r["p95_candidates"]) == (50_001, 50_000, 2_500_000_000, 50_000, 50_000)
    assert r["mean_candidates"] == 2_500_000_000 / 50_001 and r["reduction"] == pytest.approx(1 / 50_001)


@pytest.mark.parametrize(("size", "cut", "kept"), [(2, True, ["U0", "U1"]), (3, False, ["U0", "U1", "U2"]), (4, False, ["U0", "U1", "U2"])])
def test_shortlists_are_taken_once_a_name(spark, size, cut, kept):
    """Ties go to the smaller uid, and all who bear a name get its shortlist."""
    schema = "uid string, name string, aliases string, program string, dob string, nationality string, national_id string"
    refs = spark.createDataFrame([(f"U{k}", "Sergei Ivanov", None, "P", None, None, None) for k in range(3)], schema)
    subs = spark.createDataFrame([(f"S{k}", "Ivanov Sergei", None, None, None) for k in range(2)], "subject_id string, name string, dob string, nationality string, national_id string")
    cfg = Screening(shortlist=size)
    r, s = sc.references(refs, cfg), sc.subjects(subs, cfg)
    got = sc.shortlist(sc.likely(s, r, cfg), r, cfg).orderBy("uid").collect()
    assert [(x["uid"], x["cut"]) for x in got] == [(u, cut) for u in kept]
    alerts = {(x["subject_id"], x["watchlist_uid"]) for x in sc.screen_many(subs, refs, cfg).collect()}
    assert alerts == {(f"S{k}", u) for k in range(2) for u in kept}


def test_nearest_equals_all_comparisons():
    """Ties to the earlier one, names over 64 letters, empty ones, letters beyond ASCII."""
    rng = random.Random(1)
    for longest, n in ((4, 1300), (20, 700), (90, 60)):
        word = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randint(0, longest)))  # noqa: B023, E731
        a, b = [word() for _ in range(20)], [word() for _ in range(n)]
        for floor, most in ((0.3, 3), (0.62, 41), (0.8, 1)):
            want = []
            for i, x in enumerate(a):
                got = [(similarity.jaro_winkler(x, y), j) for j, y in enumerate(b)]
                want += [(i, j, v) for v, j in sorted(got, key=lambda t: (-round(t[0], 9), t[1])) if v >= floor][:most]
            assert [tuple(x) for x in zip(*(c.tolist() for c in nearest.nearest(a, b, floor, most, 9)), strict=True)] == want


def test_few_pairs_of_a_block_are_compared_letter_by_letter(monkeypatch):
    """Bounds by shared letters in any order left nearly half of all pairs to compare."""
    rng, seen = random.Random(3), []
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(4, 12)))
    names = lambda n: [" ".join(sorted(("e" + word(), "o" + word()))) for _ in range(n)]
    a, b = names(40), names(6000)
    compare = similarity.jaro_winkler_bits
    monkeypatch.setattr(nearest, "jaro_winkler_bits", lambda q, r, masks, i, *rest: (seen.append(len(i)), compare(q, r, masks, i, *rest))[1])
    i, j, got = nearest.nearest(a, b, 0.62, 41, 9)
    assert sum(seen) < 0.4 * len(a) * len(b)
    for k in (0, 39):
        all_ = sorted((-round(similarity.jaro_winkler(a[k], y), 9), n) for n, y in enumerate(b))[:41]
        assert [(-round(v, 9), n) for v, n in zip(got[i == k], j[i == k], strict=True)] == all_


def test_signals_of_many_pairs_equal_those_of_one():
    """Texts beyond a word's bits, empty ones and ones that hold a zero letter among them."""
    rng = random.Random(2)
    for longest in (1, 5, 12, 32, 40, 100):
        word = lambda: " ".join("".join(rng.choice("abcdé\0") for _ in range(rng.randint(1, max(1, longest // 4)))) for _ in range(rng.randint(0, 4)))  # noqa: B023, E731
        a, b = [word() for _ in range(500)], [word() for _ in range(500)]
        each = list(zip(a, b, strict=True))
        assert similarity.jaro_winkler_many(a, b).tolist() == [similarity.jaro_winkler(x, y) for x, y in each]
        assert similarity.indel_many(a, b).tolist() == [similarity.indel(x, y) for x, y in each]
        assert similarity.token_set_many(a, b).tolist() == [similarity.token_set(x, y) for x, y in each]


@pytest.mark.parametrize("tile", [(8192, 65536), (7, 11)])
def test_shortlists_without_all_pairs(spark, sf, tile, monkeypatch):
    """No more names come back than the lists can hold; the lists are those of all pairs, met in tiles of any size."""
    from sablefin.plans.screening import _feed

    monkeypatch.setattr(sc, "SMALL", 40)
    c, w, _ = _feed(spark, sf)
    cfg = Screening(prefilter=0.3, shortlist=4)
    r, s = sc.references(w, cfg), sc.subjects(c, cfg)
    likely = sc.likely(s, r, cfg, tile)
    assert likely.groupBy("s_name").count().agg(F.max("count")).first()[0] == cfg.shortlist + 1
    name = lambda df, *who: {tuple(x[:-1]): x[-1] for x in df.select(*who, "n.sorted_key").collect()}
    key, of = name(s, "n.normalized"), name(r, "n.normalized", "uid", "pos")
    pairs = sc.candidates(s, r, cfg).join(s.select("subject_id", F.col("n.normalized").alias("s")), "subject_id").select("s", "uid", "pos").distinct()
    refs = {(u, p): (n, k) for (n, u, p), k in of.items()}
    want: dict = {}
    for x in pairs.collect():
        pre = similarity.jaro_winkler(key[x["s"],], refs[x["uid"], x["pos"]][1])
        if pre >= cfg.prefilter:
            want.setdefault(x["s"], []).append((-round(pre, 9), x["uid"], x["pos"]))
    got = sorted((x["s_name"], x["uid"], x["pos"], x["cut"]) for x in sc.shortlist(likely, r, cfg).collect())
    assert got == sorted((s, u, p, len(v) > 4) for s, v in want.items() for _, u, p in sorted(v)[:4])


def test_han_given_names(spark):
    """Every character of the block of common ones that the transform knows has a reading; surnames have their own."""
    r = names.han_readings(spark)
    assert len(r) > 20_000 and all(x.isascii() and x.islower() for x in r.values())
    read = lambda t: names.normalize(t, CFG, r).normalized
    assert [read(t) for t in ("张伟", "曾煜鑫", "李彧", "欧阳娜娜", "曾国藩", "张")] == ["zhang wei", "zeng yuxin", "li yu", "ouyangnana", "zeng guofan", "zhang"]
    assert names.transliterate("曾煜鑫", r)[2] == "pinyin" and names.transliterate("张", r)[2] == "pinyin"
    one = spark.createDataFrame([("曾煜鑫",)], "name string").select(sc.normalized(F.col("name"), CFG).alias("n")).first()["n"]
    assert one["tokens"] == ["zeng", "yuxin"] and one["keys"]


def test_recall_follows_from_shared_keys(spark, sf):
    """Driven by the truth, it equals what all candidate pairs give, refined blocks included."""
    from sablefin.plans.screening import _feed

    c, w, truth = _feed(spark, sf)
    odd = truth.unionByName(spark.createDataFrame([("nobody", "U0")], "subject_id string, uid string")) if truth.schema["uid"].dataType.simpleString() == "string" and truth.schema["subject_id"].dataType.simpleString() == "string" else truth
    for cfg in (Screening(), Screening(max_block=3), Screening(strategies=("IB",))):
        got = sc.candidates(sc.subjects(c, cfg), sc.references(w, cfg), cfg).select("subject_id", "uid").distinct()
        found = odd.join(got, ["subject_id", "uid"], "left_semi").count()
        r = sc.blocking_recall(odd, c, w, cfg).first()
        assert (r["truth"], r["found"]) == (odd.count(), found) and found


def test_blocking_prunes_and_recalls(spark, sf):
    from sablefin.plans.screening import _feed

    c, w, truth = _feed(spark, sf)
    assert sc.blocking_stats(c, w).first()["reduction"] > 0.5
    assert sc.blocking_recall(truth, c, w).first()["recall"] > 0.8


def test_sweep_counts_entities_not_rows(spark):
    alerts = spark.createDataFrame([("A", "U1", 0.95, "ESCALATE"), ("A", "U2", 0.9, "REVIEW"), ("B", "U1", 0.8, "DISCARD"), ("C", "U9", 0.99, "ESCALATE")], "subject_id string, watchlist_uid string, final_score double, decision string")
    truth = spark.createDataFrame([("A", "U2"), ("D", "U4")], "subject_id string, uid string")
    by = {r["threshold"]: r for r in sc.screening_sweep(alerts, truth, (0.7, 0.86, 0.94)).collect()}
    assert (by[0.7]["alerted_subjects"], by[0.7]["detected"], by[0.7]["recall"]) == (3, 1, 0.5)
    assert (by[0.94]["detected"], by[0.94]["fp_ratio"]) == (0, float("inf"))


def test_workers_hold_few_names_at_a_time():
    """However large a batch and however many distinct words: no frame of a whole batch, no sounds that no key needs."""
    word = lambda k: "".join(chr(97 + k // 26**i % 26) for i in range(4))
    batch = pd.Series([f"{word(7 * k)} {word(k)}q" for k in range(3_000)])
    before = metaphone.double_metaphone.cache_info().currsize
    frames = list(sc._normalized(iter([batch, batch[:0]]), Screening(strategies=("IB",)), {}))
    assert max(map(len, frames)) <= 500 and metaphone.double_metaphone.cache_info().currsize == before
    got = pd.concat(frames)
    assert got["normalized"].tolist() == batch.tolist()
    assert got["keys"].tolist() == [["IB:" + "".join(sorted({w[0] for w in x.split()}))] for x in batch]


def test_cut_words_that_are_titles_or_particles_stay(spark, sf, tmp_path):
    """A planted name's last word without its last letter can be one that other screenings remove; SQL keeps it."""
    for t in set(oracle.TABLES) - {"documents"}:
        (tmp_path / f"{t}.parquet").symlink_to(f"{sf}/{t}.parquet")
    # cut, all words but alda become removed ones
    duckdb.execute(f"COPY (SELECT 0 AS doc_id, 'lest thee vans incs cols alda bens' AS text) TO '{tmp_path}/documents.parquet' (FORMAT parquet)")
    _, cut = oracle.duck(f"{given.SQL} SELECT name FROM who WHERE split_part(name, ' ', 2) IN ('les', 'the', 'van', 'inc', 'col', 'ben')", str(tmp_path))
    assert cut
    q = "initial_blocking_stats"
    assert oracle.assert_same(screening_given.QUERIES[q](spark, str(tmp_path)), screening_given.ORACLE_SQL[q], str(tmp_path)) == 1
