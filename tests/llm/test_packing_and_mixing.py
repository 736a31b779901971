"""Tokens, packing, mixing, search, and the whole pipeline against plain versions."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sablefin.llm import mixing, packing, packing_plan, secrets, simhash, token_kernel, tokens, topk


@pytest.fixture(scope="module")
def library():
    return token_kernel.load(token_kernel.default_path())


def plain_ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


HARD = ["it's I'LL <|endoftext|> x<|startoftext|>", "<|ENDOFTEXT|>!!", "Ünïcode é́ ÀÉ ΑΣ ½²① 漢字 😀", "a\u0085b c d", "tail,.!? (x) [y]", "1234 5.6"]


def test_parts_give_the_library_s_ids(library):
    import random

    rng, e = random.Random(3), token_kernel.Encoder(token_kernel.default_path())
    al = "abcXYZ é'ß.,!?<|>endoftext \t\nİΣς́ñ12½漢😀#*&\x1c"
    for t in HARD + ["".join(rng.choice(al) for _ in range(rng.randint(0, 30))) for _ in range(5000)]:
        assert e.ids(t.encode()).tolist() == plain_ids(library, t), t


@pytest.mark.parametrize("head", [20, 200_000])
def test_counts(docs_of, odd_rows, library, head):
    """With a head of 20 pre-tokens most counts go the way of the rest."""
    rows = odd_rows + [(200 + k, t, "en", "a") for k, t in enumerate(HARD)]
    got = tokens.count_tokens(docs_of(rows, clash=True), token_kernel.default_path(), head=head, local=max(head // 2, 5)).collect()
    want = sorted((repr(i), len((t or "").encode()), len(plain_ids(library, t))) for i, t, _, _ in rows)
    assert sorted((repr(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == want
    assert tokens.count_tokens(docs_of([]), token_kernel.default_path()).count() == 0


def test_hot_long_chunks_are_held(docs_of, library):
    """A 200-byte chunk in all rows is a heavy hitter; chunks over the bound are counted where they are."""
    hot, huge = "https://example.org/" + "a1-" * 60, "é漢x" * 20_000
    rows = [(k, f"w{k} {hot} tail{k % 7}") for k in range(400)] + [(1000, f"{huge} {hot}"), (1001, huge)]
    texts = docs_of(rows).select(F.col("text").cast("binary").alias("text"))
    held = tokens.heavy_hitters(texts, 200_000, 40_000)
    assert hot.encode() in held and max(map(len, held)) <= tokens.HUGE
    few = tokens.heavy_hitters(texts, 200_000, 40_000, held_bytes=220)
    assert hot.encode() in few and sum(map(len, few)) <= 220 < sum(map(len, held))
    got = tokens.count_tokens(docs_of(rows), token_kernel.default_path()).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len(plain_ids(library, t)) for i, t in rows}


def check_packing(got, texts, library, capacity=4096):
    """Pieces cover each document's ids exactly; sequences are gapless and within capacity."""
    want = Counter()
    for i, t in texts:
        ids = [*plain_ids(library, t), 1]
        for k, a in enumerate(range(0, len(ids), capacity)):
            some = ids[a : a + capacity]
            want[(repr(i), k, a, len(some), zlib.crc32(np.array(some, "<u4").tobytes()))] += 1
    assert Counter((repr(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for v in by.values():
        at = 0
        for o, n in sorted(v):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


def test_packing(docs_of, odd_rows, library):
    got = packing.pack(docs_of(odd_rows, clash=True), token_kernel.default_path()).collect()
    n = check_packing(got, [(i, t) for i, t, _, _ in odd_rows], library)
    assert n <= -(-sum(r["length"] for r in got) // 4096) + 1
    assert packing.pack(docs_of([]), token_kernel.default_path()).count() == 0


def first_fit(lengths, capacity):
    bins: list[int] = []
    for n in sorted(lengths, reverse=True):
        k = next((k for k, b in enumerate(bins) if b + n <= capacity), None)
        if k is None:
            bins.append(n)
        else:
            bins[k] += n
    return len(bins)


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_each_piece_once_and_packs_tightly(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(rng.lognormal(5.5, 1.2, 3000).astype(int) + 1, 1023)
    counts = np.bincount(lengths, minlength=1025)
    seg, n = packing_plan.make_plan(counts, 1024, n_classes=32, cell=8)
    fill: dict[tuple[int, int], int] = {}
    for length, first, last, each, sequence, offset in seg.tolist():
        for r in range(last - first):
            fill[(sequence + r // each, offset + r % each * length)] = length
    assert len(fill) == len(lengths)
    for length in np.unique(lengths):  # ranks of a length are covered without gap
        runs = sorted((a, b) for n_, a, b, *_ in seg.tolist() if n_ == length)
        assert runs[0][0] == 0 and all(x[1] == y[0] for x, y in zip(runs, runs[1:], strict=False)) and runs[-1][1] == counts[length]
    ends: dict[int, int] = {}
    for s, o in sorted(fill):
        assert ends.get(s, 0) == o
        ends[s] = o + fill[(s, o)]
    assert max(ends.values()) <= 1024 and len(ends) == n
    assert n <= first_fit(lengths.tolist(), 1024) * 1.01 + 2


def test_program_decides_where_no_lengths_fill_a_sequence():
    """2063 + 1040 + 991 and 2 * 1056 + 2 * 991 take 1.5 sequences a piece of 2063; best fit takes 1.83."""
    counts, n = np.zeros(4097, np.int64), 3000
    counts[[2063, 1056, 1040, 991]] = n, n, n, 2 * n
    seg, sequences = packing_plan.make_plan(counts, 4096)
    assert sequences < 1.6 * n
    placed = np.zeros(4097, np.int64)
    for length, first, last, *_ in seg.tolist():
        assert first == placed[length]
        placed[length] = last
    assert (placed == counts).all()


@pytest.mark.parametrize("spread", [0.5, 1.0, 1.5])
def test_plan_comes_from_the_program_and_is_near_the_bound(spread):
    """Most sequences are configurations of the program; none is a plan of best fit alone."""
    lengths = np.clip(np.random.default_rng(1).lognormal(5.5, spread, 30_000).astype(int), 1, 4095)
    plan = packing_plan.solve(np.bincount(lengths, minlength=4097), 4096)
    assert plan.sequences <= -(-int(lengths.sum()) // 4096) * 1.001 + 1
    assert plan.configured > 0.6 * plan.sequences


def test_rounding_keeps_the_uses_of_every_stretch():
    rng = np.random.default_rng(3)
    solved = [(rng.multinomial(4, np.ones(6) / 6), float(t)) for t in rng.exponential(0.4, 400)]
    got = packing_plan.rounded(solved)
    assert abs(sum(k for _, k in got) - sum(t for _, t in solved)) < 1
    for g in range(6):  # those whose largest class is g follow each other
        mine = lambda some: sum(t for u, t in some if np.flatnonzero(u)[-1] == g)  # noqa: E731, B023
        assert abs(mine(got) - mine(solved)) < 1


def test_pricing_finds_the_most_valuable_configuration():
    rng = np.random.default_rng(2)
    for _ in range(20):
        sizes, values = rng.integers(2, 12, 5), rng.random(5)
        use = packing_plan.price(sizes, values, 20)
        best = np.zeros(21)
        for c in range(1, 21):
            best[c] = max([best[c - 1], *(best[c - s] + v for s, v in zip(sizes, values, strict=True) if s <= c)])
        assert (use * sizes).sum() <= 20 and abs((use * values).sum() - best[20]) < 1e-9


def test_plan_size_does_not_grow_with_documents():
    counts = np.bincount(np.random.default_rng(1).integers(1, 900, 20_000), minlength=1025)
    small, _ = packing_plan.make_plan(counts, 1024, 32, cell=8)
    large, _ = packing_plan.make_plan(counts * 10_000, 1024, 32, cell=8)
    assert len(large) < 3 * len(small) + 2000


def test_targets():
    t = mixing.targets([("b", 100), ("a", 100), (None, 100), ("c", 10)])
    assert list(t) and abs(sum(t.values()) - 1.5 * 310) < 1e-6  # a 5, b 2, c 1, null 5
    assert t["c"] == 20 and abs(t["a"] - 445 * 5 / 12) < 1e-6 and t["a"] == t[None] and abs(t["b"] - 445 / 6) < 1e-6
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


def test_pivotal_steps_keep_mass_and_expectation():
    size, share = np.array([50, 40, 30, 20, 10, 5, 0]), np.array([0.3, 0.6, 0.2, 0.9, 0.5, 0.4, 0.5])
    total = np.zeros(len(size))
    for s in range(4000):
        p, left = mixing.pivot(size, share, np.random.default_rng(s))
        whole = [k for k in range(len(p)) if k != left]
        assert all(p[k] in (0.0, 1.0) for k in whole)
        assert abs((p * size).sum() - (share * size).sum()) < 1e-9
        total += p
    assert np.abs(total / 4000 - share).max() < 0.04


@pytest.mark.parametrize("leaf", [4, 4096])
def test_mix(docs_of, odd_rows, leaf):
    """A leaf of 4 makes the tree deep."""
    df = docs_of(odd_rows, clash=True)
    run = lambda d: mixing.copies(d, mixing.n_words(F.col("text")), leaf=leaf)
    got = run(df).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["copies"] <= 2 for r in got)
    again = run(df.repartition(7)).collect()
    key = lambda rows: sorted((repr(r["doc_id"]), r["size"], r["copies"]) for r in rows)
    assert key(got) == key(again)
    by: dict = {}
    for r in got:
        x = by.setdefault((r["source_size"], r["target"]), [0, 0])
        x[0] += r["copies"] * r["size"]
        x[1] = max(x[1], r["size"])
    for (_, target), (taken, largest) in by.items():
        assert abs(taken - target) <= largest / 2 + 1e-6
    mixed = mixing.mix(df, leaf=leaf)
    assert mixed.columns == df.columns and mixed.count() == sum(r["copies"] for r in got)
    assert mixing.mix(docs_of([])).count() == 0


def plain_search(rows, query, k):
    v = [(r, i, [int(np.floor(64 * float(x))) for x in e]) for r, (i, e) in enumerate(rows) if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    out = []
    for r, i, q in v:
        if i is not None and query(i):
            s = [(-sum(a * b for a, b in zip(q, x, strict=False)), j is None, j or 0, j) for n, j, x in v if n != r]
            out += [(i, n + 1, j, -m) for n, (m, _, _, j) in enumerate(sorted(s)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("shard", "block"), [(1000, 1000), (17, 3)])
def test_search_is_exact(spark, shard, block):
    rng = np.random.default_rng(5)
    rows = [(k, rng.normal(size=24).astype(np.float32).tolist()) for k in range(120)] + [(k + 200, [0.5] * 24) for k in range(30)]
    rows += [(20, None), (40, [float("nan")] * 24), (60, [None, *[1.0] * 23]), (80, [float("inf")] * 24), (None, [0.1] * 24), (0, [0.2] * 24), (0, [0.2] * 24), (300, [1.0, 2.0]), (320, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("label", F.lit("x")).withColumn("rank", F.lit(1))
    got = topk.search(df, F.col("vec_id") % 20 == 0, k=20, shard=shard, block=block).collect()
    want = plain_search(rows, lambda i: i % 20 == 0, 20)
    assert sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got), key=repr) == want
    assert topk.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("most", [1e3, 1e6, 1e12, 1e30])
def test_search_of_large_components_is_exact(spark, most):
    """Products beyond doubles and longs: exact while a long holds the score, the nearest long beyond."""
    rng = np.random.default_rng(6)
    rows = [(k, (rng.normal(size=6) * most).astype(np.float32).tolist()) for k in range(40)] + [(100, [most] * 6), (120, [-most] * 6)]
    got = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=50, shard=15, block=2).collect()
    edge = (1 << 63) - 1
    near = lambda x: min(max(x, -edge - 1), edge)
    v = [(i, [near(int(np.floor(64 * float(x)))) for x in e]) for i, e in rows]
    want = {(i, j): near(sum(a * b for a, b in zip(q, x, strict=True))) for i, q in v if i % 20 == 0 for j, x in v if i != j}
    assert {(r["query_id"], r["vec_id"]): r["score"] for r in got} == want
    for i in {i for i, _ in want}:
        mine = sorted((r["rank"], r["score"], r["vec_id"]) for r in got if r["query_id"] == i)
        assert [m[1:] for m in mine] == sorted(((s, j) for (q, j), s in want.items() if q == i), key=lambda x: (-x[0], x[1]))


def test_pipeline_keeps_the_contract(docs_of, odd_rows, dir_of, spark, library):
    """Each stage on its predecessor's rows, checked by plain counterparts."""
    rows = odd_rows + [(500, f"{odd_rows[20][1]} token = 24be64439e3e49cf46b2d7c90f3602a3", "en", "a")]
    docs = docs_of(rows, clash=True)
    cols = docs.columns
    stage = dict(corpus_pipeline.STAGES)
    good = stage["quality rules"](spark, docs, "")
    assert good.columns == cols and all(len((r["text"] or "").split()) >= 10 for r in good.collect())
    one = stage["simhash near-dedup"](spark, good, "")
    comp = simhash.simhash_components(good.select("doc_id", "text")).select("component_id").distinct().where("component_id is not null").count()
    assert one.columns == cols and one.where("doc_id is not null").count() == comp
    masked = stage["secret scans"](spark, one, "")
    assert masked.columns == cols and masked.count() == one.count()
    assert secrets.scan(masked).agg(F.sum(F.col("n_assign") + F.col("n_access") + F.col("n_hex"))).first()[0] == 0
    mixed = stage["source mixing"](spark, masked, "")
    assert mixed.columns == cols
    check_packing(stage["best-fit packing"](spark, mixed, "").collect(), [(r["doc_id"], r["text"]) for r in mixed.collect()], library)
    out = corpus_pipeline.run(spark, dir_of(documents=docs.select("doc_id", "text", "lang", "source", "n_chars")))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and out.count() > 0


def test_pipeline_of_nothing(docs_of, dir_of, spark):
    assert corpus_pipeline.run(spark, dir_of(documents=docs_of([]))).count() == 0
