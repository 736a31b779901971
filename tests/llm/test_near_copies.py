"""SimHash components against brute force, and the paths that only large lists take."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from sablefin.llm import components, jaccard, simhash, simhash_kernel as kernel


def brute_fingerprint(text, width):
    w = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [x for x in __import__("re").split("[\x20\x09-\x0d]+", w) if x]
    if not words:
        return 0
    grams = [" ".join(words[i : i + width]) for i in range(max(len(words) - width + 1, 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, fps, bits=4):
    n = len(rows)
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    low = {}
    for i in range(n):
        if rows[i][0] is not None:
            low[find(i)] = min(rows[i][0], low.get(find(i), rows[i][0]))
    return [low.get(find(i)) for i in range(n)]


def test_position_triples_meet_every_four_of_eight():
    from itertools import combinations

    t = [set(x) for x in simhash.position_triples()]
    assert len(t) == 20
    assert all(any(x <= set(q) for x in t) for q in combinations(range(8), 4))


@pytest.mark.parametrize("width", [4, 5])
def test_components_match_brute_force(docs_of, odd_rows, width):
    rows = odd_rows
    got = simhash.simhash_components(docs_of(rows, clash=True), width=width).collect()
    fps = [brute_fingerprint(t, width) for _, t, _, _ in rows]
    want = sorted((repr(r[0]), f, repr(c)) for r, f, c in zip(rows, fps, brute_components(rows, fps), strict=True))
    assert sorted((repr(r["doc_id"]), r["fp"] & (1 << 64) - 1, repr(r["component_id"])) for r in got) == want


@pytest.mark.parametrize("limit", [2, 10_000])
def test_links_connect_what_brute_force_connects(spark, limit):
    """With a list limit of 2 nearly all members go the way of shared points."""
    rng = random.Random(limit)
    base = [rng.getrandbits(64) for _ in range(6)]
    some = set(base)
    for b in base:
        for _ in range(25):
            x = b
            for k in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << k
            some.add(x)
    fps = sorted(some)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), list_limit=limit)
    got = {r["node"]: r["label"] for r in components.components(edges).collect()}
    rows = [(f,) for f in signed]
    want = brute_components(rows, fps)
    assert [got.get(f, f) for f in signed] == want


def test_kernel_counts_bits_in_chunks():
    h = np.random.default_rng(1).integers(0, 1 << 63, 70_000, dtype=np.uint64)
    want = sum(1 << b for b in range(64) if 2 * int((h >> np.uint64(b) & np.uint64(1)).sum()) > len(h))
    assert kernel.majority(h) == want


def test_chain_and_hub_components(spark):
    chain = [(k, k + 1) for k in range(100)]
    hub = [(1000, 1000 + k) for k in range(1, 200)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(chain + hub + [(5, 5), (None, 3)], "a long, b long")).collect()}
    assert {got[k] for k in range(101)} == {0}
    assert {got[1000 + k] for k in range(200)} == {1000}


def test_dedup_keeps_one_of_each_group_and_all_columns(docs_of, odd_rows):
    df = docs_of(odd_rows, clash=True)
    out = simhash.dedup(df)
    assert out.columns == df.columns
    ids = [r["doc_id"] for r in out.collect()]
    fps = [brute_fingerprint(t, 5) for _, t, _, _ in odd_rows]
    want = {c for c in brute_components(odd_rows, fps) if c is not None}
    assert sorted(i for i in ids if i is not None) == sorted(want)
    assert sum(i is None for i in ids) == 1


def test_empty_table(docs_of):
    assert simhash.simhash_components(docs_of([])).count() == 0
    assert simhash.dedup(docs_of([])).count() == 0


def test_query(docs_of, odd_rows, dir_of, spark):
    out = simhash.op9_simhash(spark, dir_of(documents=docs_of(odd_rows)))
    assert dict(out.dtypes) == {"doc_id": "bigint", "fingerprint": "string", "component_id": "bigint"}
    assert {r["fingerprint"] for r in out.where("doc_id in (1, 2, 3)").collect()} == {"0" * 16}


def edited_copies(seed):
    """Texts of 40 to 400 words with edits that put pairs on both sides of 0.8."""
    rng = random.Random(seed)
    rows = []
    for _ in range(8):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(40, 400))]
        for _ in range(12):
            words = list(base)
            for k in rng.sample(range(len(base)), rng.randint(0, max(len(base) // 40, 2))):
                words[k] = f"x{rng.randrange(5000)}"
            rows.append((len(rows) + 1, " ".join(words), "en", "a"))
    return rows


@pytest.mark.parametrize("limit", [2, 10_000])
def test_near_copies_match_brute_force_at_similarity(docs_of, limit):
    """With a list limit of 2 nearly all pairs go the way of labels."""
    rows = edited_copies(limit)
    sets = [set(kernel.shingle_hashes(t.encode(), 5, 42).tolist()) for _, t, _, _ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    far = 0
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                far += (kernel.fingerprint(rows[i][1].encode(), 5, 42) ^ kernel.fingerprint(rows[j][1].encode(), 5, 42)).bit_count() > 4
                a, b = sorted((find(i), find(j)))
                root[b] = a
    got = {r["doc_id"]: r["component_id"] for r in jaccard.near_copies(docs_of(rows), list_limit=limit, block=5).collect()}
    assert far > 20  # more than the fingerprint's four bits reach
    assert got == {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    assert sorted(r["doc_id"] for r in simhash.dedup(docs_of(rows)).collect()) == sorted({rows[find(i)][0] for i in range(len(rows))})


def test_dedup_takes_fingerprint_links_first(docs_of, monkeypatch):
    """The index gets every distinct fingerprint; what it links is verified first, the bands get what that leaves apart."""
    rows = edited_copies(3)
    texts = {t: kernel.fingerprint(t.encode(), 5, 42) for _, t, _, _ in rows}
    seen, checked, index, verify = [], [], simhash.links, jaccard._verified

    def spy_links(fps, *a, **b):
        seen.extend(r["fp"] & (1 << 64) - 1 for r in fps.collect())
        return index(fps, *a, **b)

    def spy_verified(pairs, sets):
        checked.append((pairs.collect(), verify(pairs, sets).collect()))
        return verify(pairs, sets)

    monkeypatch.setattr(simhash, "links", spy_links)
    monkeypatch.setattr(jaccard, "_verified", spy_verified)
    simhash.dedup(docs_of(rows)).count()
    assert sorted(seen) == sorted(set(texts.values()))
    by = {jaccard.kernel.identity(t.encode(), 42): f for t, f in texts.items()}
    (first, linked), (rest, more) = checked
    near = [(a, b) for a in by for b in by if a < b and (by[a] ^ by[b]).bit_count() <= 4]
    assert near and linked and more
    assert brute_components([(w,) for w in by], list(by.values())) == _joined(list(by), first)
    low = dict(zip(by, _joined(list(by), linked), strict=True))
    assert all(low[a] != low[b] for a, b in rest)


def _joined(nodes, pairs):
    low = {w: w for w in nodes}
    for _ in nodes:
        for a, b in pairs:
            low[a] = low[b] = min(low[a], low[b])
    return [low[w] for w in nodes]
