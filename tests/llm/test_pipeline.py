"""run() of the whole pipeline against plain counterparts of its five stages."""

from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from sablefin.llm import quality, secrets, token_kernel
from tests.llm.test_packing_and_mixing import check_packing
from tests.oracle import TABLES, duck

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set()


def groups(texts):
    """Index of the group of each text: linked at a Jaccard similarity of 0.8 or more, by all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both >= 0.8 * (len(a) + len(sets[j]) - both):
                root[find(i)] = find(j)
    return [find(k) for k in range(len(texts))]


def masked(text, spans):
    out, at = [], 0
    for s in filter(None, spans.split(",")):
        a, b = map(int, s.split(":")[1:])
        if a >= at:
            out += [text[at:a], "[SECRET]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_run_against_plain_stages(spark, sf, dir_of):
    given = spark.read.parquet(f"{sf}/documents.parquet")
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8)))
    secret = [" ".join(word() for _ in range(120)) + f". token = {rng.getrandbits(128):032x} " + " ".join(word() for _ in range(60)) for _ in range(4)]
    more = [(10_000 + k, t, "en", "web", len(t)) for k, t in enumerate([*secret, secret[0] + " one more word"])]
    sf = dir_of(**{t: given.unionByName(spark.createDataFrame(more, given.schema)) if t == "documents" else spark.range(1) for t in TABLES})
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = corpus_pipeline.run(spark, sf).collect()
    copies = Counter(r["doc_id"] for r in got if r["piece"] == 0)

    cols, rows = duck(quality.ORACLE, sf)
    good = sorted(r[cols.index("doc_id")] for r in rows if r[cols.index("kept")])
    assert set(copies) <= set(good) and len(good) < len(docs)

    of = dict(zip(good, groups([docs[i]["text"] or "" for i in good]), strict=True))
    assert len({of[i] for i in copies}) == len(copies), "two documents of a group"
    # a source's target exceeds its size or not; where it does, each of its documents is taken once at least
    stage = dict(corpus_pipeline.STAGES)
    table = spark.read.parquet(f"{sf}/documents.parquet")
    one = sorted(r["doc_id"] for r in stage["simhash near-dedup"](spark, stage["quality rules"](spark, table, sf), sf).collect())
    assert Counter(of[i] for i in one) == Counter(set(of.values())) and set(copies) <= set(one)

    # secrets are judged over what is left
    left = table.where(table.doc_id.isin(one))
    d = dir_of(**{t: left if t == "documents" else spark.range(1) for t in TABLES})
    cols, rows = duck(secrets.ORACLE, d)
    text = {r[cols.index("doc_id")]: masked(docs[r[cols.index("doc_id")]]["text"] or "", r[cols.index("spans")]) for r in rows}
    assert any(t != docs[i]["text"] for i, t in text.items())

    # the mix: targets by weights 5, 2, 1 of one and a half times all words, none above twice its source's
    size = {i: len(WORD.findall(t)) for i, t in text.items()}
    sources = sorted({docs[i]["source"] for i in one}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[i] for i in one if docs[i]["source"] == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, budget = {}, 1.5 * sum(total.values())
    while len(target) < len(sources):
        rest = [s for s in sources if s not in target]
        share = {s: budget * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * total[s]]
        for s in over or rest:
            target[s] = 2 * total[s] if over else share[s]
        budget -= sum(target[s] for s in over)
    assert max(copies.values()) <= 2
    for s in sources:
        mine = [i for i in one if docs[i]["source"] == s]
        assert abs(sum(copies[i] * size[i] for i in mine) - target[s]) <= max((size[i] for i in mine), default=0)
    check_packing(got, [(i, text[i]) for i, n in copies.items() for _ in range(n)], token_kernel.load(token_kernel.default_path()))
