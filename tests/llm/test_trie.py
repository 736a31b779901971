"""Prefix trie against a plain recursive one and against SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from sablefin.llm import trie
from tests.oracle import assert_same

TURNS = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    """Node rows by the definitions: every prefix of every rebuilt conversation, subtrees by comparing prefixes."""
    own: dict[int, list] = {}
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own.setdefault(c, []).append((t is not None, t or 0, tie, (role, text)))
    said = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(said.get(c - c % trie.GROUP, [])[:h] + v[h:])
    nodes: dict[tuple, list[int]] = {}
    for c, v in whole.items():
        for d in range(len(v) + 1):
            nodes.setdefault(v[:d], []).append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = {p: [q for q in nodes if len(q) == len(p) + 1 and q[:-1] == p] for p in nodes}

    def below(p):
        stack, out = [p], []
        while stack:
            q = stack.pop()
            out.append(q)
            stack += kids[q]
        return out

    got = []
    for p, members in nodes.items():
        sub = below(p)
        ends = ",".join(str(c) for c in sorted(c for c in members if len(whole[c]) == len(p)))
        got.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), len(kids[p]), sum(not kids[q] for q in sub),
            sum((len(nodes[q]) - 1) * words(q) for q in sub), hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(got, key=repr)


def same(df, rows):
    assert sorted((tuple(r) for r in df.collect()), key=repr) == plain(rows)


def feed(rng, n, most=7, texts=4):
    """Conversations that share beginnings, copies, a long one, nulls, ties and repeated rows."""
    out = []
    for c in range(n):
        if rng.random() < 0.1:
            continue
        for t in range(rng.randint(0, most)):
            out.append((c, t, rng.choice(("user", "bot")), " ".join("ab"[rng.randrange(2)] for _ in range(rng.randrange(texts)))))
    hot = [(t, "user", f"same {t % 3}") for t in range(5)]
    out += [(1000 + c, *x) for c in range(60) for x in hot]
    out += [(2000, t, "user", f"t{t % 5}") for t in range(150)] + [(2003, t, "user", f"t{t % 5}") for t in range(140)]
    out += [(3001, 0, None, None), (3001, None, "user", "x"), (3001, None, "user", "x"), (3001, 0, "", ""), (3001, 0, "user", None), (3001, 0, None, "user"), (None, 0, "user", "x"), (3040, 1, None, "only")]
    return out


@pytest.mark.parametrize("block", [4, 4096])
def test_trie(spark, block):
    rows = feed(random.Random(block), 160)
    df = spark.createDataFrame(rows, TURNS).select("*", *(F.lit("x").alias(c) for c in ("conv", "pos", "a", "b", "words", "len", "depth", "kx", "ky", "nth", "n", "_b", "_c", "start")))
    same(trie.trie(*trie.rebuilt(df), block=block), rows)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")], [(3, None, None, None)], [(c, 0, "u", "x") for c in range(4)], [(7, 0, "u", "a b"), (7, 0, "u", "a b")]])
def test_few_rows(spark, rows):
    """No conversations, turnless ones alone, one repeated row."""
    same(trie.trie(*trie.rebuilt(spark.createDataFrame(rows, TURNS))), rows)


def test_members_of_many_chunks(spark):
    ids = [*range(0, 3000 * trie.GROUP, trie.GROUP), -40, trie.GROUP << 40]
    rows = [(c, t, "u", "hi") for c in ids for t in range(5)]
    got = {(r["conv_id"], r["depth"]): r for r in trie.trie(*trie.rebuilt(spark.createDataFrame(rows, TURNS))).collect()}
    assert len(got) == 6
    assert got[-40, 5]["ends_sha256"] == hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()


def test_few_rounds(spark):
    """A comb of 64 long branches: light edges on a root path stay within log2 of the conversations."""
    rows = [(c * trie.GROUP, t, "u", "stem" if t < c else f"{c}") for c in range(64) for t in range(66)]
    same(trie.trie(*trie.rebuilt(spark.createDataFrame(rows, TURNS)), block=16), rows)


def test_query_against_sql(spark, sf, dir_of):
    assert assert_same(trie.op13_trie(spark, sf), trie.ORACLE, sf)
    from tests.oracle import TABLES

    odd = dir_of(**{t: spark.createDataFrame([(1,)], "x int") for t in TABLES if t != "conversations"}, conversations=spark.createDataFrame(feed(random.Random(9), 60), TURNS))
    assert assert_same(trie.op13_trie(spark, odd), trie.ORACLE, odd)
