"""Prefix trie of conversations with subtree sums by heavy-path decomposition.

A prefix is known by its depth and the exclusive-or of 128-bit digests of (position, role, text) of its
turns, so keys of all prefixes are running totals, and a parent's key is the child's without the last
turn. Texts never leave the scan.

Each node's child with most members is its heavy one; heavy edges make paths, and a root path crosses at
most log2(conversations) light edges, because a light child has at most half of its parent's members. Sums over
subtrees then take one round for each number of light edges, deepest first: suffix sums along the
paths of that number, whose totals at the heads are added to their parents before the next round.

Running totals, along conversations and paths alike, are two-level: within blocks of positions and
over blocks, so no task holds a whole conversation or path.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.llm.common import n_words, spread, table
from sablefin.operators.ordering import numbered
from sablefin.session import settle

#: Positions of a block.
BLOCK = 4096
#: A chunk of members holds ids that differ only in this many low bits.
CHUNK_BITS = 10
#: Conversations of a group of ids borrow their first turns from the group's first.
GROUP = 20
MOST_KEPT = 3

#: Totals that can be taken of parts and then of what the parts gave: aggregate, and how two are put together.
_TOTALS = {"sum": (F.sum, lambda a, b: a + b), "max": (F.max, F.greatest), "xor": (F.bit_xor, lambda a, b: a.bitwiseXOR(b))}
_NODE = ["depth", "kx", "ky"]
_RESULT = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def running(rows: DataFrame, key: list[str], at: str, totals: dict[str, str], falling: bool = False, block: int = BLOCK) -> DataFrame:
    """``rows`` with each of ``totals`` (column: kind) replaced by its total along ``at`` within ``key``, the row itself included.

    From the least ``at`` on, or with ``falling`` from the largest. Columns aren't null.
    """
    way = F.desc if falling else F.asc
    d = rows.withColumn("_b", F.expr(f"{at} div {block}"))
    inside = Window.partitionBy(*key, "_b").orderBy(way(at)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*(f"_{k}" for k in key)).orderBy(way("_kb")).rowsBetween(Window.unboundedPreceding, -1)
    per = d.groupBy(*(F.col(k).alias(f"_{k}") for k in key), F.col("_b").alias("_kb")).agg(*(_TOTALS[t][0](c).alias(f"_{c}") for c, t in totals.items()))
    carry = per.select(*(f"_{k}" for k in key), "_kb", *(_TOTALS[t][0](f"_{c}").over(before).alias(f"_c_{c}") for c, t in totals.items()))
    carry = carry.where(F.col(f"_c_{next(iter(totals))}").isNotNull())  # blocks that have one before them: few keys have any
    own = [c for c in rows.columns if c not in totals]
    d = d.select(*own, "_b", *(_TOTALS[t][0](c).over(inside).alias(c) for c, t in totals.items()))
    on = F.col("_b") == F.col("_kb")
    for k in key:
        on = on & (F.col(k) == F.col(f"_{k}"))
    out = d.join(carry, on, "left")
    both = {c: F.when(F.col("_kb").isNull(), F.col(c)).otherwise(_TOTALS[t][1](F.col(c), F.col(f"_c_{c}"))) for c, t in totals.items()}
    return out.select(*(both.get(c, F.col(c)).alias(c) for c in rows.columns))


def _digest(*parts: Column) -> list[Column]:
    """128 bits of the parts, joined by colons, as two longs."""
    text = F.md5(F.concat_ws(":", *parts).cast("binary"))
    return [F.conv(F.substring(text, k, 16), 16, -10).cast("long") for k in (1, 17)]


def rebuilt(convs: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) of the rebuilt conversations: turns(conv, pos from 0, a, b: digest of role and text, words, len) and
    lengths(conv, len), which has turnless conversations too.

    Turns are ordered by ``turn``, nulls first, ties by digest. Conversation c is the first h turns of c - c % 20, all if
    it has fewer, none if it doesn't exist, and its own turns after its first h, where h = crc32(decimal c) % 4. Null
    roles and texts are empty; rows without a conversation id belong to none and are left out.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    a, b = _digest(F.length(by).cast("string"), by, said)
    slim = convs.select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), a.alias("a"), b.alias("b"), n_words(said).alias("words"))
    slim = settle(slim.where("conv is not null"), "turns")  # dealing to ranges reads rows twice: texts once
    flip = lambda c: F.col(c).bitwiseXOR(F.lit(-(1 << 63)))  # noqa: E731  orders as the digest's hex text
    slim = numbered(slim, ["conv", "turn", flip("a"), flip("b")], "nth").drop("turn")
    per = slim.groupBy("conv").agg(F.min("nth").alias("start"), F.count(F.lit(1)).alias("n"))
    per = per.withColumn("base", F.expr(f"conv - conv % {GROUP}")).withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % 4)
    per = settle(per, "conversations")
    first = per.where("conv = base").select(F.col("conv").alias("_c"), F.col("n").alias("_n"))
    kept = F.least("h", F.coalesce("_n", F.lit(0)))
    heads = per.join(first, F.col("base") == F.col("_c"), "left").select("conv", "start", "base", "h", kept.alias("kept"), (kept + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len"))
    heads = settle(heads, "conversation-heads")
    # hints: both sides grow with the corpus
    rows = slim.join(heads.select(F.col("conv").alias("_c"), "start", "h", "kept", "len").hint("merge"), F.col("conv") == F.col("_c"))
    rows = settle(rows.select("conv", (F.col("nth") - F.col("start")).alias("pos"), "a", "b", "words", "h", "kept", "len"), "conversation-turns")
    own = rows.where("pos >= h").select("conv", (F.col("pos") - F.col("h") + F.col("kept")).alias("pos"), "a", "b", "words", "len")
    # at most three rows a group, met by at most its twenty conversations
    lent = rows.where(f"pos < {MOST_KEPT} and conv % {GROUP} = 0").select(F.col("conv").alias("base"), "pos", "a", "b", "words")
    borrowed = lent.join(heads.where("kept > 0").select("conv", "base", "kept", "len"), "base").where("pos < kept").select("conv", "pos", "a", "b", "words", "len")
    return own.unionByName(borrowed), heads.select("conv", "len")


def _ends(found: DataFrame) -> DataFrame:
    """(key, ends_sha256): SHA-256 of the ids of ``found``(key, conv) in rising order, comma-joined, by key.

    Ids are joined to chunks of bounded size first; chunks of a key are then hashed in order, one at a time.
    """
    spark = found.sparkSession
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",")
    chunks = settle(found.groupBy(*_NODE, F.shiftright("conv", CHUNK_BITS).alias("chunk")).agg(joined.alias("ids")), "member-chunks")

    def run(batches):
        last = digest = None
        for b in batches:
            keys, shas = [], []
            for key, ids in zip(zip(*(b.column(c).to_pylist() for c in _NODE), strict=True), b.column("ids").to_pylist(), strict=True):
                if key == last:
                    digest.update(b"," + ids.encode())
                    continue
                if last is not None:
                    keys.append(last)
                    shas.append(digest.hexdigest())
                last, digest = key, hashlib.sha256(ids.encode())
            yield _batch(keys, shas)
        if last is not None:
            yield _batch([last], [digest.hexdigest()])

    def _batch(keys, shas):
        cols = list(zip(*keys, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols), pa.array(shas, pa.string())], names=[*_NODE, "ends_sha256"])

    n = spread(spark, chunks.count(), 200_000)
    return chunks.repartition(n, *_NODE).sortWithinPartitions(*_NODE, "chunk").select(*_NODE, "ids").mapInArrow(run, "depth long, kx long, ky long, ends_sha256 string")


def _paths(prefixes: DataFrame, nodes: DataFrame, kids: DataFrame, root: dict, block: int) -> DataFrame:
    """A row per node but the root: conv_id, depth, n_convs, words, n_children, parent_conv_id, light: light edges above it,
    and the head of its heavy path (head_id, head_depth)."""
    named = {c: f"_{c}" for c in _NODE}
    info = nodes.select(*_NODE, "conv_id", "n_convs").join(kids.withColumnsRenamed(named), [F.col(c) == F.col(n) for c, n in named.items()], "left")
    info = settle(info.select(*(F.col(c).alias(n) for c, n in named.items()), "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "heavy"), "node-info")
    # chains of conversations that stand for a node; copies of others drop out
    for_ = nodes.select(F.col("conv_id").alias("conv")).distinct()
    chain = prefixes.select("conv", *_NODE, "words").join(for_, "conv", "left_semi")
    chain = chain.join(info, [F.col(c) == F.col(n) for c, n in named.items()]).select("conv", "depth", "conv_id", "n_convs", "words", "n_children", "heavy")
    # the node above, within blocks that overlap by one row
    b, edge = F.expr(f"depth div {block}"), F.col("depth") % block == block - 1
    chain = chain.withColumn("_b", F.explode(F.when(edge, F.array(b, b + 1)).otherwise(F.array(b)))).withColumn("_own", b == F.col("_b"))
    w = Window.partitionBy("conv", "_b").orderBy("depth")
    above = lambda c, top: F.when(F.col("depth") == 1, F.lit(top)).otherwise(F.lag(c).over(w))
    chain = chain.select("*", above("conv_id", root["conv_id"]).alias("parent_conv_id"), above("heavy", root["heavy"]).alias("_heavy")).where("_own")
    light = F.col("conv_id") != F.col("_heavy")
    # along a conversation the smallest member never falls, so the last light node has the largest of both
    chain = chain.select(
        "conv", "depth", "conv_id", "n_convs", "words", "n_children", "parent_conv_id", light.cast("long").alias("light"),
        F.when(light, F.col("conv_id")).otherwise(root["conv_id"]).alias("head_id"), F.when(light, F.col("depth")).otherwise(0).cast("long").alias("head_depth"),
    )
    done = running(chain, ["conv"], "depth", {"light": "sum", "head_id": "max", "head_depth": "max"}, block=block)
    return done.where("conv = conv_id").drop("conv")


def trie(turns: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """A row per node of the prefix trie of ``turns``(conv, pos from 0 without gaps, a, b, words, len) and ``lengths``(conv, len):

    conv_id (smallest member), depth, parent_conv_id (root: null), n_convs (members), n_children, n_leaves (childless nodes in the
    subtree), saved_tokens (over the subtree: members but one, times words of the node's last turn) and
    ends_sha256 of the members that end there. No conversations give no nodes, turnless ones the root alone.
    """
    spark = turns.sparkSession
    n, least = lengths.agg(F.count(F.lit(1)), F.min("conv")).first()
    if not n:
        return spark.createDataFrame([], _RESULT)
    x, y = _digest(F.col("pos").cast("string"), F.col("a").cast("string"), F.col("b").cast("string"))
    rows = turns.select("conv", (F.col("pos") + 1).cast("long").alias("depth"), x.alias("x"), y.alias("y"), "words", "len")
    rows = rows.withColumns({"kx": F.col("x"), "ky": F.col("y")})
    prefixes = settle(running(rows, ["conv"], "depth", {"kx": "xor", "ky": "xor"}, block=block), "prefixes")
    up = [F.col(k).bitwiseXOR(F.col(c)) for k, c in (("kx", "x"), ("ky", "y"))]
    nodes = prefixes.groupBy(*_NODE).agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.min(up[0]).alias("px"), F.min(up[1]).alias("py"))
    nodes = settle(nodes, "nodes")
    size = F.struct("n_convs", (-F.col("conv_id")).alias("order"))  # most members, then the smallest id
    kids = nodes.groupBy((F.col("depth") - 1).alias("depth"), F.col("px").alias("kx"), F.col("py").alias("ky")).agg(F.count(F.lit(1)).alias("n_children"), (-F.max(size)["order"]).alias("heavy"))
    kids = settle(kids, "children")
    top = kids.where("depth = 0").first()
    root = {"conv_id": least, "heavy": top["heavy"] if top else None, "n_children": top["n_children"] if top else 0}
    paths = _paths(prefixes, nodes, kids, root, block).unionByName(
        spark.createDataFrame([(least, 0, n, 0, root["n_children"], None, 0, least, 0)], "conv_id long, depth long, n_convs long, words long, n_children long, parent_conv_id long, light long, head_id long, head_depth long")
    )
    paths = paths.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")})
    paths = settle(paths, "paths")

    ended = prefixes.where("depth = len").select(*_NODE, "conv").unionByName(lengths.where("len = 0").select(*(F.lit(0).cast("long").alias(c) for c in _NODE), "conv"))
    digests = _ends(ended).withColumnsRenamed({c: f"_{c}" for c in _NODE})
    names = nodes.select(*_NODE, "conv_id").unionByName(spark.createDataFrame([(0, 0, 0, least)], "depth long, kx long, ky long, conv_id long"))
    digests = digests.join(names, [F.col(c) == F.col(f"_{c}") for c in _NODE]).select(F.col("conv_id").alias("_id"), F.col("depth").alias("_d"), "ends_sha256")
    digests = settle(digests, "ends")

    deepest = paths.agg(F.max("light")).first()[0]
    sums, levels, added = ("n_leaves", "saved_tokens"), [], None
    for k in range(deepest, -1, -1):
        level = paths.where(F.col("light") == k)
        if added is not None:
            level = level.join(added, (F.col("conv_id") == F.col("_id")) & (F.col("depth") == F.col("_d")), "left")
            level = level.select(*(c for c in paths.columns if c not in sums), *((F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums))
        level = settle(running(level, ["head_id", "head_depth"], "depth", dict.fromkeys(sums, "sum"), falling=True, block=block), f"subtrees-{k}")
        levels.append(level)
        heads = level.where("depth = head_depth and depth > 0")
        added = heads.groupBy(F.col("parent_conv_id").alias("_id"), (F.col("depth") - 1).alias("_d")).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
    every = levels[0]
    for more in levels[1:]:
        every = every.unionByName(more)
    # ends are as many as nodes at most: merged at every size
    out = every.join(digests.hint("merge"), (F.col("conv_id") == F.col("_id")) & (F.col("depth") == F.col("_d")), "left")
    none = hashlib.sha256(b"").hexdigest()
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256"))


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(*rebuilt(table(spark, sf_dir, "conversations")))


#: crc32 of a decimal in SQL: eight shifts a byte.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda s: ascii(s)::BIGINT)), lambda v, s: "
    "list_reduce(list_prepend(xor(v, s), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda u, z: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384::BIGINT) ELSE u >> 1 END)), 4294967295::BIGINT)"
)
ORACLE = f"""WITH t AS MATERIALIZED (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || ':' || coalesce(text, ''))) - 1 AS pos,
  struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS s FROM conversations WHERE conv_id IS NOT NULL),
h AS MATERIALIZED (SELECT c, c - c % {GROUP} AS base, {_CRC} % 4 AS h FROM (SELECT DISTINCT c FROM t)),
whole AS MATERIALIZED (SELECT h.c, coalesce((SELECT list(t.s ORDER BY pos) FROM t WHERE t.c = h.base AND pos < h.h), []) || coalesce((SELECT list(t.s ORDER BY pos) FROM t WHERE t.c = h.c AND pos >= h.h), []) AS s FROM h),
pre AS MATERIALIZED (SELECT c, d, len(s) = d AS done, sha256(array_to_string(list_transform(s[1:d], lambda z: sha256(z.role) || sha256(z.text)), '')) AS k,
  CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(s[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words FROM whole, unnest(range(len(s) + 1)) u(d)),
node AS MATERIALIZED (SELECT d, k, min(c) AS m, count(*) AS n, min(words) AS words, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (done), '') AS ends FROM pre GROUP BY d, k),
chain AS MATERIALIZED (SELECT pre.c, pre.d, node.m FROM pre JOIN node USING (d, k)),
up AS MATERIALIZED (SELECT node.m, node.d, n, words, ends, chain.m AS parent FROM node LEFT JOIN chain ON chain.c = node.m AND chain.d = node.d - 1),
kids AS MATERIALIZED (SELECT parent AS m, d - 1 AS d, count(*) AS n FROM up WHERE parent IS NOT NULL GROUP BY ALL),
full_ AS MATERIALIZED (SELECT up.*, coalesce(kids.n, 0) AS k FROM up LEFT JOIN kids USING (m, d)),
below AS (SELECT chain.m, chain.d, sum((f.k = 0)::INTEGER) AS leaves, sum((f.n - 1) * f.words) AS saved FROM full_ f JOIN chain ON chain.c = f.m AND chain.d <= f.d GROUP BY ALL)
SELECT m AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, k AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
FROM full_ JOIN below USING (m, d)"""
