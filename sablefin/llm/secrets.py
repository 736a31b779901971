"""Secret scan with corpus-wide ownership frequency. DataFrame functions only.

Base spans are those of three patterns. The method adds a fourth kind, ``generic``: long mixed
strings that look like credentials but that no pattern vouches for. They count only if the corpus
does: candidate values are hashed and tallied by distinct repositories and owners. A value that
few owners hold, in few repositories, is a live-looking credential of those owners; one that many
owners hold, or that is in many repositories of few owners, is an example copied around.

The text is scanned once. What leaves the scan is compact (spans and hashes, never text), is
settled, and only rows that hold candidates take part in the tally, the join and the regrouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.llm.common import blocks, let, replaced, table
from sablefin.session import settle

#: kind -> (pattern, group of the value, least length of the value), in listed order
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"(AKIA[A-Z0-9]+)", 1, 20),
    "hex": (r"([0-9a-f]{24,})", 1, 24),
}
#: Long runs of credential characters; a match must also mix upper case, lower case and digits.
GENERIC = r"([A-Za-z0-9+/_=-]{24,})"
#: A value held by more owners than this, or in more repositories, is a copied example.
MAX_OWNERS = 3
MAX_REPOS = 20


def find_spans(text: Column, kind: str, pattern: str, group: int, least: int, check: Column | None = None) -> Column:
    """array<struct(start, end, kind, value)> of the leftmost non-overlapping matches.

    Positions are code points: the lengths of the gaps between matches and of the matches so far.
    Matches whose value is shorter than ``least`` are dropped and still consume their characters.
    """
    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("v"),
        F.split(text, pattern, -1).alias("gap"),
    )

    def spans(f: Column) -> Column:
        lengths = F.zip_with(f["gap"], f["m"], lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n")))

        def placed(parts: Column) -> Column:
            total = F.transform(parts, lambda b: F.aggregate(b, F.lit(0), lambda acc, x: acc + x["g"] + x["n"]))

            def walk(sums: Column) -> Column:
                def one(b: Column, j: Column) -> Column:
                    # fold over the matches of a block: (place so far, spans)
                    at = F.aggregate(F.slice(sums, 1, j), F.lit(0), lambda acc, x: acc + x)
                    start = F.struct(at.alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
                    return F.aggregate(
                        b,
                        start,
                        lambda acc, x: F.struct(
                            (acc["at"] + x["g"] + x["n"]).alias("at"),
                            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["g"]).alias("start"), (acc["at"] + x["g"] + x["n"]).alias("end")))).alias("out"),
                        ),
                        lambda acc: acc["out"],
                    )

                return F.flatten(F.transform(parts, one))

            return let(total, walk)

        walk = let(blocks(F.slice(lengths, 1, F.size(f["m"]))), placed)
        return F.zip_with(walk, f["v"], lambda s, v: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind"), v.alias("value")))

    return F.filter(let(found, spans), lambda s: F.length(s["value"]) >= least)


def _all_spans(text: Column) -> Column:
    """array<struct(start, rank, end, kind, value)> of base and generic spans, in order."""
    none = F.array().cast("array<struct<start:int,end:int,kind:string,value:string>>")
    base = [
        F.when(text.rlike(pattern), find_spans(text, kind, pattern, group, least)).otherwise(none)
        for kind, (pattern, group, least) in KINDS.items()
    ]
    generic = F.when(text.rlike(GENERIC), find_spans(text, "generic", GENERIC, 1, 1)).otherwise(none)
    ranks = F.create_map(*(F.lit(x) for n, k in enumerate([*KINDS, "generic"]) for x in (k, n)))

    def join(pair: Column) -> Column:
        own, more = pair["own"], pair["more"]
        mixed = F.filter(more, lambda g: g["value"].rlike("[A-Z]") & g["value"].rlike("[a-z]") & g["value"].rlike("[0-9]"))
        # base spans in order, by blocks that know how far they reach
        ends = F.sort_array(F.transform(own, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))))
        reach = F.transform(
            blocks(ends),
            lambda b: F.struct(F.array_min(F.transform(b, lambda s: s["start"])).alias("low"), F.array_max(F.transform(b, lambda s: s["end"])).alias("high"), b.alias("spans")),
        )
        meets = lambda r, g: F.exists(r["spans"], lambda b: (b["start"] < g["end"]) & (g["start"] < b["end"]))
        apart = let(reach, lambda rs: F.filter(mixed, lambda g: ~F.exists(rs, lambda r: (r["low"] < g["end"]) & (g["start"] < r["high"]) & meets(r, g))))
        return F.concat(own, F.when(F.size(own) > 0, apart).otherwise(mixed))

    both = let(F.struct(F.concat(*base).alias("own"), generic.alias("more")), join)
    ordered = F.transform(both, lambda s: F.struct(s["start"].alias("start"), F.element_at(ranks, s["kind"]).alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value")))
    return F.sort_array(ordered)


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _is(kind: str):
    return lambda s: s["kind"] == kind


def ownership(found: DataFrame) -> DataFrame:
    """(hash, owners, repos) of ``found``(hash, owner, repo): distinct owners and distinct
    (owner, repo) pairs of each hash. Repeats fold before each shuffle; no distinct set is
    gathered in one task."""
    pairs = found.groupBy("hash", "owner", "repo").count()
    by_owner = pairs.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("n").alias("repos"))


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **how) -> DataFrame:
    """One row per row of ``docs``: ``keep``, n_assign, n_access, n_hex, n_live, n_example (long) and
    ``found``: array<struct(start, rank, end, kind, owners, repos, live, base)> in order.

    ``found`` has every base span and those generic spans whose value is live: held by at most
    ``max_owners`` owners and in at most ``max_repos`` repositories. n_live and n_example count all
    candidate values, generic ones of either verdict included, so widely copied examples stay visible. Null texts are empty; null owners
    together are one owner, null repositories one repository of theirs; repeated rows are repeated
    in the result. Columns of ``docs`` beside those named aren't touched.
    """
    got = _scanned(docs, keep, **how)
    return got.select("_keep.*", *(c for c in got.columns if c != "_keep"))


def _scanned(
    docs: DataFrame, keep: tuple[str, ...], text: str = "text", owner: str = "source", repo: str = "doc_id", max_owners: int = MAX_OWNERS,
    max_repos: int = MAX_REPOS,
) -> DataFrame:
    body = F.coalesce(F.col(text), F.lit(""))
    # only what is kept leaves this select; the text stays in the scan's own stage
    scanned = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*(F.col(c) for c in keep)).alias("_keep"),
        F.col(owner).cast("string").alias("_owner"),
        F.col(repo).cast("string").alias("_repo"),
        F.transform(
            _all_spans(body),
            lambda s: F.struct(
                s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
                F.substring(F.sha2(s["value"], 256), 1, 32).alias("hash"),
            ),
        ).alias("_spans"),
    )
    scanned = settle(scanned, "secret-spans")
    each = scanned.where(F.size("_spans") > 0).select("_row", "_owner", "_repo", F.explode("_spans").alias("_s"))
    tally = settle(ownership(each.select(F.col("_s.hash").alias("hash"), F.col("_owner").alias("owner"), F.col("_repo").alias("repo"))), "ownership")
    judged = each.select("_row", "_s", F.col("_s.hash").alias("hash")).join(tally, "hash")
    live = (F.col("owners") <= max_owners) & (F.col("repos") <= max_repos)
    span = F.struct(
        *(F.col(f"_s.{c}").alias(c) for c in ("start", "rank", "end", "kind")), "owners", "repos",
        live.alias("live"), (F.col("_s.kind") != "generic").alias("base"),
    )
    by_row = judged.groupBy("_row").agg(F.sort_array(F.collect_list(span)).alias("_found"))
    out = scanned.select("_row", "_keep").where(F.size("_spans") > 0).join(by_row.hint("merge"), "_row")
    kind = "array<struct<start:int,rank:int,end:int,kind:string,owners:bigint,repos:bigint,live:boolean,base:boolean>>"
    idle = scanned.where(F.size("_spans") == 0).select("_row", "_keep", F.array().cast(kind).alias("_found"))
    count = lambda test: F.size(F.filter("_found", test)).cast("long")
    return out.select("_row", "_keep", F.col("_found").cast(kind)).union(idle).select(
        "_keep",
        *(count(_is(k)).alias(f"n_{k}") for k in KINDS),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_example"),
        F.filter("_found", lambda s: s["base"] | s["live"]).alias("found"),
    )


def redact(docs: DataFrame, text: str = "text", mask: str = "[SECRET]", **how) -> DataFrame:
    """``docs``, same columns, with the found spans of each text replaced by ``mask``.

    Base spans go always, generic ones if live. Overlapping spans are merged first. A null text stays
    null. Texts without spans come back as they were. Rows aren't joined back by an id, so rows
    with equal or null ids are safe: the whole row rides along as the kept struct.
    """
    cols = docs.columns
    got = _scanned(docs, tuple(cols), text=text, **how)
    body = F.col("_keep")[text]
    cut = replaced(body, F.col("found"), lambda s, word: F.lit(mask))
    return got.select(*(F.when(F.size("found") > 0, cut).otherwise(body).alias(c) if c == text else F.col("_keep")[c].alias(c) for c in cols))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = scan(table(spark, sf_dir, "documents"))
    base = F.filter("found", lambda s: s["base"])
    return got.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(_written(base), 256).alias("base_sha256"), _written(F.col("found")).alias("spans"), "n_live", "n_example",
    )


def _sql_spans(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    quoted = pattern.replace("'", "''")
    return f"""
  SELECT row, doc_id, source, '{kind}' AS kind, {rank} AS rank, m.v AS value, m.i,
    list_sum(list_transform(g[1:m.i], lambda x: length(x)))::BIGINT + coalesce(list_sum(list_transform(ms[1:m.i - 1], lambda x: length(x))), 0)::BIGINT AS b,
    length(ms[m.i]) AS n
  FROM (SELECT row, doc_id, source, g, ms, unnest(list_transform(vs, lambda v, k: {{'v': v, 'i': k}})) AS m
    FROM (SELECT row, doc_id, source, string_split_regex(t, '{quoted}') AS g, regexp_extract_all(t, '{quoted}', 0) AS ms,
      regexp_extract_all(t, '{quoted}', {group}) AS vs FROM d WHERE regexp_matches(t, '{quoted}')))
  WHERE length(m.v) >= {least}"""


ORACLE = (
    "WITH d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS t FROM documents), base AS MATERIALIZED ("
    + " UNION ALL ".join(_sql_spans(k, n, *KINDS[k]) for n, k in enumerate(KINDS))
    + "), more AS MATERIALIZED (SELECT * FROM ("
    + _sql_spans("generic", 3, GENERIC, 1, 1)
    + f""") g WHERE regexp_matches(value, '[A-Z]') AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[0-9]')
  AND NOT EXISTS (SELECT 1 FROM base s WHERE s.row = g.row AND s.b < g.b + g.n AND g.b < s.b + s.n)),
every AS (SELECT * FROM base UNION ALL SELECT * FROM more),
owned AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT (coalesce(source, chr(0)), coalesce(doc_id::VARCHAR, chr(0)))) AS repos
  FROM every GROUP BY value),
judged AS (SELECT e.*, o.owners <= {MAX_OWNERS} AND o.repos <= {MAX_REPOS} AS live FROM every e JOIN owned o USING (value)),
per AS (SELECT row, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
  count(*) FILTER (kind = 'hex') AS n_hex, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example,
  string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, rank) FILTER (rank < 3) AS base,
  string_agg(kind || ':' || b || ':' || (b + n), ',' ORDER BY b, rank) FILTER (rank < 3 OR live) AS spans
  FROM judged GROUP BY row)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
FROM d LEFT JOIN per USING (row)"""
)
