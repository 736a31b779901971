"""Temporal URL lists. DataFrame functions only.

Dated list entries become validity intervals: an entry that adds a domain holds from its date until the
list's next entry for that domain. Every capture is then evaluated as of its fetch date against the
entries active then, for its host and all parent domains. Captures fold to distinct (host, fetch
date) pairs before any shuffle on hosts, so a host that a third of all captures share is
evaluated once a date; the verdicts join back on both columns, which adaptive execution can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.llm.common import let, table
from sablefin.session import settle

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
#: Longest host name that DNS allows; longer ones are not hosts.
MAX_HOST = 253


def host(url: Column) -> Column:
    """Lower-cased host of an absolute URL, '' where there is none."""
    h = F.rtrim(F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _HOST, 1)), F.lit("."))  # the root's dot isn't part of a name
    return F.when(F.length(h) <= MAX_HOST, h).otherwise("")


def domains(name: Column) -> Column:
    """The host and its parents of two labels or more."""

    def chain(p: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(p) - 1), lambda i: F.array_join(F.slice(p, i, F.size(p)), "."))

    return F.when(F.instr(name, ".") > 0, let(F.split(name, r"\."), chain)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, domain, valid_from, valid_to) from ``entries``(list, domain, dated, action).

    Actions are 'add' and 'remove'. On one date a removal comes last and wins. Repeated entries count
    once; entries with a null in any column are void. valid_to is exclusive, null: still valid.
    """
    cols = ["list", "domain", "dated", "action"]
    clean = entries.select(*cols).dropna().where(F.col("action").isin("add", "remove")).withColumn("domain", F.lower("domain"))
    # one state a date: 'remove' > 'add'
    clean = clean.groupBy("list", "domain", "dated").agg(F.max("action").alias("action"))
    turn = Window.partitionBy("list", "domain").orderBy("dated")
    return clean.withColumn("valid_to", F.lead("dated").over(turn)).where("action = 'add'").select("list", "domain", F.col("dated").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched", keep: tuple[str, ...] = ("page_id",)) -> DataFrame:
    """One row per row of ``captures``: ``keep``, host, fetched, n_active (long), lists (names, sorted,
    comma-joined), since (earliest start of those active), blocked.

    A null or relative URL has host '' and matches nothing, as does a null fetch date. Repeated
    captures stay repeated.
    """
    seen = settle(captures.select(F.struct(*(F.col(c) for c in keep)).alias("_keep"), host(F.col(url)).alias("host"), F.col(fetched).alias("fetched")), "captures")
    pairs = seen.where("host <> '' and fetched is not null").select("host", "fetched").distinct()
    asked = pairs.select("host", "fetched", F.explode(domains(F.col("host"))).alias("domain"))
    active = settle(intervals(entries), "list-intervals")
    hits = asked.join(active, "domain").where((F.col("fetched") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("fetched") < F.col("valid_to"))))
    verdict = hits.groupBy("host", "fetched").agg(
        F.count(F.lit(1)).alias("_n"), F.array_join(F.array_sort(F.collect_set("list")), ",").alias("_lists"), F.min("valid_from").alias("_since")
    )
    verdict = settle(verdict.withColumnsRenamed({"host": "_h", "fetched": "_f"}), "list-verdicts")
    out = seen.join(verdict, (F.col("host") == F.col("_h")) & (F.col("fetched") == F.col("_f")), "left")
    return out.select(
        "_keep.*", "host", "fetched", F.coalesce("_n", F.lit(0)).alias("n_active"), F.coalesce("_lists", F.lit("")).alias("lists"),
        F.col("_since").alias("since"), F.col("_n").isNotNull().alias("blocked"),
    )


# The tables hold neither fetch dates nor list feeds. The query dates captures over 2024 by their id and
# derives a feed from the hosts seen; both engines compute the same from the formulas below.
_BASE = "regexp_replace({h}, '^(www|m|blog|shop|news)[.]', '')"
_HASH = "(ascii(d) * 131 + ascii(substr(d, 2, 1)) * 17 + ascii(substr(d, 3, 1)) * 29 + ascii(substr(d, 4, 1)) * 43 + length(d) * 7)"
_FEED = (("malware", "add", "h % 10 < 3", "h % 200"), ("malware", "remove", "h % 10 < 3 and h % 2 = 0", "h % 200 + 60 + h % 90"), ("malware", "add", "h % 10 < 3 and h % 4 = 0", "h % 200 + 160"), ("adult", "add", "h % 7 = 0", "h % 100"))


def derived_feed(hosts: DataFrame) -> DataFrame:
    """Dated entries for the domains of ``hosts``(host), by the formulas above."""
    d = hosts.where("host <> ''").select(F.expr(_BASE.format(h="host")).alias("d")).distinct().select("d", F.expr(_HASH).alias("h"))
    out = None
    for name, action, test, day in _FEED:
        some = d.where(test).select(F.lit(name).alias("list"), F.col("d").alias("domain"), F.date_add(F.lit("2024-01-01").cast("date"), F.expr(f"cast({day} as int)")).alias("dated"), F.lit(action).alias("action"))
        out = some if out is None else out.union(some)
    return out


def op4_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.expr("cast(page_id * 37 % 366 as int)")).alias("fetched"))
    return evaluate(pages, derived_feed(pages.select(host(F.col("url")).alias("host"))))


ORACLE = (
    f"""WITH p AS (SELECT page_id, DATE '2024-01-01' + (page_id * 37 % 366)::INTEGER AS fetched,
  rtrim(lower(regexp_extract(coalesce(url, ''), '{_HOST}', 1)), '.') AS h0 FROM pages),
s AS (SELECT row_number() OVER () AS r, page_id, fetched, CASE WHEN length(h0) <= {MAX_HOST} THEN h0 ELSE '' END AS host FROM p),
doms AS (SELECT DISTINCT {_BASE.format(h="host")} AS d FROM s WHERE host <> ''),
dh AS (SELECT d, {_HASH} AS h FROM doms),
feed AS ("""
    + " UNION ALL ".join(f"SELECT '{n}' AS list, d AS domain, DATE '2024-01-01' + ({day})::INTEGER AS dated, '{a}' AS action FROM dh WHERE {t}" for n, a, t, day in _FEED)
    + """),
state AS (SELECT list, domain, dated, max(action) AS action FROM feed GROUP BY ALL),
spans AS (SELECT *, lead(dated) OVER (PARTITION BY list, domain ORDER BY dated) AS valid_to FROM state),
asked AS (SELECT r, fetched, unnest(list_transform(range(1, len(string_split(host, '.'))), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS domain FROM s WHERE host <> ''),
hit AS (SELECT r, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists, min(dated) AS since FROM asked JOIN spans USING (domain)
  WHERE action = 'add' AND fetched >= dated AND (valid_to IS NULL OR fetched < valid_to) GROUP BY r)
SELECT page_id, host, fetched, coalesce(n, 0)::BIGINT AS n_active, coalesce(lists, '') AS lists, since, n IS NOT NULL AS blocked FROM s LEFT JOIN hit USING (r)"""
)
