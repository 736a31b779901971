"""Quality rules with adaptive thresholds. DataFrame functions only.

Every document gets whole-text measures inside its own row (higher-order functions over its words:
no row leaves its task, however long the text). Fixed cutoffs are replaced by fences taken from
quantile sketches per language and source, over the documents that pass the base rules. The sketch
is a log-linear histogram: a value keeps its top six bits, so a quantile is off by at most 1/32 of
itself, two sketches merge by adding counts, the result doesn't depend on the order of merging, and a
sketch has at most a few hundred cells however many rows went in. A group with too few documents
beyond the quantile borrows its language's merged sketch, a language with too few the whole corpus's.
The fences are then joined back and filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sablefin.llm.common import BLANK_CHARS, let, table, words
from sablefin.session import settle

#: feature -> (quantile in thousandths, spreads). The fence lies ``spreads`` distances of the quantile from
#: the median above the quantile. A low quantile holds where many documents are junk in that measure
#: (symbols), a high one where sound documents have a long tail (repeated lines and words).
TAILS = {"symbol_rate": (750, 4), "upper_rate": (990, 2), "dup_line_rate": (990, 2), "repeat_rate": (990, 1), "word_length": (900, 6)}
#: Least distance of a fence from its quantile, in the feature's own unit: a thousandth or a hundredth.
LEAST = 10
#: Documents a group must have beyond a quantile for that quantile to be its own.
BEYOND = 50
SYMBOLS = "#*$%&|<>"


def _repeated_words(w: Column) -> Column:
    """Words covered by five-word windows that occur twice or more in ``w``."""
    hashes = F.transform(F.slice(w, 1, F.greatest(F.size(w) - 4, F.lit(0))), lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2], w[i + 3], w[i + 4]))

    def covered(s: Column) -> Column:
        twin = F.filter(
            s,
            lambda e, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["h"] == e["h"]))
            | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["h"] == e["h"])),
        )
        places = F.sort_array(F.transform(twin, lambda e: e["i"]))
        start = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(5), i - acc["last"])).alias("n"))
        return F.aggregate(places, start, step, lambda acc: acc["n"])

    def count(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(ordered, covered))

    return let(hashes, count)


def measures(text: Column) -> Column:
    """struct of the whole-text counts; a null text has none of anything."""
    body = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(BLANK_CHARS)) != "")
    by_words = let(words(body), lambda w: F.struct(F.size(w).alias("n_words"), _repeated_words(w).alias("n_repeat_words")))
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    upper = F.length(body) - F.length(F.translate(body, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    solid = F.length(F.translate(body, BLANK_CHARS, ""))
    symbols = F.length(body) - F.length(F.translate(body, SYMBOLS, ""))
    return F.struct(by_words.alias("w"), by_lines.alias("l"), solid.alias("word_chars"), symbols.alias("n_symbols"), upper.alias("n_upper"))


def _cell(value: Column) -> Column:
    """The value with all but its top six bits cleared: its cell's lower end."""
    low = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low), low)


def sketches(measured: DataFrame, features: list[str], by: list[str]) -> DataFrame:
    """(``by``, feature, cell, n): the log-linear histogram of each feature in each group."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("feature"), _cell(F.col(f)).alias("cell")) for f in features))).alias("e")
    return measured.select(*by, each).groupBy(*by, "e.feature", "e.cell").agg(F.count(F.lit(1)).alias("n"))


def merge(cells: DataFrame, by: list[str]) -> DataFrame:
    """The sketches merged up to the coarser groups ``by``."""
    return cells.groupBy(*by, "feature", "cell").agg(F.sum("n").alias("n"))


def quantiles(cells: DataFrame, by: list[str], levels: dict[str, Column]) -> DataFrame:
    """(``by``, feature, size, a column per level): lower ends of the cells that hold the quantiles, in thousandths."""
    group = Window.partitionBy(*by, "feature")
    run = cells.withColumn("size", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)))
    at = lambda k: F.min(F.when(1000 * F.col("upto") >= k * F.col("size"), F.col("cell")))
    return run.groupBy(*by, "feature", "size").agg(*(at(k).alias(name) for name, k in levels.items()))


def _by_feature(tails: dict[str, tuple[int, int]], k: int) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for f, t in tails.items() for x in (f, t[k]))), F.col("feature"))


def fences(measured: DataFrame, tails: dict[str, tuple[int, int]], by: tuple[str, str], least: int, beyond: int) -> DataFrame:
    """One row per (language, source): a fence ``hi_<feature>`` for each feature.

    It lies above the feature's quantile by its spreads, at least by ``least``, so that a measure that is
    zero nearly everywhere doesn't condemn its first non-zero value.
    """
    lang, source = by
    level = _by_feature(tails, 0)
    ask = {"mid": F.lit(500), "tail": level}
    cells = settle(sketches(measured, list(tails), [lang, source]), "quality-cells")
    named = lambda df, n: df.withColumnsRenamed({c: f"_{c}{n}" for c in df.columns})
    fine, wide, top = quantiles(cells, [lang, source], ask), named(quantiles(merge(cells, [lang]), [lang], ask), 2), named(quantiles(merge(cells, []), [], ask), 3)
    joined = fine.join(wide, fine[lang].eqNullSafe(wide[f"_{lang}2"]) & (fine["feature"] == wide["_feature2"])).join(top, F.col("feature") == F.col("_feature3"))
    enough = lambda size: F.col(size) * (1000 - level) >= 1000 * beyond
    pick = lambda c: F.when(enough("size"), F.col(c)).when(enough("_size2"), F.col(f"_{c}2")).otherwise(F.col(f"_{c}3"))
    tail, mid = pick("tail"), pick("mid")
    # tail + tail / 32 bounds the values of the quantile's cell
    fence = tail + F.floor(tail / 32) + F.greatest(_by_feature(tails, 1) * (tail - mid), F.lit(least))
    return joined.groupBy(lang, source).agg(*(F.max(F.when(F.col("feature") == f, fence)).alias(f"hi_{f}") for f in tails))


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), **how) -> DataFrame:
    """One row per row of ``docs``: ``keep``, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words
    (long), base_failed, kept, and the features compared.

    Rates are in thousandths, word_length in hundredths of a character. Null languages and null
    sources are groups like any other. A text without words fails the base. An empty table gives an
    empty result; repeated rows are judged and returned each.
    """
    got = _judged(docs, keep, **how)
    return got.select("_keep.*", *(c for c in got.columns if c != "_keep"))


def good(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that are kept, with its own columns whatever their names."""
    return _judged(docs, tuple(docs.columns), **how).where("kept").select("_keep.*")


def _judged(
    docs: DataFrame, keep: tuple[str, ...], text: str = "text", lang: str = "lang", source: str = "source",
    tails: dict[str, tuple[int, int]] | None = None, least: int = LEAST, beyond: int = BEYOND,
) -> DataFrame:
    tails = TAILS if tails is None else tails
    m = docs.select(F.struct(*(F.col(c) for c in keep)).alias("_keep"), F.col(lang).alias("_l"), F.col(source).alias("_s"), measures(F.col(text)).alias("_m"))
    as_long = lambda name, c: F.col(c).cast("long").alias(name)
    m = m.select(
        "_keep", "_l", "_s", as_long("n_words", "_m.w.n_words"), as_long("word_chars", "_m.word_chars"), as_long("n_symbols", "_m.n_symbols"),
        as_long("n_dup_lines", "_m.l.n_dup_lines"), as_long("n_repeat_words", "_m.w.n_repeat_words"), as_long("_lines", "_m.l.n_lines"), as_long("_upper", "_m.n_upper"),
    )
    per = lambda a, k, b: F.floor(F.col(a) * k / F.greatest(F.col(b), F.lit(1))).cast("long")
    m = m.select(
        "*", per("n_symbols", 1000, "word_chars").alias("symbol_rate"), per("_upper", 1000, "word_chars").alias("upper_rate"),
        per("n_dup_lines", 1000, "_lines").alias("dup_line_rate"), per("n_repeat_words", 1000, "n_words").alias("repeat_rate"), per("word_chars", 100, "n_words").alias("word_length"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
    ).drop("_lines", "_upper")
    m = settle(m, "quality-measures")
    limits = settle(fences(m.where("not base_failed"), tails, ("_l", "_s"), least, beyond).withColumnsRenamed({"_l": "_gl", "_s": "_gs"}), "quality-fences")
    both = m.join(limits, m["_l"].eqNullSafe(limits["_gl"]) & m["_s"].eqNullSafe(limits["_gs"]), "left")
    inside = F.lit(True)
    for f in tails:
        inside = inside & F.coalesce(F.col(f) <= F.col(f"hi_{f}"), F.lit(True))
    return both.select(
        "_keep", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"), *tails,
    )


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    fs = list(TAILS)
    cells = " UNION ALL ".join(f"SELECT lang, source, '{f}' AS feature, ({f} >> greatest(length(bin({f})) - 6, 0)) << greatest(length(bin({f})) - 6, 0) AS cell FROM m WHERE NOT base_failed" for f in fs)
    level, spreads = (" ".join(["CASE feature", *(f"WHEN '{f}' THEN {t[k]}" for f, t in TAILS.items()), "END"]) for k in (0, 1))

    def quant(by: str) -> str:
        keys = f"{by}, feature" if by else "feature"
        return f"""SELECT {keys}, any_value(size) AS size, min(cell) FILTER (1000 * upto >= 500 * size) AS mid, min(cell) FILTER (1000 * upto >= ({level}) * size) AS tail
  FROM (SELECT {keys}, cell, sum(n) OVER (PARTITION BY {keys}) AS size, sum(n) OVER (PARTITION BY {keys} ORDER BY cell) AS upto
    FROM (SELECT {keys}, cell, count(*) AS n FROM cells GROUP BY ALL)) GROUP BY {keys}"""

    pick = lambda c: f"CASE WHEN fine.size * (1000 - level) >= {1000 * BEYOND} THEN fine.{c} WHEN wide.size * (1000 - level) >= {1000 * BEYOND} THEN wide.{c} ELSE top.{c} END"
    ok = " AND ".join(f"coalesce({f} <= hi_{f}, true)" for f in fs)
    limits = ", ".join(f"max(fence) FILTER (feature = '{f}') AS hi_{f}" for f in fs)
    return f"""WITH t AS (SELECT row_number() OVER () AS row, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
s AS MATERIALIZED (SELECT row, doc_id, lang, source, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
win AS (SELECT row, i, w[i:i + 4] AS g FROM (SELECT row, w, unnest(range(1, len(w) - 3)) AS i FROM s WHERE len(w) >= 5)),
rep AS (SELECT row, i FROM win JOIN (SELECT row, g FROM win GROUP BY row, g HAVING count(*) > 1) USING (row, g)),
cov AS (SELECT row, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY row),
b AS (SELECT s.row, doc_id, lang, source, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]+', '', 'g'))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words,
  len(l) AS lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper FROM s LEFT JOIN cov USING (row)),
m AS MATERIALIZED (SELECT *, n_symbols * 1000 // greatest(word_chars, 1) AS symbol_rate, (upper * 1000 // greatest(word_chars, 1))::BIGINT AS upper_rate,
  (n_dup_lines * 1000 // greatest(lines, 1))::BIGINT AS dup_line_rate, n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_rate,
  word_chars * 100 // greatest(n_words, 1) AS word_length, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
cells AS ({cells}),
fine AS (SELECT *, {level} AS level FROM ({quant("lang, source")})), wide AS ({quant("lang")}), top AS ({quant("")}),
f AS (SELECT fine.lang, fine.source, feature, {pick("mid")} AS mid, {pick("tail")} AS tail
  FROM fine JOIN top USING (feature) LEFT JOIN wide ON wide.lang IS NOT DISTINCT FROM fine.lang AND wide.feature = fine.feature),
fence AS (SELECT lang, source, {limits} FROM (SELECT *, tail + tail // 32 + greatest(({spreads}) * (tail - mid), {LEAST}) AS fence FROM f) GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {ok} AS kept, {", ".join(fs)}
FROM m LEFT JOIN fence x ON x.lang IS NOT DISTINCT FROM m.lang AND x.source IS NOT DISTINCT FROM m.source"""


ORACLE = _oracle()
