"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.session import ship

#: White space that separates words, for Java and RE2 regular expressions alike.
BLANKS = r"[\x20\x09-\x0D]+"
#: The same characters, for functions that take a set.
BLANK_CHARS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable, not a copied expression."""
    return F.transform(F.array(value), body)[0]


def blocks(items: Column, least: int = 16) -> Column:
    """``items`` as an array of arrays of about the square root of their number each, ``least`` at least.

    Folds that build arrays or texts copy what they have built at each step; taken by blocks, n steps cost n to the power 1.5
    and not n squared.
    """

    def cut(pair: Column) -> Column:
        n = F.size(pair["items"])
        size = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(least))
        return let(size, lambda k: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / k).cast("int")), lambda j: F.slice(pair["items"], j * k + 1, k)))

    return F.when(F.size(items) > 0, let(F.struct(items.alias("items")), cut)).otherwise(F.transform(F.array(F.lit(0)), lambda _: F.slice(items, 1, 0)))


def replaced(text: Column, spans: Column, instead) -> Column:
    """``text`` with each of ``spans``(start, end, ..., sorted by start) replaced by ``instead(span, its text)``.

    A span that begins inside an earlier one is cut with it and leaves nothing of its own. Linear in the text times the
    square root of the spans.
    """

    def build(x: Column) -> Column:
        parts, body = x["parts"], x["body"]
        ends = F.transform(parts, lambda b: F.coalesce(F.array_max(F.transform(b, lambda s: s["end"])), F.lit(0)))

        def with_ends(most: Column) -> Column:
            # where a block begins: the furthest end of the blocks before it
            begin = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda j: F.coalesce(F.array_max(F.slice(most, 1, j)), F.lit(0)))

            def with_begin(at: Column) -> Column:
                def piece(b: Column, j: Column) -> Column:
                    first = F.element_at(at, j + 1)
                    own = F.substring(body, first + 1, F.element_at(at, j + 2) - first)

                    def fold(local: Column) -> Column:
                        def step(acc: Column, s: Column) -> Column:
                            word = F.substring(local, s["start"] - first + 1, s["end"] - s["start"])
                            before = F.substring(local, acc["at"] - first + 1, s["start"] - acc["at"])
                            out = F.when(s["start"] >= acc["at"], F.concat(acc["out"], before, instead(s, word))).otherwise(acc["out"])
                            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

                        return F.aggregate(b, F.struct(first.alias("at"), F.lit("").alias("out")), step, lambda acc: acc["out"])

                    return let(own, fold)

                rest = F.substring(body, F.element_at(at, -1) + 1, F.lit(2**31 - 1))
                return F.concat(F.array_join(F.transform(parts, piece), ""), rest)

            return let(begin, with_begin)

        return let(ends, with_ends)

    return let(F.struct(blocks(spans).alias("parts"), text.alias("body")), build)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of ``text`` in order (null or blank text: none)."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def n_words(text: Column) -> Column:
    """Number of those words, as a long."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, BLANKS))).cast("long")


def spread(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for ``rows`` rows at ``per_part`` each, never under the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_part))
