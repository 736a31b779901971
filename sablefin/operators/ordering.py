"""Total orders without a task that sees them all: dense numbers, and the k-th row of a ranking.

Numbers come in two passes: rows are dealt to ranges of the order, sorted inside and marked with their place; the
ranges' sizes, a number each, are then added up. The k-th row comes from successive histograms of the
order's columns, each narrowing the rows to one cell, until few enough are left to look at.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.operators.quantile import _cell
from sablefin.session import settle

#: Bits of a place that tell rows of one range apart.
_PLACE = 33
#: Cells of a histogram, a power of two, and rows that are looked at one by one.
_BITS = 12
FEW = 5_000
#: Bytes of a string that are compared as one number.
_CHUNK = 6


def numbered(df: DataFrame, order: list[str | Column], name: str = "n", start: int = 0) -> DataFrame:
    """``df`` with ``name``: start, start + 1, ... over ``order``, which is to be total for the numbers to be defined.

    Nulls are ordered as Spark orders them. Rows are settled once, in order within their range. The driver sees one number a range.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the place is taken above the sort and settled with the row, so both passes mean the same ranges
    placed = settle(dealt.select("*", F.monotonically_increasing_id().alias("_at")), "numbered")
    part = F.shiftright("_at", _PLACE)
    sizes = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    if not sizes:
        return placed.select(*df.columns, F.lit(None).cast("long").alias(name))
    firsts, at = [], start
    for _, n in sizes:
        firsts.append(at)
        at += n
    # a row a range; as Arrow, since rows of Python objects would start Python workers on every executor
    first = F.broadcast(spark.createDataFrame(pa.table({"_p": pa.array([p for p, _ in sizes], pa.int64()), "_first": pa.array(firsts, pa.int64())})))
    number = F.col("_first") + F.col("_at").bitwiseAND(F.lit((1 << _PLACE) - 1))
    return placed.join(first, part == F.col("_p")).select(*df.columns, number.alias(name))


def _keys(df: DataFrame, column: str) -> list[Column]:
    """Numbers that order as ``column`` does, nulls first, the second of them only among rows equal in the first, and so on."""
    kind, c = df.schema[column].dataType, F.col(column)
    known = c.isNotNull().cast("long")
    if isinstance(kind, T.StringType):
        size = df.agg(F.max(F.octet_length(c))).first()[0] or 0
        raw = F.hex(F.encode(c, "utf-8"))
        # a chunk's bytes, short ones filled up with zeros; strings equal but for zero bytes at the end differ in length
        chunk = lambda k: F.conv(F.rpad(F.substring(raw, 2 * k + 1, 2 * _CHUNK), 2 * _CHUNK, "0"), 16, 10).cast("long")
        return [known, *(chunk(k) for k in range(0, size, _CHUNK)), F.octet_length(c).cast("long")]
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # cells are slices of an octave; inside one, values are told apart evenly
        return [known, _cell(c.cast("double")), c.cast("double")]
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return [known, c.cast("long")]
    if isinstance(kind, T.BooleanType):
        return [known, c.cast("int").cast("long")]
    if isinstance(kind, T.DateType):
        return [known, F.datediff(c, F.lit("1970-01-01").cast("date")).cast("long")]
    if isinstance(kind, T.TimestampType):
        return [known, F.unix_micros(c)]
    raise TypeError(f"{column}: no order of {kind.simpleString()} by numbers")


def _narrow(rows: DataFrame, x: Column, down: bool, k: int, few: int) -> tuple[DataFrame, int, bool]:
    """(rows, k, whether they are few): those of ``rows`` that are equal in ``x`` to the k-th by ``x``, or fewer than ``few`` around it."""
    whole = not isinstance(rows.select(x.alias("x")).schema["x"].dataType, T.DoubleType)
    while True:
        lo, hi = rows.agg(F.min(x), F.max(x)).first()
        if lo is None or lo == hi or lo != lo:
            return rows, k, False
        if whole:
            shift = max(0, int(hi - lo).bit_length() - _BITS)
            cell = F.shiftright(x, shift)
        else:
            top = (1 << _BITS) - 1
            cell = F.least(F.floor((x - F.lit(lo)) / F.lit(hi - lo) * (top + 1)), F.lit(top)).cast("long")
        held = sorted(((r["c"], r["n"]) for r in rows.groupBy(cell.alias("c")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=down)
        for c, n in held:
            if k <= n:
                break
            k -= n
        rows = rows.where(cell == c)
        if n <= few:
            return rows, k, True


def kth(df: DataFrame, order: list[tuple[str, bool]], k: int, few: int = FEW) -> Row | None:
    """The order columns of the ``k``-th row (from 1) by ``order``(column, descending); null: there are fewer rows.

    Nulls come first in rising columns and last in falling ones. Every histogram has some thousand cells and is one
    aggregate over ``df``, which had better be settled; at most ``few`` rows are sorted, and by Spark. Rows that are equal
    throughout are one place: any of them stands for all.
    """
    cols = list(dict.fromkeys(c for c, _ in order))
    rows = df.select(*cols)
    if k < 1 or rows.count() < k:
        return None
    done = False
    for c, down in order:
        for x in _keys(rows, c):
            rows, k, done = _narrow(rows, x, down, k, few)
            if done:
                break
        if done:
            break
    if not done:  # all equal
        return rows.first()
    sort = [F.desc_nulls_last(c) if down else F.asc_nulls_first(c) for c, down in order]
    return rows.orderBy(*sort).collect()[k - 1]  # ``few`` rows at most


def upto(order: list[tuple[str, bool]], last: Row) -> Column:
    """Whether a row stands at or before ``last`` in ``order``."""
    before, same = F.lit(False), F.lit(True)
    for c, down in order:
        x, v = F.col(c), last[c]
        if v is None:
            ahead = x.isNotNull() if down else F.lit(False)
        else:
            ahead = F.coalesce(x > F.lit(v), F.lit(False)) if down else x.isNull() | (x < F.lit(v))
        before = before | (same & ahead)
        same = same & x.eqNullSafe(F.lit(v))
    return before | same
