"""Data quality controls, schema validation, and content fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.session import settle

from sablefin.config import DOMAINS

# Control ids, dimensions, severities.
CONTROLS = (
    ("DQ01_CUSTOMER_PK_UNIQUE", "uniqueness", "BLOCKER"), ("DQ02_TXN_PK_UNIQUE", "uniqueness", "BLOCKER"), ("DQ03_TXN_CUSTOMER_FK", "referential_integrity", "BLOCKER"),
    ("DQ04_MANDATORY_NULLS", "completeness", "BLOCKER"), ("DQ05_AMOUNT_RANGE", "validity", "BLOCKER"), ("DQ06_TXN_DATE_WINDOW", "validity", "CRITICAL"),
    ("DQ07_CHANNEL_DOMAIN", "validity", "CRITICAL"), ("DQ08_COUNTRY_CODE_FORMAT", "conformity", "CRITICAL"), ("DQ09_WATCHLIST_NAME_PRESENT", "completeness", "BLOCKER"),
    ("DQ10_ACCOUNT_OPEN_BEFORE_TXN", "consistency", "WARNING"),
)


class QualityError(ValueError):
    """A blocking control failed or couldn't run."""


def duplicates(df: DataFrame, key: list[str]) -> DataFrame:
    """One row: failing, the number of key values that occur more than once."""
    return df.groupBy(*key).count().where("count > 1").agg(F.count(F.lit(1)).alias("failing"))


def orphans(df: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return df.join(parent.select(key).distinct(), key, "left_anti").agg(F.count(F.lit(1)).alias("failing"))


def failing(df: DataFrame, **tests: Column) -> DataFrame:
    """One row with a count for each test: all column-level controls of a table in one pass."""
    return df.agg(*(F.coalesce(F.sum(F.coalesce(t, F.lit(False)).cast("long")), F.lit(0)).alias(n) for n, t in tests.items()))


def column_tests(start: str, end: str) -> dict[str, Column]:
    null = F.col("txn_ts").isNull() | F.col("amount").isNull() | F.col("channel").isNull() | F.col("direction").isNull()
    return {
        "DQ04_MANDATORY_NULLS": null,
        "DQ05_AMOUNT_RANGE": (F.col("amount") <= 0) | (F.col("amount") > 50_000_000),
        "DQ06_TXN_DATE_WINDOW": (F.col("txn_ts") < F.lit(start).cast("timestamp")) | (F.col("txn_ts") >= F.lit(end).cast("timestamp")),
        "DQ07_CHANNEL_DOMAIN": ~F.col("channel").isin(*DOMAINS["channel"]) | ~F.col("direction").isin(*DOMAINS["direction"]),
        "DQ08_COUNTRY_CODE_FORMAT": F.col("country").isNotNull() & ~F.col("country").rlike("^[A-Z]{2}$"),
    }


def run_controls(customers: DataFrame, tx: DataFrame, watchlist: DataFrame, start: str, end: str) -> DataFrame:
    """(check_id, dimension, severity, failing_rows, status): five passes for ten controls.

    ``tx`` has txn_id, customer_id, txn_ts, amount, channel, direction, country; ``customers`` customer_id and
    account_open_date; ``watchlist`` primary_name.
    """
    early = tx.join(customers.select("customer_id", "account_open_date"), "customer_id")
    parts: dict[str, DataFrame] = {
        "DQ01_CUSTOMER_PK_UNIQUE": duplicates(customers, ["customer_id"]), "DQ02_TXN_PK_UNIQUE": duplicates(tx, ["txn_id"]), "DQ03_TXN_CUSTOMER_FK": orphans(tx, customers, "customer_id"),
        "DQ09_WATCHLIST_NAME_PRESENT": failing(watchlist, failing=F.col("primary_name").isNull() | (F.length(F.trim("primary_name")) == 0)),
        "DQ10_ACCOUNT_OPEN_BEFORE_TXN": failing(early, failing=F.col("txn_ts") < F.col("account_open_date")),
    }
    rows = [d.select(F.lit(n).alias("check_id"), F.col("failing").alias("failing_rows")) for n, d in parts.items()]
    tests = column_tests(start, end)
    wide = failing(tx, **tests)
    rows.append(wide.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check_id"), F.col(n).alias("failing_rows")) for n in tests)))))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    meta = customers.sparkSession.createDataFrame(list(CONTROLS), "check_id string, dimension string, severity string")
    return out.join(F.broadcast(meta), "check_id").select("check_id", "dimension", "severity", "failing_rows", F.when(F.col("failing_rows") == 0, "PASS").otherwise("FAIL").alias("status"))  # ten rows


def checked(name: str, severity: str, query: Callable[[], DataFrame]) -> tuple[str, str, int, str]:
    """Run one control on the driver: (name, severity, failing rows, status); an engine error is ERROR, -1."""
    try:
        n = query().first()[0]
    except Exception:
        return name, severity, -1, "ERROR"
    return name, severity, int(n or 0), "PASS" if not n else "FAIL"


def enforce(report: list[tuple[str, str, int, str]]) -> None:
    """Raise if a BLOCKER isn't PASS."""
    bad = [f"{n}={k} ({s})" for n, sev, k, s in report if sev == "BLOCKER" and s != "PASS"]
    if bad:
        raise QualityError("blocking controls: " + ", ".join(bad))


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str
    nullable: bool = True
    allowed: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None


def coerce(df: DataFrame, specs: list[ColumnSpec]) -> DataFrame:
    """``df`` in the declared column order and types; missing or extra columns are an error."""
    have, want = set(df.columns), {s.name for s in specs}
    if have != want:
        raise ValueError(f"missing columns {sorted(want - have)}, extra columns {sorted(have - want)}")
    return df.select(*(F.col(s.name).cast(s.type).alias(s.name) for s in specs))


def violations(df: DataFrame, specs: list[ColumnSpec], key: list[str]) -> DataFrame:
    """(column, check, failing): nulls, domain, minimum and maximum of all columns in one pass, and key
    duplicates; only what fails."""
    tests: dict[str, Column] = {}
    for s in specs:
        c = F.col(s.name)
        if not s.nullable:
            tests[f"{s.name}|null"] = c.isNull()
        if s.allowed:
            tests[f"{s.name}|domain"] = c.isNotNull() & ~c.isin(*s.allowed)
        if s.minimum is not None:
            tests[f"{s.name}|minimum"] = c < s.minimum
        if s.maximum is not None:
            tests[f"{s.name}|maximum"] = c > s.maximum
    wide = failing(df, **tests)
    pairs = [F.struct(F.lit(n.split("|")[0]).alias("column"), F.lit(n.split("|")[1]).alias("check"), F.col(n).alias("failing")) for n in tests]
    out = wide.select(F.inline(F.array(*pairs)))
    out = out.unionByName(duplicates(df, key).select(F.lit(",".join(key)).alias("column"), F.lit("key").alias("check"), "failing"))
    return out.where("failing > 0")


def type_mismatches(df: DataFrame, specs: list[ColumnSpec]) -> list[str]:
    have = {f.name: f.dataType for f in df.schema}
    return [f"{s.name}: {have[s.name].simpleString()} is not {s.type}" for s in specs if s.name in have and have[s.name] != T._parse_datatype_string(s.type)]


def validate(df: DataFrame, specs: list[ColumnSpec], key: list[str], show: int = 8) -> None:
    """Raise one error that names up to ``show`` violations."""
    coerce(df, specs)
    bad = type_mismatches(df, specs) + [f"{r['column']}: {r['failing']} fail {r['check']}" for r in violations(df, specs, key).collect()]
    if bad:
        raise ValueError("; ".join(bad[:show]) + (f" and {len(bad) - show} more" if len(bad) > show else ""))


def write_validated(df: DataFrame, specs: list[ColumnSpec], key: list[str], path: str) -> DataFrame:
    """Write ``df`` to ``path`` as snappy Parquet in the declared order and types, if it is valid; return what was written.

    It is settled first, so that what is checked is what is written. Invalid rows raise as in ``validate`` and write nothing.
    """
    rows = settle(coerce(df, specs), "validated")
    validate(rows, specs, key)
    rows.write.parquet(path, compression="snappy")
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, content): the same for the same rows in any order, computed without a sort."""
    h = F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in sorted(df.columns)))
    low = F.sum(F.pmod(h, F.lit(1 << 31)))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", F.hex(F.bit_xor(h)), F.hex(low)).alias("content"))
