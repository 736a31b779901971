"""Seeded synthetic feeds as distributed plans: every column is a hash of its row's number and the seed, so any
partitioning gives the same rows. Distributions follow the documented ones, not any byte sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Romanised given and family names by culture, with a native spelling of each where there is one.
GIVEN = {
    "ARABIC": (("Muhammad", "محمد"), ("Ahmad", "أحمد"), ("Khalid", "خالد"), ("Yusuf", "يوسف"), ("Omar", "عمر"), ("Tariq", "طارق")),
    "CYRILLIC": (("Sergei", "Сергей"), ("Ivan", "Иван"), ("Dmitri", "Дмитрий"), ("Olga", "Ольга"), ("Viktor", "Виктор"), ("Anna", "Анна")),
    "HAN": (("Wei", "伟"), ("Fang", "芳"), ("Jing", "静"), ("Lei", "磊"), ("Yong", "勇"), ("Ming", "明")),
    "LATIN": (("James", "James"), ("Maria", "María"), ("Robert", "Robert"), ("Elena", "Elena"), ("Carlos", "Carlos"), ("Ingrid", "Ingrid")),
}
FAMILY = {
    "ARABIC": (("Hassan", "الحسن"), ("Rashid", "رشيد"), ("Qasim", "قاسم"), ("Saleh", "صالح"), ("Mansour", "منصور"), ("Najjar", "النجار")),
    "CYRILLIC": (("Ivanov", "Иванов"), ("Petrov", "Петров"), ("Smirnov", "Смирнов"), ("Volkov", "Волков"), ("Orlov", "Орлов"), ("Sokolov", "Соколов")),
    "HAN": (("Zhang", "张"), ("Wang", "王"), ("Li", "李"), ("Chen", "陈"), ("Liu", "刘"), ("Zhao", "赵")),
    "LATIN": (("Anderson", "Anderson"), ("Garcia", "García"), ("Miller", "Miller"), ("Novak", "Novák"), ("Rossi", "Rossi"), ("Larsen", "Larsen")),
}
SCRIPTS = tuple(GIVEN)
COUNTRIES = {"ARABIC": ("SY", "IQ", "YE"), "CYRILLIC": ("RU", "BY", "UA"), "HAN": ("CN", "HK", "TW"), "LATIN": ("US", "DE", "ES")}
SEGMENTS = ("DORMANT_RETAIL", "SALARIED", "SMALL_BUSINESS", "CASH_INTENSIVE", "TRADE_CORRIDOR")


def unit(name: str, seed: int, *cols: str) -> Column:
    """Uniform in [0, 1): a hash of the row's key, the draw's name and the seed."""
    return F.pmod(F.xxhash64(*(cols or ("id",)), F.lit(name), F.lit(seed)), F.lit(1 << 40)) / float(1 << 40)


def pick(options: Column, u: Column) -> Column:
    return F.element_at(options, (F.floor(u * F.size(options)) + 1).cast("int"))


def _lookup(table: dict, which: int) -> Column:
    pairs = [x for s, names in table.items() for x in (F.lit(s), F.array(*(F.lit(n[which]) for n in names)))]
    return F.create_map(*pairs)


def _people(base: DataFrame, seed: int) -> DataFrame:
    """script, given and family indexes and both spellings for each id."""
    s = pick(F.array(*map(F.lit, SCRIPTS)), unit("script", seed))
    d = base.withColumn("script", s).withColumn("_g", (F.floor(unit("given", seed) * 6) + 1).cast("int")).withColumn("_f", (F.floor(unit("family", seed) * 6) + 1).cast("int"))
    for n, which in (("latin", 0), ("native", 1)):
        g, f = (F.element_at(F.element_at(_lookup(x, which), F.col("script")), i) for x, i in ((GIVEN, F.col("_g")), (FAMILY, F.col("_f"))))
        name = F.when(F.col("script") == "HAN", F.concat(f, g) if which else F.concat_ws(" ", f, g)).otherwise(F.concat_ws(" ", g, f))
        d = d.withColumn(n, name)
    return d


def watchlist(spark: SparkSession, n: int, seed: int = 1) -> DataFrame:
    """uid, name, script, entity_type, program, aliases, dob, nationality, national_id: a third of birth dates are
    missing, a third of the rest are years."""
    d = _people(spark.range(n), seed)
    full = F.concat_ws("-", (1940 + F.floor(unit("year", seed) * 60)).cast("string"), F.lpad((1 + F.floor(unit("month", seed) * 12)).cast("string"), 2, "0"), F.lpad((1 + F.floor(unit("day", seed) * 28)).cast("string"), 2, "0"))
    dob = F.when(unit("dob", seed) >= 0.34, F.when(unit("only", seed) < 0.30, F.substring(full, 1, 4)).otherwise(full))
    nat = pick(F.element_at(F.create_map(*(x for s, c in COUNTRIES.items() for x in (F.lit(s), F.array(*map(F.lit, c))))), F.col("script")), unit("nat", seed))
    alias = F.when(unit("alias", seed) < 0.6, F.when(unit("form", seed) < 0.5, F.col("native")).otherwise(F.concat(F.col("latin"), F.lit("|"), F.col("native")))).otherwise("")
    return d.select(
        F.format_string("SDN-%06d", "id").alias("uid"), F.when(unit("shown", seed) < 0.3, F.col("native")).otherwise(F.col("latin")).alias("name"), "script", F.lit("INDIVIDUAL").alias("entity_type"),
        pick(F.array(*map(F.lit, ("SDGT", "UKRAINE-EO13661", "IRAN", "SYRIA"))), unit("program", seed)).alias("program"), alias.alias("aliases"), dob.alias("dob"), nat.alias("nationality"),
        F.when(unit("hasid", seed) < 0.4, F.format_string("ID%08d", F.floor(unit("nid", seed) * 1e8).cast("long"))).alias("national_id"), F.col("latin").alias("_latin"),
    )


def customers(spark: SparkSession, n: int, listed: DataFrame, hits: int, seed: int = 1) -> DataFrame:
    """subject_id, name, dob, nationality, national_id, behaviour_segment, account_open_date, kyc, is_pep, planted_uid.

    The first ``hits`` customers are planted: they carry a listed entity's name, in the other spelling.
    """
    d = _people(spark.range(n), seed + 1)
    entity = listed.select(F.col("uid").alias("planted_uid"), F.col("_latin").alias("_pl"), F.col("dob").alias("_pd"), F.col("nationality").alias("_pn"), F.substring("uid", 5, 6).cast("long").alias("_pid"))
    d = d.join(entity.where(F.col("_pid") < hits), F.col("id") == F.col("_pid"), "left")
    planted = F.col("planted_uid").isNotNull()
    return d.select(
        F.format_string("C%07d", "id").alias("subject_id"), F.col("id").alias("customer_id"), F.when(planted, F.col("_pl")).otherwise(F.col("latin")).alias("name"), F.when(planted, F.col("_pd")).otherwise((1950 + F.floor(unit("year", seed + 1) * 55)).cast("string")).alias("dob"),
        F.when(planted, F.col("_pn")).otherwise(pick(F.array(*map(F.lit, ("US", "GB", "FR", "SG"))), unit("nat", seed + 1))).alias("nationality"), F.lit(None).cast("string").alias("national_id"),
        pick(F.array(*map(F.lit, SEGMENTS)), unit("segment", seed + 1)).alias("behaviour_segment"), F.date_add(F.lit("2022-01-01").cast("date"), F.floor(unit("open", seed + 1) * 700).cast("int")).cast("timestamp").alias("account_open_date"),
        pick(F.array(*map(F.lit, ("LOW", "LOW", "MEDIUM", "HIGH"))), unit("kyc", seed + 1)).alias("kyc"), (unit("pep", seed + 1) < 0.01).alias("is_pep"), "planted_uid",
    )


def transactions(spark: SparkSession, n_customers: int, n: int, anomalies: float = 0.01, months: int = 12, seed: int = 1) -> DataFrame:
    """``n`` transactions of the canonical schema over ``months`` months of 2024, plus typology: null or the pattern a
    customer-month was made to show (STRUCTURING: cash credits below the limit; CORRIDOR: high-risk countries)."""
    d = spark.range(n).select("id", F.floor(F.pow(unit("c", seed), 1.6) * n_customers).cast("long").alias("customer_id"), F.floor(unit("m", seed) * months).cast("int").alias("_m"))
    odd = unit("odd", seed, "customer_id", "_m")
    kind = F.when(odd < anomalies / 2, "STRUCTURING").when(odd < anomalies, "CORRIDOR")
    d = d.withColumn("typology", kind)
    start = F.add_months(F.lit("2024-01-01").cast("date"), F.col("_m")).cast("timestamp")
    ts = start + F.make_dt_interval(F.floor(unit("d", seed) * 28).cast("int"), F.floor(unit("h", seed) * 24).cast("int"), F.floor(unit("mi", seed) * 60).cast("int"))
    amount = F.round(F.exp(5.5 + 1.3 * (unit("a1", seed) + unit("a2", seed) + unit("a3", seed) - 1.5) * 2), 2)
    s = F.col("typology") == "STRUCTURING"
    return d.select(
        F.col("id").alias("txn_id"), "customer_id", ts.alias("txn_ts"), F.when(s, F.round(8300 + 1600 * unit("b", seed), 2)).otherwise(amount).alias("amount"),
        F.when(s, "CASH").otherwise(pick(F.array(*map(F.lit, ("WIRE", "ACH", "CARD", "CARD", "CASH"))), unit("ch", seed))).alias("channel"), F.when(s, "CREDIT").otherwise(F.when(unit("dir", seed) < 0.45, "CREDIT").otherwise("DEBIT")).alias("direction"),
        F.when(unit("cp", seed) < 0.9, F.format_string("CP-%05d", F.floor(unit("cpn", seed) * 4000).cast("long"))).alias("counterparty"),
        F.when(F.col("typology") == "CORRIDOR", F.floor(unit("hi", seed) * 5)).otherwise(F.floor(unit("co", seed) * 25)).cast("int").alias("country_key"), (unit("xb", seed) < 0.3).alias("is_cross_border"), "typology",
    )


def labels(tx: DataFrame) -> DataFrame:
    """(customer_id, period, is_true, typology): one row per active cell."""
    return tx.groupBy("customer_id", F.date_format("txn_ts", "yyyy-MM").alias("period")).agg(F.max("typology").alias("typology")).withColumn("is_true", F.col("typology").isNotNull())
