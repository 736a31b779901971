"""Canonical views of the driver tables, readers, and writers.

``tx_events`` is a dense month of intraday transactions, ``tx_lines`` seven years of sparse ones. Each
view also has its SQL text, so that an oracle can state the same rows in another engine.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sablefin.session import pieces, ship

TX_SCHEMA = "txn_id bigint, customer_id bigint, txn_ts timestamp, amount double, channel string, direction string, counterparty string, country_key int, is_cross_border boolean"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; instants without a zone are read as UTC."""
    ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*(F.col(f.name).cast("timestamp").alias(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name) for f in df.schema))


def read_tables(spark: SparkSession, sf_dir: str, names: list[str]) -> dict[str, DataFrame]:
    """Several tables at once; a missing one is an error that names it."""
    out = {}
    for n in names:
        try:
            out[n] = read_table(spark, sf_dir, n)
        except Exception as e:
            raise FileNotFoundError(f"table {n} can't be read under {sf_dir}") from e
    return out


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and a declared schema: no inference pass."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def params_table(spark: SparkSession, params: dict[str, dict[str, float]]) -> DataFrame:
    """(rule_id, param_name, param_value), one row a parameter."""
    rows = [(r, n, float(v)) for r, p in params.items() for n, v in p.items()]
    return spark.createDataFrame(rows, "rule_id string, param_name string, param_value double")


def pivot_params(table: DataFrame, rule_id: str, names: list[str]) -> DataFrame:
    """One row with a column for each parameter of a rule; pruned by known names, so no extra pass."""
    return table.where(F.col("rule_id") == rule_id).groupBy().pivot("param_name", names).agg(F.max("param_value"))


def run_window(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.sql("SELECT CAST(:a AS TIMESTAMP) AS window_start, CAST(:b AS TIMESTAMP) AS window_end", args={"a": start, "b": end})


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    key = ((F.col("event_id") * 7 + F.col("user_id")) % 25).cast("int")
    return e.select(
        F.col("event_id").alias("txn_id"), F.col("user_id").alias("customer_id"), F.col("ts").alias("txn_ts"), F.round(F.col("value") * 100).alias("amount"),
        F.when(F.col("event_type") == "view", "WIRE").when(F.col("event_type") == "click", "ACH").when(F.col("event_type") == "purchase", "CARD").otherwise("CASH").alias("channel"),
        F.when(F.col("event_id") % 2 == 0, "CREDIT").otherwise("DEBIT").alias("direction"),
        F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("CP"), (F.col("event_id") % 7).cast("string"))).alias("counterparty"),
        key.alias("country_key"), (key != F.col("user_id") % 25).alias("is_cross_border"),
    )


TX_EVENTS_SQL = """SELECT event_id AS txn_id, user_id AS customer_id, ts AS txn_ts, round(value * 100) AS amount,
  CASE event_type WHEN 'view' THEN 'WIRE' WHEN 'click' THEN 'ACH' WHEN 'purchase' THEN 'CARD' ELSE 'CASH' END AS channel,
  CASE WHEN event_id % 2 = 0 THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
  CASE WHEN event_id % 11 <> 0 THEN 'CP' || (event_id % 7)::VARCHAR END AS counterparty,
  ((event_id * 7 + user_id) % 25)::INTEGER AS country_key, (event_id * 7 + user_id) % 25 <> user_id % 25 AS is_cross_border FROM events"""


#: Parts into which the lines of one supplier are dealt where suppliers aren't broadcast.
DEAL = 8


def tx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with their order, its customer and their supplier.

    Customers join orders, so lines don't meet by customer, of whom one may have many. Beyond the session's
    partitions, joins of lines get as many as their files ask for, and a supplier's lines are dealt to several.
    """
    l, o, s, c = (read_table(spark, sf_dir, n) for n in ("lineitem", "orders", "supplier", "customer"))
    l = l.select("l_orderkey", "l_suppkey", "l_linenumber", "l_linestatus", "l_extendedprice", "l_shipdate")
    channel = F.element_at(F.array(*map(F.lit, ("WIRE", "ACH", "CARD", "CASH"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    s, c = s.select("s_suppkey", "s_name", "s_nationkey"), c.select("c_custkey", "c_nationkey")
    orders = o.select("o_orderkey", "o_custkey").join(c, F.col("o_custkey") == F.col("c_custkey"))
    on = F.col("l_suppkey") == F.col("s_suppkey")
    if n := pieces(l):
        l = l.withColumn("_deal", F.pmod(F.xxhash64("l_orderkey"), F.lit(DEAL))).repartition(n, "l_suppkey", "_deal")
        s = s.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(DEAL - 1).cast("long"))))
        on = on & (F.col("_deal") == F.col("_s"))
    joined = l.join(s, on)
    joined = (joined.repartition(n, "l_orderkey") if n else joined).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("txn_id"), F.col("o_custkey").alias("customer_id"), F.col("l_shipdate").alias("txn_ts"), F.col("l_extendedprice").alias("amount"),
        channel.alias("channel"), F.when(F.col("l_linestatus") == "O", "CREDIT").otherwise("DEBIT").alias("direction"),
        F.col("s_name").alias("counterparty"), F.col("s_nationkey").alias("country_key"), (F.col("s_nationkey") != F.col("c_nationkey")).alias("is_cross_border"),
    )


TX_LINES_SQL = """SELECT l_orderkey * 8 + l_linenumber AS txn_id, o_custkey AS customer_id, l_shipdate AS txn_ts, l_extendedprice AS amount,
  ['WIRE', 'ACH', 'CARD', 'CASH'][(l_linenumber % 4 + 1)::INTEGER] AS channel, CASE WHEN l_linestatus = 'O' THEN 'CREDIT' ELSE 'DEBIT' END AS direction,
  s_name AS counterparty, s_nationkey AS country_key, s_nationkey <> c_nationkey AS is_cross_border
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey"""


def event_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account holders behind ``tx_events``: five segments, opened late in 2023."""
    ids = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("customer_id")).distinct()
    segments = F.array(*map(F.lit, ("CASH_INTENSIVE", "DORMANT_RETAIL", "SALARIED", "SMALL_BUSINESS", "TRADE_CORRIDOR")))
    return ids.select(
        "customer_id", F.element_at(segments, (F.col("customer_id") % 5 + 1).cast("int")).alias("behaviour_segment"),
        F.date_add(F.lit("2023-11-15").cast("date"), (F.col("customer_id") % 45).cast("int")).cast("timestamp").alias("account_open_date"),
        (F.col("customer_id") % 25).cast("int").alias("nation_key"), F.element_at(F.array(*map(F.lit, ("LOW", "MEDIUM", "HIGH"))), (F.col("customer_id") % 3 + 1).cast("int")).alias("kyc"),
        (F.col("customer_id") % 50 == 0).alias("is_pep"),
    )


EVENT_CUSTOMERS_SQL = """SELECT customer_id, ['CASH_INTENSIVE', 'DORMANT_RETAIL', 'SALARIED', 'SMALL_BUSINESS', 'TRADE_CORRIDOR'][(customer_id % 5 + 1)::INTEGER] AS behaviour_segment,
  (DATE '2023-11-15' + (customer_id % 45)::INTEGER)::TIMESTAMP AS account_open_date, (customer_id % 25)::INTEGER AS nation_key,
  ['LOW', 'MEDIUM', 'HIGH'][(customer_id % 3 + 1)::INTEGER] AS kyc, customer_id % 50 = 0 AS is_pep FROM (SELECT DISTINCT user_id AS customer_id FROM events)"""


def line_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("behaviour_segment"), F.lit("1994-06-01").cast("timestamp").alias("account_open_date"),
        F.col("c_nationkey").alias("nation_key"), F.when(F.col("c_acctbal") < 2000, "HIGH").when(F.col("c_acctbal") < 6000, "MEDIUM").otherwise("LOW").alias("kyc"),
        (F.col("c_custkey") % 50 == 0).alias("is_pep"),
    )


LINE_CUSTOMERS_SQL = """SELECT c_custkey AS customer_id, c_mktsegment AS behaviour_segment, TIMESTAMP '1994-06-01' AS account_open_date, c_nationkey AS nation_key,
  CASE WHEN c_acctbal < 2000 THEN 'HIGH' WHEN c_acctbal < 6000 THEN 'MEDIUM' ELSE 'LOW' END AS kyc, c_custkey % 50 = 0 AS is_pep FROM customer"""


def risk_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(country_key, tier): a row per country. Region 0 is HIGH, 1 MEDIUM, the others LOW."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").alias("country_key"), F.when(F.col("n_regionkey") == 0, "HIGH").when(F.col("n_regionkey") == 1, "MEDIUM").otherwise("LOW").alias("tier"))


RISK_SQL = "SELECT n_nationkey AS country_key, CASE n_regionkey WHEN 0 THEN 'HIGH' WHEN 1 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM nation"


def cell_labels(cells: DataFrame) -> DataFrame:
    """Ground truth by cell: (customer_id, period, is_true), from an arithmetic hash of the key."""
    month = F.substring("period", 6, 2).cast("int")
    return cells.select("customer_id", "period", ((F.col("customer_id") * 31 + month) % 7 == 0).alias("is_true")).distinct()


LABEL_EXPR = "(customer_id * 31 + substr(period, 6, 2)::INTEGER) % 7 = 0"


def sql_views(tx: str = "events") -> str:
    """WITH-list that defines tx, cust and risk for an oracle."""
    t, c = (TX_EVENTS_SQL, EVENT_CUSTOMERS_SQL) if tx == "events" else (TX_LINES_SQL, LINE_CUSTOMERS_SQL)
    return f"WITH tx AS MATERIALIZED ({t}), cust AS ({c}), risk AS ({RISK_SQL})"


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
