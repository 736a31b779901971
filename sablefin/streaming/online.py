"""Online forms of the engine over Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sablefin.config import Screening
from sablefin.operators.screening import screen_many, transaction_flags


def screening_stream(people: DataFrame, watchlist: DataFrame, sink: str, checkpoint: str, cfg: Screening | None = None, top_n: int = 3, min_score: float = 0.70) -> StreamingQuery:
    """Screen each micro-batch of a stream of subjects and append the alerts to Parquet, by batch id: a
    replayed batch overwrites its own folder, so delivery is exactly once."""

    def batch(df: DataFrame, epoch: int) -> None:
        screen_many(df, watchlist, cfg, top_n, min_score).write.mode("overwrite").parquet(f"{sink}/batch={epoch}")

    return people.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def flag_stream(tx: DataFrame, risk: DataFrame) -> DataFrame:
    """Stateless single-transaction flags: a stream-static join."""
    return transaction_flags(tx, risk)


def volume_stream(tx: DataFrame, late: str = "1 day", window: str = "1 day") -> DataFrame:
    """Windowed volume by customer with a watermark for late transactions."""
    w = tx.withWatermark("txn_ts", late).groupBy(F.window("txn_ts", window), "customer_id")
    return w.agg(F.count(F.lit(1)).alias("txn_count"), F.sum(F.col("amount").cast("decimal(18,2)")).cast("double").alias("amount")).select("window.start", "customer_id", "txn_count", "amount")
