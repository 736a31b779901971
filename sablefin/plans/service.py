"""What an HTTP layer would call: screening, queue and disposition as functions over DataFrames."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.config import Screening
from sablefin.operators import audit
from sablefin.operators.ordering import numbered
from sablefin.operators.screening import screen_many, transaction_flags

PERSON = "subject_id string, name string, dob string, nationality string, national_id string"
QUEUE = "alert_id string, alert_type string, subject_id string, decision string, score double, detail string"


class RequestError(ValueError):
    """A request breaks the contract; ``status`` is the HTTP code it stands for."""

    def __init__(self, status: int, why: str) -> None:
        super().__init__(why)
        self.status = status


def check_person(name: str | None, dob: str | None = None, nationality: str | None = None, national_id: str | None = None, **extra: Any) -> dict[str, str | None]:
    """A valid request or RequestError 422: dob is a year or an ISO date, countries two letters, nothing extra."""
    if extra:
        raise RequestError(422, f"unknown fields {sorted(extra)}")
    if not name or not name.strip() or len(name) > 300:
        raise RequestError(422, "name must have 1 to 300 characters")
    if dob is not None and not re.fullmatch(r"\d{4}(-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01]))?", dob):
        raise RequestError(422, "dob must be YYYY or YYYY-MM-DD")
    if nationality is not None and not re.fullmatch(r"[A-Za-z]{2}", nationality):
        raise RequestError(422, "nationality must be two letters")
    return {"name": name.strip(), "dob": dob, "nationality": nationality.upper() if nationality else None, "national_id": national_id}


def number_alerts(alerts: DataFrame, prefix: str, order: list[str]) -> DataFrame:
    """``alerts`` with alert_id PREFIX-0000001 ... over the total ``order``; longer numbers keep all their digits."""
    n = numbered(alerts, list(order), "_alert", 1)
    return n.withColumn("alert_id", F.format_string(f"{prefix}-%07d", "_alert")).drop("_alert")


def queue(screening: DataFrame, monitoring: DataFrame) -> DataFrame:
    """QUEUE of screening alerts (by subject, entity) and rule alerts (by customer, period, rule)."""
    s = number_alerts(screening, "SCR", ["subject_id", "watchlist_uid"]).select(
        "alert_id", F.lit("SCREENING").alias("alert_type"), F.col("subject_id").cast("string").alias("subject_id"), "decision", F.col("final_score").alias("score"), F.col("watchlist_name").alias("detail")
    )
    m = number_alerts(monitoring, "TM", ["customer_id", "period", "rule_id"]).select(
        "alert_id", F.lit("TRANSACTION_MONITORING").alias("alert_type"), F.col("customer_id").cast("string").alias("subject_id"), F.lit("REVIEW").alias("decision"),
        F.col("metric_value").alias("score"), F.concat_ws(" ", "rule_id", "period").alias("detail"),
    )
    return s.unionByName(m)


def filtered(q: DataFrame, alert_type: str | None = None, subject_id: str | None = None, decision: str | None = None, min_score: float | None = None, undispositioned: bool = False, done: DataFrame | None = None) -> DataFrame:
    """Optional filters, AND-ed."""
    for c, v in (("alert_type", alert_type), ("subject_id", subject_id), ("decision", decision)):
        if v is not None:
            q = q.where(F.col(c) == v)
    if min_score is not None:
        q = q.where(F.col("score") >= min_score)
    if undispositioned and done is not None:
        q = q.join(done.select("alert_id"), "alert_id", "left_anti")
    return q


def page(q: DataFrame, limit: int = 50, offset: int = 0) -> DataFrame:
    """One page by score descending, then id."""
    return q.orderBy(F.desc("score"), "alert_id").offset(offset).limit(limit)


@dataclass
class Service:
    """State of one service process. Without a watchlist it starts degraded and screening is a 503."""

    spark: SparkSession
    watchlist: DataFrame | None
    risk: DataFrame
    alerts: DataFrame | None = None
    cfg: Screening = field(default_factory=Screening)
    version: str = "screening-v1"
    dispositions: dict[str, dict[str, Any]] = field(default_factory=dict)
    trail: list[dict[str, Any]] = field(default_factory=list)

    def health(self) -> dict[str, Any]:
        return {"status": "ok" if self.watchlist is not None else "degraded", "audit_records": len(self.trail), "dispositions": len(self.dispositions)}

    def screen_name(self, top_n: int = 5, min_score: float | None = None, subject_id: str = "AD-HOC", **person: Any) -> list[dict[str, Any]]:
        if self.watchlist is None:
            raise RequestError(503, "no watchlist is loaded")
        p = check_person(**person)
        one = self.spark.createDataFrame([(subject_id, p["name"], p["dob"], p["nationality"], p["national_id"])], PERSON)
        got = screen_many(one, self.watchlist, self.cfg, top_n, self.cfg.review if min_score is None else min_score)
        return [r.asDict() for r in got.orderBy(F.desc("final_score"), "watchlist_uid").collect()]

    def screen_transaction(self, tx: DataFrame, counterparty: str | None = None) -> dict[str, Any]:
        """Flags and counterparty matches of one canonical transaction row."""
        flags = transaction_flags(tx, self.risk).first()
        found = self.screen_name(name=counterparty, top_n=3) if counterparty else []
        return {"flags": [f for f in flags["flags"].split(",") if f], "matches": found, "requires_review": bool(found) or flags["high"]}

    def dispose(self, alert_id: str, outcome: str, analyst: str, level: str, reason: str, occurred_at: str) -> dict[str, Any]:
        """Record a disposition and chain an audit record. Escalating takes level L2; an alert is disposed of once."""
        if outcome not in ("ESCALATE", "CLEAR", "REQUEST_INFO"):
            raise RequestError(422, f"unknown outcome {outcome}")
        row = self.alerts.where(F.col("alert_id") == alert_id).first() if self.alerts is not None else None
        if row is None:
            raise RequestError(404, f"no alert {alert_id}")
        if outcome == "ESCALATE" and level != "L2":
            raise RequestError(403, "escalation takes level L2")
        if alert_id in self.dispositions:
            raise RequestError(409, f"{alert_id} is disposed of")
        entry = {"event_type": "DISPOSITION", "rule_version": self.version, "subject_id": row["subject_id"], "occurred_at": occurred_at, "decision": outcome, "input_snapshot": {"alert_id": alert_id, "analyst": analyst, "level": level, "reason": reason}, "scoring_breakdown": {"score": row["score"]}}
        last = self.trail[-1]["content_hash"] if self.trail else audit.GENESIS
        self.trail += audit.chain([entry], len(self.trail), last)
        self.dispositions[alert_id] = {"outcome": outcome, "analyst": analyst, "occurred_at": occurred_at}
        return self.trail[-1]
