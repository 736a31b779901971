"""The whole batch run: generate or read, control, screen, monitor, learn, sweep, audit, and write artefacts."""

from __future__ import annotations

import json
import logging
import time
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sablefin.config import Monitoring, Scenario, Screening, scenarios
from sablefin.operators import audit, evaluate, features, models, rules, screening, sweep
from sablefin.operators import data_quality as dq
from sablefin.session import settle
from sablefin.sources import generator

log = logging.getLogger("sablefin")
#: Files whose bytes may differ between two runs.
VOLATILE = ("timings.json",)


class JsonLines(logging.Formatter):
    """One JSON object a line, extra fields included."""

    def format(self, record: logging.LogRecord) -> str:
        extra = {k: v for k, v in record.__dict__.items() if k not in logging.makeLogRecord({}).__dict__ and k != "message"}
        return json.dumps({"level": record.levelname, "logger": record.name, "message": record.getMessage(), **extra}, sort_keys=True, default=str)


def tiers(spark: SparkSession) -> DataFrame:
    """Countries of generated feeds: the first five of 25 are HIGH, the next five MEDIUM."""
    return spark.range(25).select(F.col("id").cast("int").alias("country_key"), F.when(F.col("id") < 5, "HIGH").when(F.col("id") < 10, "MEDIUM").otherwise("LOW").alias("tier"))


def run_batch(spark: SparkSession, out: Path, n_watch: int = 200, n_customers: int = 500, n_tx: int = 20_000, seed: int = 1, some: dict[str, Scenario] | None = None, boosted: dict[str, models.Boosting] | None = None, trees: int = 200) -> dict[str, Any]:
    """Run every stage on a generated feed and write its artefacts to ``out``. Returns the metrics.

    Two runs with equal arguments write equal bytes, but for VOLATILE files.
    """
    out.mkdir(parents=True, exist_ok=True)
    rules_of, cfg, mon, took = some or scenarios(), Screening(), Monitoring(), {}
    metrics: dict[str, Any] = {"run_id": audit.run_id(seed, sorted(rules_of))}

    def stage(name: str, began: float) -> None:
        took[name] = round(time.perf_counter() - began, 3)
        log.info("stage done", extra={"stage": name, "seconds": took[name]})

    t = time.perf_counter()
    watch = settle(generator.watchlist(spark, n_watch, seed), "watchlist")
    people = settle(generator.customers(spark, n_customers, watch, max(n_customers // 50, 5), seed), "customers")
    tx = settle(generator.transactions(spark, n_customers, n_tx, seed=seed), "transactions")
    risk = tiers(spark)
    cust = people.select("customer_id", "behaviour_segment", "account_open_date", (F.col("customer_id") % 25).cast("int").alias("nation_key"), "kyc", "is_pep")
    stage("generate", t)

    t = time.perf_counter()
    coded = tx.withColumn("country", F.concat(F.lit("A"), F.chr(F.col("country_key") + 65)))
    report = dq.run_controls(cust, coded, watch.select(F.col("name").alias("primary_name")), "2024-01-01", "2025-01-01")
    audit.write_csv(report, out / "dq_report.csv", ["check_id"])
    dq.enforce([(r["check_id"], r["severity"], r["failing_rows"], r["status"]) for r in report.collect()])  # ten rows
    stage("quality", t)

    t = time.perf_counter()
    truth = people.where("planted_uid is not null").select("subject_id", F.col("planted_uid").alias("uid"))
    alerts = settle(screening.screen_many(people, watch, cfg, digits=None), "screening")
    audit.write_csv(alerts, out / "screening_alerts.csv", ["subject_id", "watchlist_uid"])
    audit.write_csv(screening.screening_sweep(alerts, truth), out / "screening_sweep.csv", ["threshold"])
    metrics["blocking"] = screening.blocking_stats(people, watch, cfg).first().asDict() | screening.blocking_recall(truth, people, watch, cfg).first().asDict()
    stage("screening", t)

    t = time.perf_counter()
    labels = settle(generator.labels(tx), "labels")
    found = settle(rules.run_all(tx, cust, risk, rules_of), "alerts")
    audit.write_csv(found, out / "rule_alerts.csv", ["customer_id", "period", "rule_id"])
    audit.write_csv(sweep.rule_performance(found, labels), out / "rule_performance.csv", ["rule_id"])
    metrics["rules"] = sweep.union_recall(found, labels).first().asDict()
    swept = settle(sweep.sweep_all(rules_of, tx, cust, risk, labels), "sweep")
    audit.write_csv(swept, out / "sweep.csv", ["rule_id", "param_value"])
    audit.write_csv(sweep.recommend(swept), out / "recommendations.csv", ["rule_id"])
    stage("monitoring", t)

    t = time.perf_counter()
    base = settle(features.base_features(tx, cust, risk), "base")
    split = settle(features.split_by_customer(base, mon.test_share), "split")
    train = base.join(split.where("not is_test"), "customer_id", "left_semi")
    x = features.transform(base, features.peer_medians(train), features.shrink_targets(train), list(generator.SEGMENTS))
    x = features.attach_labels(x, labels.select("customer_id", "period", "is_true")).withColumnRenamed("is_true", "y")
    x = settle(x.join(split, "customer_id"), "matrix")
    cols = [c for c in x.columns if c not in ("customer_id", "period", "behaviour_segment", "y", "is_test")]
    learn, test, key = x.where("not is_test"), x.where("is_test"), ["customer_id", "period"]
    boosted = boosted or {"boosted_shallow": models.SHALLOW, "boosted_deep": models.DEEP}
    scores = {name: models.boosted_scores(learn, test, cols, conf, key)[0] for name, conf in boosted.items()}
    scores["isolation"] = models.isolation_scores(learn, test, cols, key, trees=trees)
    metrics["models"], every = {}, None
    for name, s in scores.items():
        s = settle(s, f"scores-{name}")
        auc, ap = evaluate.roc_auc(s).first()[0], evaluate.average_precision(s).first()[0]
        metrics["models"][name] = {"roc_auc": auc, "average_precision": ap, "at_budget": evaluate.at_budget(s, mon.alert_budget, key).first().asDict()}
        each = s.select(F.lit(name).alias("model"), "period", "score", "y")
        every = each if every is None else every.unionByName(each)
    report = {(r["model"], r["slice"]): r for r in evaluate.out_of_time_report(every, mon.out_of_time_months).collect()}  # two rows a model
    metrics["best_model"] = next(m for (m, k), r in sorted(report.items()) if r["best"])
    metrics["out_of_time"] = report[metrics["best_model"], "out_of_time"].asDict()
    stage("models", t)

    t = time.perf_counter()
    events = alerts.where(F.round("final_score", 6) >= cfg.review).select(
        "subject_id", F.lit("2024-12-31T00:00:00Z").alias("occurred_at"), "decision", F.to_json(F.struct("watchlist_uid", "matched_on")).alias("snapshot"),
        F.to_json(F.struct("name_score", "corroboration_delta", "final_score")).alias("breakdown"), "watchlist_uid",
    )
    first = audit.build(events, ["subject_id", "watchlist_uid"], "screening-v1", "SCREENING_ALERT")
    month = F.concat(F.last_day(F.to_date(F.concat("period", F.lit("-01")))).cast("string"), F.lit("T00:00:00Z"))
    tm = found.select(
        F.col("customer_id").cast("string").alias("subject_id"), month.alias("occurred_at"), F.lit("REVIEW").alias("decision"), F.to_json(F.struct("rule_id", "period", "txn_count")).alias("snapshot"),
        F.to_json(F.struct("metric_value", "alert_amount")).alias("breakdown"), "customer_id", "period", "rule_id",
    )
    rest = audit.build(tm, ["customer_id", "period", "rule_id"], "monitoring-v1", "TM_ALERT", *audit.end(first))
    trail = str((out / "audit").absolute())
    metrics["audit_records"] = audit.write_jsonl(first.unionByName(rest), trail)
    audit.verify(audit.read_jsonl(spark, trail))
    stage("audit", t)

    audit.write_json(metrics, out / "metrics.json")
    audit.write_json(took, out / "timings.json")
    audit.write_json(audit.manifest(out, (*VOLATILE, "manifest.json")), out / "manifest.json")
    return metrics
