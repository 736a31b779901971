"""Headline queries, timed. Prints one JSON line: total seconds and seconds by query."""

from __future__ import annotations

import json
import os
import time

from sablefin import catalog
from sablefin.session import get_spark

HEADLINE = (
    "r01_structuring", "r02_velocity", "r03_round_dollar", "r04_dormant_reactivation", "r05_new_account_burst", "r06_counterparty_concentration", "r07_high_risk_corridor",
    "r08_cash_intensity", "all_alerts_union", "features_base", "features_transformed", "sweep_all", "rule_performance", "roc_auc", "average_precision", "pct_rank_average",
    "dq_report", "txn_flags", "fingerprint", "screen_many",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark("bench", cpus, shuffle_partitions=int(cpus))
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # starts executors and the code cache
    took: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()  # whole result, no driver copy
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": os.path.basename(sf_dir).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
