"""The batch run end to end, twice."""

from __future__ import annotations

import json
import logging

import pytest

from sablefin.config import from_yaml, scenarios
from sablefin.operators import audit
from sablefin.operators.models import Boosting
from sablefin.plans import batch


def test_two_runs_write_equal_bytes(spark, tmp_path):
    kept = {k: v for k, v in scenarios().items() if k[:3] in ("R01", "R06", "R08")}
    for n in ("a", "b"):
        m = batch.run_batch(spark, tmp_path / n, n_watch=60, n_customers=150, n_tx=5000, some=kept, boosted={"boosted_shallow": Boosting(5, 3, 0.3)}, trees=50)
    a, b = (audit.manifest(tmp_path / n, batch.VOLATILE) for n in ("a", "b"))
    assert audit.diff_manifests(a, b) == {"only_left": [], "only_right": [], "differ": []} and len(a) >= 9
    assert m["blocking"]["recall"] > 0.8 and m["audit_records"] > 0
    assert 0 <= m["models"]["isolation"]["roc_auc"] <= 1


def test_yaml(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("scenarios:\n  R05_NEW_ACCOUNT_BURST:\n    params: {account_age_days: 30, min_txn_count: 2, min_total_amount: 5}\n    sweep: {param: min_total_amount, values: [1, 5]}\n")
    s = from_yaml(str(p))["R05_NEW_ACCOUNT_BURST"]
    assert s.params["account_age_days"] == 30.0 and s.grid == [1.0, 5.0]
    for bad in ("x: 1", "scenarios: {R99: {}}", "scenarios: {R01_STRUCTURING: {params: {window_days: 1}}}"):
        p.write_text(bad)
        with pytest.raises(ValueError):
            from_yaml(str(p))


def test_json_lines():
    r = logging.makeLogRecord({"name": "x", "levelname": "INFO", "msg": "done %s", "args": ("ok",), "stage": "s"})
    assert json.loads(batch.JsonLines().format(r)) == {"level": "INFO", "logger": "x", "message": "done ok", "stage": "s"}
