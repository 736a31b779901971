"""Controls, validation, audit chain, sinks, service, streaming and generator."""

from __future__ import annotations

import gzip
import json
import random

import pytest
from pyspark.sql import functions as F

from sablefin import session
from sablefin.operators import audit, data_quality as dq
from sablefin.plans import governance as gov, service as svc
from sablefin.sources import generator, tables as t
from sablefin.streaming import online


def event(k, **x):
    return {"event_type": "E", "rule_version": "v1", "subject_id": f"S{k}", "occurred_at": "2024-01-01", "decision": "REVIEW", "input_snapshot": {"b": 1, "a": 0.1 + 0.2}, "scoring_breakdown": {}, **x}


@pytest.fixture(scope="module")
def records():
    return list(audit.chain(event(k) for k in range(5)))


def frame(spark, rows):
    cols = [c.split()[0] for c in audit.SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], audit.SCHEMA)


def test_chain_holds_and_is_stable(spark, records):
    assert records[0]["previous_hash"] == audit.GENESIS
    assert audit.verify(frame(spark, records)) == 5
    assert records == list(audit.chain(event(k) for k in range(5)))
    assert json.loads(records[0]["input_snapshot"]) == {"a": 0.3, "b": 1}
    assert audit.verify(frame(spark, [])) == 0


@pytest.mark.parametrize(("change", "problem"), [("edit", "content_hash"), ("drop", "sequence"), ("relink", "previous_hash"), ("first", "sequence")])
def test_tampering_shows(spark, records, change, problem):
    rows = [dict(r) for r in records]
    if change == "edit":
        rows[2]["decision"] = "CLEAR"
    elif change == "drop":
        del rows[2]
    elif change == "first":
        del rows[0]
    else:
        rows[3]["previous_hash"] = "f" * 64
    with pytest.raises(audit.ChainError, match=problem):
        audit.verify(frame(spark, rows))


def plain_chain(rows, order, start=0, previous=audit.GENESIS):
    events = ({"event_type": "K", "rule_version": "v2", **{c: r[c] for c in ("subject_id", "occurred_at", "decision")}, "input_snapshot": json.loads(r["snapshot"] or "{}"), "scoring_breakdown": json.loads(r["breakdown"] or "{}")} for r in sorted(rows, key=order))
    return list(audit.chain(events, start, previous))


@pytest.mark.parametrize("segment", [7, 1000])
def test_built_chain_is_the_plain_one(spark, segment):
    """Segments that one task links each, continued by a second kind of record."""
    rows = [{"subject_id": f"S{k % 13}", "occurred_at": "2024-01-01T00:00:00Z", "decision": None if k % 5 == 0 else "REVIEW", "snapshot": None if k == 3 else json.dumps({"b": k / 3, "é\"": [1, None]}), "breakdown": json.dumps({"x": 0.1 * k}), "k": k, "sequence": "clash", "_head": "clash"} for k in range(40)]
    df = spark.createDataFrame(rows, "subject_id string, occurred_at string, decision string, snapshot string, breakdown string, k int, sequence string, _head string").drop("sequence").repartition(5)
    got = audit.build(df, ["subject_id", "k"], "v2", "K", segment=segment)
    want = plain_chain(rows, lambda r: (r["subject_id"], r["k"]))
    assert [r.asDict() for r in got.orderBy("sequence").collect()] == want
    assert audit.end(got) == (40, want[-1]["content_hash"])
    more = audit.build(df.limit(3), ["k"], "v2", "K", *audit.end(got), segment=segment)
    assert audit.verify(got.unionByName(more)) == 43
    assert audit.build(df.where("k < 0"), ["k"], "v2", "K").count() == 0 and audit.end(got.where("sequence < 0")) == (0, audit.GENESIS)


def test_manifests_by_executors(spark, tmp_path):
    for n in ("l", "r"):
        (tmp_path / n / "deep er").mkdir(parents=True)
        for f, body in (("a.csv", b"1"), ("deep er/b'x.csv", n.encode()), ("_SUCCESS", b""), (".a.csv.crc", b"x"), ("t.json", b"t")):
            (tmp_path / n / f).write_bytes(body)
    (tmp_path / "l" / "own").write_bytes(b"")
    (tmp_path / "r" / "new").write_bytes(b"")
    left, right = (audit.manifest_of(spark, str(tmp_path / n), ("t.json",)) for n in ("l", "r"))
    for n, m in (("l", left), ("r", right)):
        assert {r["name"]: r["sha256"] for r in m.collect()} == audit.manifest(tmp_path / n, ("t.json",))
    plain = audit.diff_manifests(*(audit.manifest(tmp_path / n, ("t.json",)) for n in ("l", "r")))
    got = {(r["name"], r["state"]) for r in audit.compare_manifests(left, right).collect()}
    assert got == {("own", "only_left"), ("new", "only_right"), ("deep er/b'x.csv", "differs")}
    assert plain == {"only_left": ["own"], "only_right": ["new"], "differ": ["deep er/b'x.csv"]}


def test_large_files_are_hashed_by_parts(spark, tmp_path, monkeypatch):
    """No task reads more than a part and the line that runs out of it; states are handed on; the hashes are those of the whole files."""
    rnd = random.Random(5)
    mark, some = b"\xef\xbb\xbf", lambda n: rnd.randbytes(n)
    bodies = {
        "random": some(90_000), "one line": b"x" * 30_000, "long line.csv": b"a\r\n" + b"y" * 25_000 + b"\n\n" + some(9_000), "lines": b"\n" * 12_000, "end": some(12_000).rstrip(b"\n") + b"\n",
        "marks": mark + mark + b"\n" + mark + some(12_000), "mark and line": mark + b"\n" * 11_000, "on {a,b} [part]*?": (b"z" * 3_999 + b"\n") * 4, "small": b"s", "empty": b"", "packed.gz": gzip.compress(some(12_000)), "left out": some(11_000),
    }
    (tmp_path / "in ner").mkdir()
    for name, body in bodies.items():
        (tmp_path / "in ner" / name).write_bytes(body)
    monkeypatch.setattr(audit, "WHOLE", 10_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    parts, run = [], spark.sparkContext.runJob
    monkeypatch.setattr(spark.sparkContext, "runJob", lambda rdd, f, only: parts.append((rdd.getNumPartitions(), only)) or run(rdd, f, only))
    try:
        got = audit.manifest_of(spark, str(tmp_path), ("left out",)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r["name"]: r["sha256"] for r in got} == audit.manifest(tmp_path, ("left out",))
    assert {r["name"]: r["bytes"] for r in got} == {f"in ner/{k}": len(v) for k, v in bodies.items() if k != "left out"}
    # each job is one part of many
    assert max(n for n, _ in parts) == 23 and all(len(only) == 1 for _, only in parts) and len(parts) == sum(-(-len(v) // 4_000) for k, v in bodies.items() if len(v) > 10_000 and k not in ("left out", "packed.gz"))


def test_jsonl_round_trip_and_csv(spark, records, tmp_path):
    for n in ("a", "b"):
        assert audit.write_jsonl(frame(spark, records).repartition(3), str(tmp_path / n), lines=2) == 5
        assert sorted(f.name for f in (tmp_path / n).iterdir() if f.suffix == ".jsonl") == [f"{k:09d}.jsonl" for k in range(3)]
    assert audit.manifest(tmp_path / "a") == audit.manifest(tmp_path / "b")
    assert (tmp_path / "a" / "000000000.jsonl").read_text() == "".join(audit.canonical(r) + "\n" for r in records[:2])
    back = audit.read_jsonl(spark, str(tmp_path / "a"))
    assert audit.verify(back) == 5
    tmp_path = tmp_path / "csv"
    tmp_path.mkdir()
    df = spark.createDataFrame([(2, 0.5, "x,y"), (1, None, 'q"')], "k int, v double, s string")
    for n in ("a.csv", "b.csv"):
        audit.write_csv(df.repartition(3), tmp_path / n, ["k"])
    assert (tmp_path / "a.csv").read_bytes() == b'k,v,s\n1,,"q"""\n2,0.500000,"x,y"\n' == (tmp_path / "b.csv").read_bytes()
    m = audit.manifest(tmp_path, ("b.csv",))
    assert set(m) == {"a.csv"}
    assert audit.diff_manifests(m, {**m, "c": "1", "a.csv": "2"}) == {"only_left": [], "only_right": ["c"], "differ": ["a.csv"]}
    assert audit.run_id(1, ["b", "a"]) == audit.run_id(1, ["a", "b"]) != audit.run_id(2, ["a", "b"])


def test_fingerprint_ignores_order_not_content(spark):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    a, b = (dq.fingerprint(d).first() for d in (df, df.orderBy(F.desc("id")).select("v", "id")))
    assert a == b != dq.fingerprint(df.where("id < 99")).first()


def test_controls_find_one_bad_amount_and_errors(spark, sf):
    cust, tx, watch = gov.controlled(spark, sf)
    bad = tx.withColumn("amount", F.when(F.col("txn_id") == tx.agg(F.min("txn_id")).first()[0], -1.0).otherwise(F.col("amount")))
    r = {x["check_id"]: x for x in dq.run_controls(cust, bad, watch, gov.START, gov.END).collect()}
    assert r["DQ05_AMOUNT_RANGE"]["failing_rows"] == 1 and r["DQ05_AMOUNT_RANGE"]["status"] == "FAIL" and len(r) == 10
    ok = dq.checked("A", "BLOCKER", lambda: spark.sql("select 0"))
    gone = dq.checked("B", "BLOCKER", lambda: spark.sql("select count(*) from nowhere"))
    assert ok[3] == "PASS" and gone == ("B", "BLOCKER", -1, "ERROR")
    dq.enforce([ok, ("C", "WARNING", 3, "FAIL")])
    with pytest.raises(dq.QualityError, match="B=-1"):
        dq.enforce([ok, gone])


def test_validation_names_every_violation(spark):
    specs = [dq.ColumnSpec("k", "bigint", False), dq.ColumnSpec("v", "double", True, minimum=0, maximum=10), dq.ColumnSpec("s", "string", True, allowed=("a",))]
    df = spark.createDataFrame([(1, 5.0, "a"), (1, -1.0, "b"), (None, 11.0, None)], "k long, v double, s string")
    with pytest.raises(ValueError) as e:
        dq.validate(df, specs, ["k"])
    assert all(x in str(e.value) for x in ("k: 1 fail null", "v: 1 fail minimum", "v: 1 fail maximum", "s: 1 fail domain", "k: 1 fail key"))
    with pytest.raises(ValueError, match="missing columns"):
        dq.coerce(df.drop("s"), specs)
    assert dq.coerce(df.select("s", "v", "k"), specs).columns == ["k", "v", "s"]


def test_settled_tables_can_be_forgotten(spark):
    a, b = session.settle(spark.range(3), "a"), session.settle(spark.range(4), "b")
    first, last = session.settled_paths(spark)[-2:]
    session.forget(spark, [first])
    assert b.count() == 4 and session.settled_paths(spark)[-1] == last and first not in session.settled_paths(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist|not exist"):
        spark.read.parquet(first).count()
    with pytest.raises(ValueError):
        session.forget(spark, ["/nowhere"])


def test_only_valid_rows_are_written(spark, tmp_path):
    specs = [dq.ColumnSpec("k", "bigint", False), dq.ColumnSpec("v", "double", True, minimum=0)]
    good = spark.createDataFrame([(1.5, 1), (None, 2)], "v double, k int")
    assert sorted(map(tuple, dq.write_validated(good, specs, ["k"], str(tmp_path / "good")).collect())) == [(1, 1.5), (2, None)]
    with pytest.raises(ValueError, match="v: 1 fail minimum"):
        dq.write_validated(good.withColumn("v", -F.col("v")), specs, ["k"], str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()


@pytest.fixture(scope="module")
def service(spark, sf):
    w = spark.createDataFrame([("U1", "Sergei Ivanov", None, "P", "1968", "RU", None)], "uid string, name string, aliases string, program string, dob string, nationality string, national_id string")
    a = spark.createDataFrame([("SCR-0000001", "SCREENING", "C1", "ESCALATE", 0.97, "x"), ("SCR-0000002", "SCREENING", "C2", "REVIEW", 0.85, "y"), ("TM-0000001", "TRANSACTION_MONITORING", "C1", "REVIEW", 3.0, "R01 2024-01")], svc.QUEUE)
    return svc.Service(spark, w, t.risk_tiers(spark, sf), a)


def test_service_screens_and_refuses(spark, sf, service):
    assert service.screen_name(name="Ivanov Sergei", nationality="ru")[0]["watchlist_uid"] == "U1"
    tx = spark.createDataFrame([(1, 1, None, 12000.0, "WIRE", "DEBIT", None, 0, True)], "txn_id long, customer_id long, txn_ts timestamp, amount double, channel string, direction string, counterparty string, country_key int, is_cross_border boolean")
    r = service.screen_transaction(tx, "Sergei Ivanov")
    assert "CTR_REPORTABLE" in r["flags"] and "ROUND_VALUE" in r["flags"] and r["requires_review"]
    for bad in ({"name": ""}, {"name": "x", "dob": "68"}, {"name": "x", "nationality": "RUS"}, {"name": "x", "colour": "red"}):
        with pytest.raises(svc.RequestError) as e:
            service.screen_name(**bad)
        assert e.value.status == 422
    with pytest.raises(svc.RequestError) as e:
        svc.Service(spark, None, service.risk).screen_name(name="x")
    assert e.value.status == 503


def test_queue_filters_pages_and_dispositions(spark, service):
    q = service.alerts
    assert [r["alert_id"] for r in svc.page(q, limit=2).collect()] == ["TM-0000001", "SCR-0000001"]
    assert svc.filtered(q, alert_type="SCREENING", min_score=0.9).count() == 1
    with pytest.raises(svc.RequestError) as e:
        service.dispose("SCR-0000001", "ESCALATE", "ann", "L1", "r", "2024-02-01")
    assert e.value.status == 403
    service.dispose("SCR-0000001", "ESCALATE", "ann", "L2", "r", "2024-02-01")
    service.dispose("SCR-0000002", "CLEAR", "ann", "L1", "r", "2024-02-01")
    with pytest.raises(svc.RequestError) as e:
        service.dispose("SCR-0000002", "CLEAR", "ann", "L1", "r", "2024-02-01")
    assert e.value.status == 409
    done = spark.createDataFrame([(a,) for a in service.dispositions], "alert_id string")
    assert svc.filtered(q, undispositioned=True, done=done).count() == 1
    assert audit.verify(frame(spark, service.trail)) == 2


def test_streams(spark, sf, service, tmp_path):
    people = spark.createDataFrame([("S1", "Sergei Ivanov", None, None, None), ("S2", "Jo Li", None, None, None)], svc.PERSON)
    people.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(people.schema).parquet(f"{tmp_path}/in")
    q = online.screening_stream(stream, service.watchlist, f"{tmp_path}/out", f"{tmp_path}/ck")
    q.awaitTermination(120)
    assert [r["subject_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["S1"]
    tx = t.tx_events(spark, sf)
    tx.write.parquet(f"{tmp_path}/tx")
    live = spark.readStream.schema(tx.schema).parquet(f"{tmp_path}/tx")
    q = online.volume_stream(live).writeStream.format("memory").queryName("volume").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("volume").agg(F.sum("txn_count")).first()[0] == tx.count()


def test_generator_is_a_function_of_its_seed(spark):
    a, b = generator.transactions(spark, 50, 2000), generator.transactions(spark, 50, 2000).repartition(5)
    assert dq.fingerprint(a).first() == dq.fingerprint(b).first() != dq.fingerprint(generator.transactions(spark, 50, 2000, seed=2)).first()
    assert a.count() == 2000 and a.where("typology = 'STRUCTURING' and (channel <> 'CASH' or amount not between 8200 and 9999)").count() == 0
    lab = generator.labels(a)
    assert lab.count() == a.select("customer_id", F.date_format("txn_ts", "yyyy-MM")).distinct().count()
    w = generator.watchlist(spark, 1000)
    missing = w.where("dob is null").count() / 1000
    assert 0.28 < missing < 0.40
    c = generator.customers(spark, 300, w, 20)
    assert c.where("planted_uid is not null").count() == 20


def test_sources(spark, sf, tmp_path):
    assert set(t.read_tables(spark, sf, ["nation", "region"])) == {"nation", "region"}
    with pytest.raises(FileNotFoundError, match="nothing"):
        t.read_tables(spark, sf, ["nothing"])
    (tmp_path / "a.csv").write_text("k,v\n1,x\n")
    assert t.read_csv(spark, str(tmp_path / "a.csv"), "k int, v string").first() == (1, "x")


def test_numbered_queue(spark):
    a = spark.createDataFrame([(f"C{k % 3}", f"U{k}", "REVIEW", 0.9, "w") for k in range(20)], "subject_id string, watchlist_uid string, decision string, final_score double, watchlist_name string")
    m = spark.createDataFrame([(k % 4, "2024-01", f"R0{k}", 1.0) for k in range(8)], "customer_id long, period string, rule_id string, metric_value double")
    ids = {r["alert_id"]: r for r in svc.queue(a, m).collect()}
    assert sorted(ids) == [f"SCR-{k:07d}" for k in range(1, 21)] + [f"TM-{k:07d}" for k in range(1, 9)]
    assert ids["SCR-0000001"]["subject_id"] == "C0" and ids["TM-0000008"]["detail"] == "R07 2024-01"
    far = svc.number_alerts(spark.createDataFrame([(1,)], "k int"), "X", ["k"])
    assert far.first()["alert_id"] == "X-0000001" and far.columns == ["k", "alert_id"]
