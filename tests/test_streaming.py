import glob
import json
import os

from policies import M1, M2, MEMBER_POLICY
from veilspark.policy import Policy
from veilspark.sources.files import read_json_text, read_json_text_stream
from veilspark.sources.kafka import kafka_available
from veilspark.streaming.job import PolicyMonitor, ProtectStream, run_batch
from veilspark.streaming.metrics import Totals, metrics_frame, run_row


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def outputs(path):
    rows = {}
    for f in glob.glob(f"{path}/batch=*/part-*"):
        batch = int(f.split("batch=")[1].split("/")[0])
        for line in open(f):
            if line.strip():
                rows.setdefault(batch, []).append(json.loads(line))
    return rows


def test_stream_reload_restart_and_quarantine(spark, tmp_dir):
    inp, out, bad, ck = (f"{tmp_dir}/{n}" for n in ("in", "out", "bad", "ck"))
    os.makedirs(inp)
    pol = f"{tmp_dir}/policy.json"
    write(pol, json.dumps(MEMBER_POLICY))
    write(f"{inp}/a.json", M1 + "\n" + "not json\n")
    mon = PolicyMonitor(spark, pol, refresh_seconds=0)
    job = ProtectStream(spark, mon, out, quarantine_path=bad, metrics_path=f"{tmp_dir}/metrics")
    q = job.start(read_json_text_stream(spark, inp), ck, {"availableNow": True})
    q.awaitTermination()
    first = outputs(out)
    mrow = spark.read.parquet(f"{tmp_dir}/metrics").first()
    assert mrow.batch_id == 0 and mrow.counts["records_rejected"] == 1
    assert json.loads(mrow.details["policy_digest"]) == Policy.from_dict(MEMBER_POLICY).digest
    assert list(first) == [0] and first[0][0]["alias"] == "Qu*****"
    assert job.metrics.last["counts"] == {"records_in": 2, "records_out": 1, "records_rejected": 1}

    # edit the policy: alias is no longer protected; a restart only sees new input
    changed = json.loads(json.dumps(MEMBER_POLICY))
    changed["fields"][1]["isPII"] = False
    write(pol, json.dumps(changed))
    write(f"{inp}/b.json", M2 + "\n")
    job2 = ProtectStream(spark, mon, out, quarantine_path=bad, drift_path=f"{tmp_dir}/drift")
    q = job2.start(read_json_text_stream(spark, inp), ck, {"availableNow": True})
    q.awaitTermination()
    second = outputs(out)
    assert sorted(second) == [0, 1]
    assert second[1][0]["id"] == "m-9" and second[1][0]["alias"] == "Ib"
    assert job2.metrics.last["counts"]["records_with_undeclared"] == 1  # hold
    drift_rows = spark.read.parquet(f"{tmp_dir}/drift").collect()
    assert [(r.field, r.n_records, r.batch) for r in drift_rows] == [("hold", 1, 1)]
    assert mon.reloads == 1

    # a broken policy file keeps the last good version; an empty restart runs no batch
    write(pol, "{ broken")
    assert mon.current().digest == Policy.from_dict(changed).digest
    job3 = ProtectStream(spark, mon, out)
    q = job3.start(read_json_text_stream(spark, inp), ck, {"availableNow": True})
    q.awaitTermination()
    assert job3.metrics.batches == 0
    rejected = [json.loads(l) for f in glob.glob(f"{bad}/batch=*/part-*") for l in open(f) if l.strip()]
    assert rejected == [{"value": "not json", "reason": "parse_error"}]


def test_batch_equals_stream(spark, tmp_dir):
    inp, out_b, out_s, ck = (f"{tmp_dir}/{n}" for n in ("in", "ob", "os", "ck"))
    os.makedirs(inp)
    pol = f"{tmp_dir}/p.json"
    det = json.loads(json.dumps(MEMBER_POLICY))
    det["fields"] = [f for f in det["fields"] if f.get("piiOperation") != "randomize"]
    write(pol, json.dumps(det))
    write(f"{inp}/a.json", M1 + "\n" + M2 + "\n")
    run_batch(spark, read_json_text(spark, inp), Policy.from_dict(det), out_b)
    job = ProtectStream(spark, PolicyMonitor(spark, pol), out_s)
    run = job.run(read_json_text_stream(spark, inp), ck)
    assert run["status"] == "SUCCESS" and run["counts"]["records_out"] == 2 and run["details"]["query_id"]
    batch = sorted(l for f in glob.glob(f"{out_b}/part-*") for l in open(f) if l.strip())
    stream = sorted(l for f in glob.glob(f"{out_s}/batch=*/part-*") for l in open(f) if l.strip())
    assert batch == stream and len(batch) == 2


def test_metrics_rows(spark):
    import time

    row = run_row("j", "Name", "id-1", time.time() - 2, {"records_in": 5}, batch_id=3)
    assert 2 <= row["seconds"] < 10 and row["status"] == "SUCCESS" and row["error"] is None
    got = metrics_frame(spark, [row]).first()
    assert got.counts == {"records_in": 5} and got.details == {"batch_id": "3"} and got.job_id == "id-1"
    t = Totals(keep=3)
    for i in range(10):
        t.add(run_row("j", "n", "x", time.time(), {"records_in": i}))
    assert (t.counts, t.batches, len(t.rows), t.last["counts"]) == ({"records_in": 45}, 10, 3, {"records_in": 9})


def test_kafka_connector_detection(spark):
    assert kafka_available(spark) in (True, False)


def test_custom_sink_and_missing_output(spark, tmp_dir):
    import pytest
    from veilspark.streaming.job import console_sink

    pol = f"{tmp_dir}/p.json"
    write(pol, json.dumps(MEMBER_POLICY))
    with pytest.raises(ValueError):
        ProtectStream(spark, PolicyMonitor(spark, pol))
    seen = []
    job = ProtectStream(spark, PolicyMonitor(spark, pol), sink=lambda df, b: seen.append((b, df.count())))
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.json", M1 + "\n")
    job.run(read_json_text_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ck")
    assert seen == [(0, 1)] and callable(console_sink())


def test_cli_settings(spark, tmp_dir):
    import pytest

    from veilspark.streaming.cli import build, parse_config

    cfg, ignored = parse_config(["schema-path=" + f"{tmp_dir}/p.json", "input-path=" + f"{tmp_dir}/in",
                                 "output-path=" + f"{tmp_dir}/out", "execution.mode=batch", "stray",
                                 "job-id=job-1", "schema.refresh.interval.seconds=5"])
    assert ignored == ["stray"]
    write(f"{tmp_dir}/p.json", json.dumps(MEMBER_POLICY))
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.json", M1 + "\n" + M2 + "\n")
    job, source, ckpt, trigger = build(spark, cfg)
    assert trigger == {"availableNow": True} and ckpt.endswith("/job-1") and job.monitor.refresh_seconds == 5
    summary = job.run(source, ckpt, trigger)
    assert summary["status"] == "SUCCESS" and summary["counts"]["records_out"] == 2
    assert len(outputs(f"{tmp_dir}/out")[0]) == 2
    with pytest.raises(ValueError, match="output"):
        build(spark, {"schema-path": f"{tmp_dir}/p.json", "input-path": f"{tmp_dir}/in"})


def test_cli_main(spark, tmp_dir, capsys):
    from veilspark.streaming.cli import main

    write(f"{tmp_dir}/p.json", json.dumps(MEMBER_POLICY))
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.json", M1 + "\n" + "oops\n")
    code = main([f"schema-path={tmp_dir}/p.json", f"input-path={tmp_dir}/in", f"output-path={tmp_dir}/out",
                 f"quarantine-path={tmp_dir}/bad", f"checkpoint.dir={tmp_dir}/ck", "execution.mode=batch"])
    summary = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert code == 0 and summary["status"] == "SUCCESS"
    assert summary["counts"] == {"records_in": 2, "records_out": 1, "records_rejected": 1}


def test_policy_monitor_interval_return_and_strict(spark, tmp_dir):
    path = f"{tmp_dir}/p.json"
    v1 = {"fields": [{"name": "a", "isPII": True}]}
    v2 = {"fields": [{"name": "a", "isPII": True, "piiOperation": "hash"}]}
    now = [0.0]
    write(path, json.dumps(v1))
    mon = PolicyMonitor(spark, path, refresh_seconds=60, clock=lambda: now[0])
    write(path, json.dumps(v2))
    now[0] = 30
    assert mon.current().rule("a").operation == "mask"  # interval not yet over
    now[0] = 61
    assert mon.current().rule("a").operation == "hash"
    write(path, json.dumps(v1))  # going back to the first version is a change too
    now[0] = 130
    assert mon.current().rule("a").operation == "mask" and mon.reloads == 2
    strict = PolicyMonitor(spark, path, refresh_seconds=0, strict=True)
    write(path, json.dumps({"name": "no fields"}))
    assert strict.current().digest == Policy.from_dict(v1).digest  # lint error: last good kept
    assert PolicyMonitor(spark, path, refresh_seconds=0).current().rules == ()  # non-strict: accepted


def test_example_policy_through_cli(spark, tmp_dir, capsys):
    from conftest import ROOT, SF_SMALL
    from veilspark.plans.inputs import customer_json
    from veilspark.streaming.cli import main

    customer_json(spark, SF_SMALL).write.text(f"{tmp_dir}/in")
    code = main([f"schema-path={ROOT}/policies/customer-example.json", f"input-path={tmp_dir}/in",
                 f"output-path={tmp_dir}/out", f"checkpoint.dir={tmp_dir}/ck", "execution.mode=batch"])
    assert code == 0
    rows = [r for rs in outputs(f"{tmp_dir}/out").values() for r in rs]
    assert len(rows) == 150 and all(set(r) == {"id", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"} for r in rows)
    assert all(r["c_name"].startswith("Customer#") and r["c_name"][9:13] == "****" for r in rows)


def test_cli_table_job(spark, tmp_dir, capsys):
    from conftest import ROOT, SF_SMALL
    from veilspark.streaming.cli import main

    policy = {"fields": [{"name": "c_name", "isPII": True, "piiOperation": "hash"},
                         {"name": "c_acctbal", "type": "double", "isPII": True, "piiOperation": "generalize",
                          "ranges": [0, 5000]}]}
    write(f"{tmp_dir}/p.json", json.dumps(policy))
    assert main([f"schema-path={tmp_dir}/p.json", f"input-table={SF_SMALL}/customer.parquet",
                 f"output-table={tmp_dir}/out", "id-column=c_custkey", "partition-by=c_mktsegment"]) == 0
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert sorted(out.columns) == ["c_acctbal", "c_custkey", "c_mktsegment", "c_name"] and out.count() == 150
    assert out.where("c_acctbal NOT IN ('<0', '0-5000', '5000+')").count() == 0


def test_compiled_policy_reuse_keeps_randomness_fresh(spark, tmp_dir):
    from veilspark.streaming.job import CompiledPolicy

    p1 = Policy.from_dict({"fields": [{"name": "s", "isPII": True, "piiOperation": "randomize"}]})
    p2 = Policy.from_dict({"fields": [{"name": "s", "isPII": True}]})
    cp = CompiledPolicy()
    c1 = cp.get(p1)
    assert cp.get(p1) is c1 and cp.get(p2) is not c1
    pol = f"{tmp_dir}/p.json"
    write(pol, json.dumps({"fields": [{"name": "s", "isPII": True, "piiOperation": "randomize"}]}))
    os.makedirs(f"{tmp_dir}/in")
    doc = '{"id":"a","s":"' + "x" * 40 + '"}'
    write(f"{tmp_dir}/in/1.json", doc + "\n")
    job = ProtectStream(spark, PolicyMonitor(spark, pol), f"{tmp_dir}/out")
    src = read_json_text_stream(spark, f"{tmp_dir}/in", max_files_per_trigger=1)
    write(f"{tmp_dir}/in/2.json", doc + "\n")
    job.run(src, f"{tmp_dir}/ck")
    outs = outputs(f"{tmp_dir}/out")
    assert sorted(outs) == [0, 1] and outs[0][0]["s"] != outs[1][0]["s"]


def test_typed_policy_on_a_streaming_frame(spark, tmp_dir):
    from conftest import SF_SMALL
    from veilspark.operators.protect import apply_policy

    spark.read.parquet(f"{SF_SMALL}/customer.parquet").write.parquet(f"{tmp_dir}/in")
    schema = spark.read.parquet(f"{tmp_dir}/in").schema
    stream = spark.readStream.schema(schema).parquet(f"{tmp_dir}/in")
    pol = Policy.from_dict({"fields": [{"name": "c_name", "isPII": True, "maskFormat": "XXXX"},
                                       {"name": "c_nationkey", "isPII": True, "piiOperation": "generalize",
                                        "type": "integer", "ranges": [0, 10, 20]}]})
    q = (apply_policy(stream, pol, id_col="c_custkey").writeStream.format("memory").queryName("protected_customers")
         .option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    rows = spark.sql("SELECT * FROM protected_customers").collect()
    assert len(rows) == 150 and all(r.c_name.startswith("Cust") and set(r.c_name[4:]) == {"*"} for r in rows)
    assert {r.c_nationkey for r in rows} <= {"0-10", "10-20", "20+"}


def test_cli_usage_errors(capsys):
    from veilspark.streaming.cli import main

    assert main([]) == 2 and "schema-path is required" in capsys.readouterr().err
    assert main(["schema-path=p.json", "input-path=x"]) == 2 and "output-topic or output-path" in capsys.readouterr().err
    assert main(["schema-path=p.json", "input-table=x"]) == 2 and "output-table" in capsys.readouterr().err


def test_console_sink_prints_the_batch(spark, tmp_dir, capfd):
    from veilspark.streaming.job import console_sink

    write(f"{tmp_dir}/p.json", json.dumps(MEMBER_POLICY))
    os.makedirs(f"{tmp_dir}/in")
    write(f"{tmp_dir}/in/a.json", M1 + "\n")
    job = ProtectStream(spark, PolicyMonitor(spark, f"{tmp_dir}/p.json"), sink=console_sink())
    summary = job.run(read_json_text_stream(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ck")
    assert summary["counts"]["records_out"] == 1 and "Qu*****" in capfd.readouterr().out
