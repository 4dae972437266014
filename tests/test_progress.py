"""Progress rows from the engine, and keyed hashes, through the protection stream."""

import json
import os

import pytest
from pyspark.sql import functions as F

from policies import M1, M2, MEMBER_POLICY
from test_keys import JAN, SECRETS
from test_streaming import outputs, write
from veilspark.operators import keys as K
from veilspark.sources.files import read_json_text_stream
from veilspark.streaming.job import PolicyMonitor, ProtectStream
from veilspark.streaming.progress import behind, progress_frame, progress_row


def test_lag_from_offsets():
    assert behind("5", "9") == 4 and behind("9", "5") == 0
    assert behind('{"t":{"0":5,"1":7}}', '{"t":{"0":6,"1":10}}') == 4
    assert behind('{"t":{"0":5}}', None, {"maxOffsetsBehindLatest": "3"}) == 3
    assert behind(None, "1") is None and behind("x", "y") is None and behind('{"a":true}', '{"a":true}') is None
    row = progress_row({"id": "q", "runId": "r", "batchId": 1, "timestamp": "t", "inputRowsPerSecond": "NaN", "processedRowsPerSecond": 2.0, "numInputRows": 3,
                        "durationMs": {"triggerExecution": 5}, "stateOperators": [{"numRowsTotal": 4, "memoryUsedBytes": 8, "numRowsDroppedByWatermark": 2}],
                        "sources": [{"description": "s", "startOffset": {"t": {"0": 1}}, "endOffset": {"t": {"0": 4}}, "latestOffset": {"t": {"0": 6}}, "numInputRows": 3}]})
    assert (row["input_rate"], row["processed_rate"], row["state_rows"], row["late_rows"]) == (None, 2.0, 4, 2)
    assert row["sources"][0]["behind"] == 2 and row["sources"][0]["finish"] == '{"t": {"0": 4}}'


def test_two_batches_and_a_failure_leave_rows(spark, tmp_dir):
    inp, out, ck, rows = (f"{tmp_dir}/{n}" for n in ("in", "out", "ck", "progress"))
    os.makedirs(inp)
    pol = f"{tmp_dir}/policy.json"
    write(pol, json.dumps(MEMBER_POLICY))
    mon = PolicyMonitor(spark, pol, refresh_seconds=0)
    for name, text in (("a", M1 + "\n" + M2 + "\n"), ("b", M2 + "\n")):
        write(f"{inp}/{name}.json", text)
        job = ProtectStream(spark, mon, out, progress_path=rows)
        summary = job.run(read_json_text_stream(spark, inp), ck)
        progress = json.loads(summary["details"]["progress"])
        assert progress["input_rows"] == len(text.splitlines()) and progress["triggers"] >= 1 and progress["error"] is None
        assert progress["trigger_ms"] > 0

    def broken(df, batch_id):
        raise RuntimeError("the sink is gone")

    write(f"{inp}/c.json", M1 + "\n")
    job = ProtectStream(spark, mon, sink=broken, progress_path=rows)
    with pytest.raises(Exception, match="the sink is gone"):
        job.run(read_json_text_stream(spark, inp), ck)
    assert json.loads(job.summary["details"]["progress"])["error"]

    t = progress_frame(spark, rows)
    by = {r.event: r.n for r in t.groupBy("event").agg(F.count("*").alias("n")).collect()}
    assert (by["started"], by["finished"], by["failed"]) == (3, 2, 1)
    done = t.where("event = 'progress' and input_rows > 0").orderBy("batch_id").collect()
    assert [(r.batch_id, r.input_rows) for r in done] == [(0, 2), (1, 1)]
    assert all(r.processed_rate > 0 and "triggerExecution" in r.phases_ms and r.sources[0].finish for r in done)
    assert len({r.query_id for r in t.collect()}) == 1 and len({r.run_id for r in t.collect()}) == 3
    assert t.where("event = 'failed'").first().error


def test_another_query_is_left_out(spark, tmp_dir):
    from veilspark.streaming.progress import ProgressLog

    seen = ProgressLog(spark, f"{tmp_dir}/p").attach()
    seen.follow("a run that never was")
    q = spark.readStream.format("rate").load().writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    seen.detach(wait=False)
    assert not seen.rows and seen.totals() == {} and not os.path.exists(f"{tmp_dir}/p")


def test_stream_hashes_under_the_key_of_the_batch(spark, tmp_dir):
    inp, out, ck, keys, pol = (f"{tmp_dir}/{n}" for n in ("in", "out", "ck", "keys", "policy.json"))
    os.makedirs(inp)
    policy = {"fields": [{"name": "mail", "type": "string", "isPII": True, "piiOperation": "hash"}]}
    write(pol, json.dumps(policy))
    K.add_key(spark, keys, "k1", SECRETS["k1"], JAN)
    mon = PolicyMonitor(spark, pol)
    for i in (1, 2):
        write(f"{inp}/{i}.json", json.dumps({"id": i, "mail": "a@b.example"}) + "\n")
        job = ProtectStream(spark, mon, out, keys_path=keys)
        job.run(read_json_text_stream(spark, inp), ck)
        K.add_key(spark, keys, "k2", SECRETS["k2"], JAN.replace(year=2025))
    got = outputs(out)
    hashed = spark.createDataFrame([(b, got[b][0]["mail"], "a@b.example") for b in (0, 1)], "b int, h string, t string")
    assert [r.h[:3] for r in hashed.orderBy("b").collect()] == ["k1:", "k2:"]
    assert [r.verified for r in K.verify(hashed, "h", "t", spark.read.parquet(keys)).collect()] == [True, True]
    with pytest.raises(ValueError, match="either"):
        ProtectStream(spark, mon, out, keys_path=keys, hash_key="k")

    none = f"{tmp_dir}/none"
    K.add_key(spark, none, "k1", SECRETS["k1"], JAN, JAN.replace(month=2))
    write(f"{inp}/3.json", json.dumps({"id": 3, "mail": "a@b.example"}) + "\n")
    job = ProtectStream(spark, mon, out, quarantine_path=f"{tmp_dir}/bad", keys_path=none)
    job.run(read_json_text_stream(spark, inp), ck)
    assert job.metrics.last["counts"]["records_rejected"] == 1
    assert spark.read.json(f"{tmp_dir}/bad").first().reason == K.REASON_NO_KEY
