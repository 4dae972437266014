"""Merges: key locator, interrupted runs, partition strategies, fields and types that change."""

import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from veilspark.operators import lake, locator
from veilspark.sources import storage
from veilspark.streaming.enrich import OTHERS, EnrichStream, field_text, fields_map


def rows(spark, data):
    """Rows (key, time, value) with time columns but the processing time."""
    df = spark.createDataFrame(data, "k int, ts string, v string").withColumn("ts", F.col("ts").cast("timestamp"))
    return lake.add_time_columns(df, "ts").drop(lake.PROCESSING_TS)


def held(spark, path):
    return {r.k: (r.v, str(r.event_date_prt)) for r in lake.read_table(spark, path).collect()}


def test_merge_reads_only_the_buckets_of_its_keys(spark, tmp_dir):
    """Key columns of other days and entries of other buckets may be unreadable: the merge doesn't open them."""
    path = f"{tmp_dir}/t"
    lake.merge_into(spark, path, rows(spark, [(i, f"2024-01-{1 + i % 9:02d} 00:00:00", "a") for i in range(200)]), "k", "ts")
    lake.merge_into(spark, path, rows(spark, [(1000, "2024-02-01 00:00:00", "a")]), "k", "ts")  # makes the locator
    loc = locator.KeyLocator.load(spark, path)
    key = spark.createDataFrame([(7,)], "k int")
    bucket = key.select(loc.bucket().alias("b")).first()["b"]
    plan = loc.locate(key)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and f"bucket#" in plan
    spoilt = [f for f in glob.glob(f"{path}/_keys/entries/version=*/bucket=*/*.parquet") if f"bucket={bucket}/" not in f]
    spoilt += [f for f in glob.glob(f"{path}/event_date_prt=*/*.parquet") if "2024-01-08" not in f]
    assert len(spoilt) > 10
    for f in spoilt:
        shutil.move(f, f + ".kept")
        with open(f, "w") as fh:
            fh.write("not a table")
    crc = glob.glob(f"{path}/**/.*.crc", recursive=True)
    assert lake.merge_into(spark, path, rows(spark, [(7, "2024-03-01 00:00:00", "b")]), "k", "ts") == []
    assert crc
    for f in spoilt:
        shutil.move(f + ".kept", f)
    got = held(spark, path)
    assert got[7] == ("b", "2024-03-01") and len(got) == 201


@pytest.mark.parametrize("versions", [64, 2])
def test_locator_follows_keys_through_many_merges(spark, tmp_dir, monkeypatch, versions):
    monkeypatch.setattr(locator, "MOST_VERSIONS", versions)
    path, want = f"{tmp_dir}/t", {}
    for b in range(4):
        batch = [(k, f"2024-0{1 + b}-{1 + k * (b + 1) % 20:02d} 00:00:00", f"{b}.{k}") for k in range(b * 3, 12 + b)]
        lake.merge_into(spark, path, rows(spark, batch), "k", "ts")
        want |= {k: (v, t[:10]) for k, t, v in batch}
    assert held(spark, path) == want
    assert lake.read_table(spark, path).count() == len(want)  # no key is left behind in an old day
    loc = locator.KeyLocator.load(spark, path)
    assert loc.maybe_known(spark.createDataFrame([(10 ** 6,)], "k int")) == []
    keys = spark.createDataFrame([(k,) for k in want], "k int")
    assert {r.k: str(r.day) for r in loc.locate(keys).collect()} == {k: d for k, (_, d) in want.items()}
    assert (loc.meta["first"] > 0) == (versions == 2)


def test_merge_without_the_locator_and_back(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    lake.merge_into(spark, path, rows(spark, [(1, "2024-01-01 00:00:00", "a")]), "k", "ts")
    lake.merge_into(spark, path, rows(spark, [(2, "2024-01-01 00:00:00", "a")]), "k", "ts")
    lake.merge_into(spark, path, rows(spark, [(3, "2024-01-05 00:00:00", "a")]), "k", "ts", keys_can_move=False)
    lake.merge_into(spark, path, rows(spark, [(3, "2024-01-06 00:00:00", "b")]), "k", "ts")
    assert held(spark, path) == {1: ("a", "2024-01-01"), 2: ("a", "2024-01-01"), 3: ("b", "2024-01-06")}


class Killed(Exception):
    pass


STEPS = ["stage", "announce", "write_daily", "delete_emptied", "save_schema", "append", "unannounce"]


@pytest.mark.parametrize("step", STEPS)
def test_interrupted_merge_leaves_the_old_or_the_new_table(spark, tmp_dir, monkeypatch, step):
    path = f"{tmp_dir}/t"
    lake.merge_into(spark, path, rows(spark, [(1, "2024-01-01 00:00:00", "a"), (2, "2024-01-02 00:00:00", "a")]), "k", "ts")
    lake.merge_into(spark, path, rows(spark, [(3, "2024-01-02 00:00:00", "a")]), "k", "ts")
    old = held(spark, path)
    new = {**old, 1: ("b", "2024-01-03"), 4: ("b", "2024-01-02")}

    def kill(*a, **k):
        raise Killed(step)

    with monkeypatch.context() as m:
        if step == "stage":
            m.setattr(lake, "rebalance_days", kill)
        elif step == "announce":
            m.setattr(storage, "write_text", kill)
        elif step in ("write_daily", "save_schema"):
            m.setattr(lake, step, kill)
        elif step == "append":
            m.setattr(locator.KeyLocator, "append", kill)
        else:
            real = storage.delete

            def delete(spark, paths):
                if any((step == "delete_emptied") if "event_date_prt=" in p else (step == "unannounce") and p.endswith(lake.INTENT) for p in paths):
                    raise Killed(step)
                real(spark, paths)
            m.setattr(storage, "delete", delete)
        with pytest.raises(Killed):
            lake.merge_into(spark, path, rows(spark, [(1, "2024-01-03 00:00:00", "b"), (4, "2024-01-02 00:00:00", "b")]), "k", "ts")
    assert held(spark, path) == (old if step in ("stage", "announce") else new)
    lake.merge_into(spark, path, rows(spark, [(1, "2024-01-04 00:00:00", "c"), (4, "2024-01-04 00:00:00", "c")]), "k", "ts")
    done = held(spark, path)
    assert done[1] == ("c", "2024-01-04") and done[4] == ("c", "2024-01-04") and lake.read_table(spark, path).count() == len(done)
    assert not os.path.exists(f"{path}/{lake.INTENT}") and not os.path.exists(f"{path}/{lake.STAGING}")


def test_partition_strategies(spark, tmp_dir):
    df = spark.createDataFrame([(1, "2024-01-01 10:30:00"), (2, "2024-01-01 11:00:00"), (3, None)], "k int, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    for name, want in (("hour", {"2024-01-01-10", "2024-01-01-11", None}), ("month", {"2024-01", None})):
        path = f"{tmp_dir}/{name}"
        lake.merge_into(spark, path, lake.add_time_columns(df, "ts", name), "k", "ts")
        assert {r[0] for r in lake.read_table(spark, path).select(lake.PARTITION_COL).collect()} == want
    lake.register_partitioning("year", lambda event, now: F.year(event))
    assert {r[0] for r in lake.add_time_columns(df, "ts", "year").select(lake.PARTITION_COL).collect()} == {2024, None}
    path = f"{tmp_dir}/bucket"
    lake.merge_into(spark, path, lake.add_time_columns(df, "ts", "bucket:4", "k"), "k", "ts")
    plan = lake.read_table(spark, path).where(F.col(lake.PARTITION_COL) == 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date_prt" in plan
    with pytest.raises(ValueError, match="unknown partition strategy"):
        lake.partitioning("weekly")
    with pytest.raises(ValueError, match="bucket"):
        lake.partitioning("bucket:0", "k")


def test_rows_without_a_key_stay(spark, tmp_dir):
    data = [(None, "2024-01-01 00:00:00", "a"), (None, "2024-01-01 00:00:00", "a"), (1, "2024-01-01 00:00:00", "a")]
    lake.merge_into(spark, f"{tmp_dir}/t", rows(spark, data), "k", "ts")
    lake.merge_into(spark, f"{tmp_dir}/t", rows(spark, [(None, "2024-01-01 00:00:00", "b"), (1, "2024-01-02 00:00:00", "b")]), "k", "ts")
    got = sorted((r.k or 0, r.v) for r in lake.read_table(spark, f"{tmp_dir}/t").collect())
    assert got == [(0, "a"), (0, "a"), (0, "b"), (1, "b")]


def test_own_time_columns_are_kept(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "mine", "also", "x")], "ts string, event_date string, event_date_prt string, event_date__2 string")
    out = lake.add_time_columns(df.withColumn("ts", F.col("ts").cast("timestamp")), "ts")
    r = out.first()
    assert (r["event_date__3"], r["event_date_prt__2"], r["event_date__2"], str(r["event_date"])[:10]) == ("mine", "also", "x", "2024-01-01")


def enriched(spark, path, batches, **kw):
    job = EnrichStream(spark, path, event_time_field="day", event_time_format="yyyy-MM-dd", **kw)
    for i, lines in enumerate(batches):
        job.process(spark.createDataFrame([(json.dumps(x),) for x in lines], "value string"), i)
    return lake.read_table(spark, path)


def test_fields_keep_their_columns(spark, tmp_dir):
    t = enriched(spark, f"{tmp_dir}/t", [[{"id": "a", "Name": "A", "name": "x", "event_date": "own"}], [{"id": "b", "name": "y"}], [{"id": "c", "NAME": "z"}]])
    got = {r.id: (r["Name"], r["name__2"], r["NAME__3"], r["event_date__2"]) for r in t.collect()}
    assert got == {"a": ("A", "x", None, "own"), "b": (None, "y", None, None), "c": (None, None, "z", None)}
    assert lake.field_columns(t.schema)["name"] == "name__2"


def test_whole_numbers_keep_their_digits(spark, tmp_dir):
    big = 9007199254740993
    t = enriched(spark, f"{tmp_dir}/t", [
        [{"id": "a", "later": big, "small": 5, "both": big}, {"id": "b", "both": 2.5}],
        [{"id": "c", "later": 2.5, "small": 2.5}], [{"id": "d", "small": big}]])
    got = {r.id: (r.later, r.small, r.both) for r in t.collect()}
    assert got == {"a": (str(big), "5.0", str(big)), "b": (None, None, "2.5"), "c": ("2.5", "2.5", None), "d": (None, str(big), None)}


def test_open_fields_share_a_map(spark, tmp_dir):
    first = [{"id": str(i), "kind": "k", f"u{i}": {"n": i}, "day": "2024-01-01"} for i in range(60)]
    second = [{"id": str(i), "kind": "k", "u7": i, "day": "2024-01-02"} for i in range(60, 160)]
    t = enriched(spark, f"{tmp_dir}/t", [first, second], max_fields=4)
    columns = lake.field_columns(t.schema)
    assert len(columns) <= 4 and {"id", "kind", "day"} <= set(columns) and OTHERS in t.columns
    got = {r.id: (r.seven, r.m) for r in t.select("id", field_text(t, "u7").alias("seven"), fields_map(t).alias("m")).collect()}
    assert got["7"][0] == '{"n":7}' and got["100"][0] == "100" and got["8"][0] is None
    assert got["8"][1] == {"id": "8", "kind": "k", "day": "2024-01-01", "u8": '{"n":8}'}
    assert got["100"][1] == {"id": "100", "kind": "k", "day": "2024-01-02", "u7": "100"}


def test_documented_command_runs_twice(spark, tmp_dir, capsys):
    """As in the README, without a checkpoint folder; the second run reads only new input."""
    from veilspark.streaming.cli import main

    os.makedirs(f"{tmp_dir}/in")
    args = [f"table-path={tmp_dir}/table", f"input-path={tmp_dir}/in", "key=id", "event-time-field=createdAt", "execution.mode=batch"]
    for name, record in (("a", {"id": "1", "v": 1, "createdAt": "2024-01-01 10:00:00"}), ("b", {"id": "1", "v": 2.5, "createdAt": "2024-01-02 10:00:00"})):
        with open(f"{tmp_dir}/in/{name}.json", "w") as fh:
            fh.write(json.dumps(record) + "\n")
        assert main(args) == 0
    t = lake.read_table(spark, f"{tmp_dir}/table")
    assert [(r.id, r.v, str(r.event_date_prt)) for r in t.collect()] == [("1", 2.5, "2024-01-02")]


def test_types_from_the_policy(spark, tmp_dir):
    from veilspark.policy import Policy

    policy = Policy.from_dict({"fields": [{"name": "n", "isPII": True, "type": "integer", "piiOperation": "generalize", "ranges": [0, 10]}, {"name": "p"}, {"name": "never"}]})
    t = enriched(spark, f"{tmp_dir}/t", [[{"id": "a", "n": "0-10", "p": 3}]], policy=policy)
    types = {f.name: f.dataType.simpleString() for f in t.schema.fields}
    assert (types["n"], types["p"], types["never"], types["day"]) == ("string", "bigint", "string", "string")


def test_many_keys_are_not_collected_to_be_sent(spark, tmp_dir, monkeypatch):
    """Keys of a cached batch, whose size Spark takes for small: beyond ``FEW_KEYS`` no plan of the merge broadcasts them."""
    path = f"{tmp_dir}/t"
    lake.merge_into(spark, path, rows(spark, [(i, "2024-01-01 00:00:00", "a") for i in range(300)]), "k", "ts")
    lake.merge_into(spark, path, rows(spark, [(1000, "2024-02-01 00:00:00", "a")]), "k", "ts")  # makes the locator
    loc = locator.KeyLocator.load(spark, path)
    batch = rows(spark, [(i, "2024-01-02 00:00:00", "b") for i in range(100, 400)]).persist()
    batch.count()
    keys = batch.select("k").distinct()
    plan = lambda: loc.locate(keys)._jdf.queryExecution().executedPlan().toString()
    want = {(i, "2024-01-01") for i in range(100, 300)}
    assert "BroadcastExchange" in plan() and {(r.k, str(r.day)) for r in loc.locate(keys).collect()} == want
    asked = []
    monkeypatch.setattr(locator, "counted", lambda k, n, counted=locator.counted: asked.append(n) or counted(k, n))
    monkeypatch.setattr(locator, "FEW_KEYS", 250)
    assert "BroadcastExchange" not in plan() and asked == [4 * 300, 300]
    assert {(r.k, str(r.day)) for r in loc.locate(keys).collect()} == want
    lake.merge_into(spark, path, batch, "k", "ts")
    batch.unpersist()
    got = held(spark, path)
    assert len(got) == 401 and got[99] == ("a", "2024-01-01") and {got[i] for i in range(100, 400)} == {("b", "2024-01-02")}
