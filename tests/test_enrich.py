import json
import os

from pyspark.sql import functions as F

from veilspark.operators import lake
from veilspark.sources.files import read_json_text_stream
from veilspark.streaming.enrich import EnrichStream, enrich_frame


def write(path, lines):
    with open(path, "w") as fh:
        fh.write("\n".join(json.dumps(x) for x in lines) + "\n")


def test_enrich_frame_types_and_time_columns(spark):
    df = spark.createDataFrame([(json.dumps(d),) for d in [
        {"id": "1", "n": 5, "d": 1.5, "s": "x", "o": {"k": [1, 2]}, "m": 1, "day": "2024-01-02"},
        {"id": "2", "n": 6, "d": 2, "s": None, "m": "t", "day": "2024-01-03"}]], "value string")
    out = enrich_frame(df, event_time_field="day", event_time_format="yyyy-MM-dd")
    types = {f.name: f.dataType.simpleString() for f in out.schema.fields}
    assert {k: types[k] for k in ("id", "n", "d", "s", "o", "m")} == {
        "id": "string", "n": "bigint", "d": "double", "s": "string", "o": "string", "m": "string"}
    rows = {r.id: r for r in out.collect()}
    assert rows["1"].o == '{"k":[1,2]}' and rows["2"].m == "t" and rows["1"].m == "1"
    assert str(rows["2"].event_date_prt) == "2024-01-03"


def test_enrich_stream_upserts_and_evolves(spark, tmp_dir):
    inp, table, ck = f"{tmp_dir}/in", f"{tmp_dir}/table", f"{tmp_dir}/ck"
    os.makedirs(inp)
    write(f"{inp}/a.json", [{"id": "u1", "v": 1, "day": "2024-01-01 10:00:00"},
                            {"id": "u2", "v": 2, "day": "2024-01-01 11:00:00"}])
    job = EnrichStream(spark, table, event_time_field="day")
    job.start(read_json_text_stream(spark, inp), ck, {"availableNow": True}).awaitTermination()
    write(f"{inp}/b.json", [{"id": "u1", "v": 10, "day": "2024-01-02 09:00:00", "tier": "gold"},
                            {"id": "u3", "v": "3", "day": "2024-01-02 09:30:00"}])
    job.start(read_json_text_stream(spark, inp), ck, {"availableNow": True}).awaitTermination()
    got = {r.id: (r.v, r.tier, str(r.event_date_prt)) for r in lake.read_table(spark, table).collect()}
    assert got == {"u1": ("10", "gold", "2024-01-02"), "u2": ("2", None, "2024-01-01"), "u3": ("3", None, "2024-01-02")}
    assert [m["counts"]["records_applied"] for m in job.metrics.rows] == [2, 2]


def test_cli_runs_the_protect_then_enrich_jobs(spark, tmp_dir, capsys):
    from policies import M1, M2, MEMBER_POLICY

    from veilspark.streaming.cli import main

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/in/a.json", "w") as fh:
        fh.write(M1 + "\n" + M2 + "\n")
    with open(f"{tmp_dir}/p.json", "w") as fh:
        json.dump(MEMBER_POLICY, fh)
    assert main([f"schema-path={tmp_dir}/p.json", f"input-path={tmp_dir}/in", f"output-path={tmp_dir}/out",
                 f"checkpoint.dir={tmp_dir}/ck1", "execution.mode=batch"]) == 0
    assert main([f"table-path={tmp_dir}/table", f"input-path={tmp_dir}/out/batch=0", f"checkpoint.dir={tmp_dir}/ck2",
                 "event-time-field=since", "execution.mode=batch"]) == 0
    rows = {r.id: r for r in lake.read_table(spark, f"{tmp_dir}/table").collect()}
    assert set(rows) == {"m-7", "m-9"} and rows["m-7"].alias == "Qu*****"
    assert str(rows["m-9"].event_date_prt) == "2022-11-30" and rows["m-7"].shelf == "B12"


def table_after(spark, tmp_dir, batches, **kw):
    job = EnrichStream(spark, f"{tmp_dir}/table", event_time_field="day", event_time_format="yyyy-MM-dd", **kw)
    for i, lines in enumerate(batches):
        job.process(spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string"), i)
    return job, {r.id: r for r in lake.read_table(spark, f"{tmp_dir}/table").collect()}


def test_batches_are_not_held_in_memory(spark, tmp_dir, monkeypatch):
    """While a batch is merged, what is kept of it lies on disk."""
    held, merge = [], lake.merge_evolving

    def watched(*args):
        merge(*args)
        held.append([(i.memSize(), i.diskSize()) for i in spark.sparkContext._jsc.sc().getRDDStorageInfo() if i.isCached()])
        return []

    monkeypatch.setattr(lake, "merge_evolving", watched)
    spark.catalog.clearCache()
    lines = spark.range(500).selectExpr("concat('{\"id\":', id, ',\"u', id, '\":1}') as value")
    EnrichStream(spark, f"{tmp_dir}/table", max_fields=2).process(lines, 0)
    assert len(held[0]) >= 2 and all(memory == 0 and disk > 0 for memory, disk in held[0])


def test_rows_without_a_day_survive_a_merge(spark, tmp_dir):
    _, rows = table_after(spark, tmp_dir, [[{"id": "a", "day": "2024-01-01"}, {"id": "b"}], [{"id": "c"}, {"id": "a", "day": "2024-01-02"}]])
    assert {k: str(r.event_date_prt) for k, r in rows.items()} == {"a": "2024-01-02", "b": "None", "c": "None"}


def test_changed_types_widen_without_loss(spark, tmp_dir):
    _, rows = table_after(spark, tmp_dir, [
        [{"id": "a", "day": "2024-01-01", "n": 1, "m": 7}], [{"id": "b", "day": "2024-01-02", "n": 2.75, "m": 8}],
        [{"id": "c", "day": "2024-01-03", "n": 3, "m": "abc"}], [{"id": "d", "day": "2024-01-01", "n": 4, "m": 9}]])
    assert {k: (r.n, r.m) for k, r in rows.items()} == {"a": (1.0, "7"), "b": (2.75, "8"), "c": (3.0, "abc"), "d": (4.0, "9")}


def test_bad_records_do_not_stop_the_stream(spark, tmp_dir):
    job, rows = table_after(spark, tmp_dir, [
        ["{broken", "also broken"],                                             # only malformed lines
        [{"id": "a", "day": "n/a"}, {"id": "b", "day": "2024-01-01"}, "{oops"],  # text that is no day
        [{"id": "c", "Name": "x"}, {"id": "d", "name": "y"}, {"other": 1}],      # no day at all, names that differ in case
    ], quarantine_path=f"{tmp_dir}/bad")
    assert {k: str(r.event_date_prt) for k, r in rows.items()} == {"a": "None", "b": "2024-01-01", "c": "None", "d": "None"}
    assert {rows["c"]["Name"], rows["d"]["name__2"]} == {"x", "y"}
    assert [m["counts"]["records_rejected"] for m in job.metrics.rows] == [2, 1, 1]
    bad = spark.read.json(f"{tmp_dir}/bad")
    assert sorted(r.reason for r in bad.collect()) == ["missing_key", "parse_error", "parse_error", "parse_error"]


def test_second_run_goes_on_where_the_first_ended(spark, tmp_dir, capsys):
    """Without checkpoint.dir: only new input is read and the first output stays."""
    import pytest

    from policies import M1, M2, MEMBER_POLICY
    from veilspark.streaming.cli import main

    os.makedirs(f"{tmp_dir}/in")
    with open(f"{tmp_dir}/p.json", "w") as fh:
        json.dump(MEMBER_POLICY, fh)
    args = [f"schema-path={tmp_dir}/p.json", f"input-path={tmp_dir}/in", f"output-path={tmp_dir}/out", "execution.mode=batch"]
    for name, record in (("a", M1), ("b", M2)):
        with open(f"{tmp_dir}/in/{name}.json", "w") as fh:
            fh.write(record + "\n")
        assert main(args) == 0
        assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])["counts"]["records_in"] == 1
    assert sorted(json.loads(r.value)["id"] for r in spark.read.text(f"{tmp_dir}/out").collect()) == ["m-7", "m-9"]
    with pytest.raises(ValueError, match="another run"):
        main([*args, f"checkpoint.dir={tmp_dir}/elsewhere"])
