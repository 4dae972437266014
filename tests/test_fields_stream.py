"""The stateful report of a stream's fields: windows, first-seen once, restarts, types that come later, fields that go."""

import datetime as dt
import json
import os
from collections import Counter

from pyspark.sql import functions as F

from test_streaming import write
from veilspark.operators.drift import type_profile
from veilspark.streaming.fields import GONE, NEW_FIELD, NEW_TYPE, SEEN, FieldWatch, windowed_types
from veilspark.streaming.progress import ProgressLog

T0 = dt.datetime(2024, 1, 1)


def line(hours, **fields):
    return json.dumps({"id": 1, "at": (T0 + dt.timedelta(hours=hours)).isoformat()} | fields) + "\n"


def source(spark, path):
    text = spark.readStream.format("text").load(path)
    return text.select("value", F.get_json_object("value", "$.at").cast("timestamp").alias("ts"))


def run(spark, tmp_dir, name, text, **kw):
    """One run of the report that finds one more file."""
    os.makedirs(f"{tmp_dir}/in", exist_ok=True)
    write(f"{tmp_dir}/in/{name}", text)
    watch = FieldWatch(spark, f"{tmp_dir}/out", "ts", **kw)
    seen = ProgressLog(spark).attach()
    q = watch.start_windows(source(spark, f"{tmp_dir}/in"), f"{tmp_dir}/ck")
    seen.follow(str(q.runId))
    q.awaitTermination()
    seen.detach()
    watch.start_events(f"{tmp_dir}/ck").awaitTermination()
    return watch.events(), seen.totals()


def test_first_seen_is_given_once_over_restarts(spark, tmp_dir):
    a = line(1, x=1) + line(2, x=2, y="t") + line(30, x=3) + "not json\n" + '{"id":1,"x":1}\n'
    events, _ = run(spark, tmp_dir, "a", a)
    # the first day is over, the second isn't
    got = {(r.field, r.event, r.sql_type, r.window_start.day, r.n_window, r.n_total) for r in events.where("field in ('x','y')").collect()}
    assert got == {("x", NEW_FIELD, "INT", 1, 2, 2), ("y", NEW_FIELD, "STRING", 1, 1, 1)}

    b = line(31, x=2.5) + line(32, x=4, z=True) + line(80, x=5) + line(3, late=1, x=1)
    events, totals = run(spark, tmp_dir, "b", b)
    got = {(r.field, r.event, r.sql_type, r.window_start.day, r.n_window, r.n_total) for r in events.where("field in ('x','y','z','late')").collect()}
    assert got == {("x", NEW_FIELD, "INT", 1, 2, 2), ("y", NEW_FIELD, "STRING", 1, 1, 1),
                   ("x", SEEN, "INT", 2, 2, 4), ("x", NEW_TYPE, "DOUBLE", 2, 1, 1), ("z", NEW_FIELD, "BOOLEAN", 2, 1, 1)}
    assert totals["late_rows"] > 0  # the late record's fields
    x = events.where("field = 'x'").orderBy("last_seen").collect()
    assert {r.first_seen for r in x} == {T0 + dt.timedelta(hours=1)} and x[-1].last_seen == T0 + dt.timedelta(hours=32)
    once = events.where(f"event = '{NEW_FIELD}'").groupBy("field").count().collect()
    assert all(r["count"] == 1 for r in once) and len(once) == 4  # at, x, y, z

    # nothing new: no event is repeated
    before = events.count()
    events, _ = run(spark, tmp_dir, "c", "")
    assert events.count() == before


def test_forgotten_fields_leave_and_come_back_as_new(spark, tmp_dir):
    kw = {"width": "1 hour", "delay": "10 minutes", "forget": "1 day"}
    run(spark, tmp_dir, "a", line(0, x=1, y=1) + line(5, x=1), **kw)
    run(spark, tmp_dir, "b", line(20, x=1) + line(40, x=1), **kw)
    run(spark, tmp_dir, "c", line(41, y=1) + line(43, x=1), **kw)
    events, _ = run(spark, tmp_dir, "d", line(60, x=1), **kw)
    y = [(r.event, r.n_total) for r in events.where("field = 'y'").collect()]
    assert Counter(y) == Counter({(NEW_FIELD, 1): 2, (GONE, 1): 1})
    x = [(r.event, r.n_total) for r in events.where("field = 'x'").collect()]
    assert (NEW_FIELD, 1) in x and (GONE, 1) not in x and max(n for _, n in x) == 5


def test_windows_of_a_table_add_up_to_its_profile(spark):
    rows = [(line(h, x=h, **({"y": "t"} if h % 3 else {"y": None})), T0 + dt.timedelta(hours=h)) for h in range(60)] + [("[]", T0), (None, T0), (line(1, w=1), None)]
    t = spark.createDataFrame(rows, "value string, ts timestamp")
    windows = windowed_types(t, "ts")
    want = {(r.field, r.sql_type, r.n_values) for r in type_profile(t.where("ts is not null")).collect()}
    assert {tuple(r) for r in windows.groupBy("field", "sql_type").agg(F.sum("n")).collect()} == want
    assert windows.select("window").distinct().count() == 3
