"""First-seen times, types and counts of record fields over a stream, kept as state.

Two queries.  The first counts (window, field, type) and appends closed windows to a table: a field that is in every record is one partial row a task
before it crosses the network.  The second streams that table and keeps a row of state per field, so its work grows
with fields and windows, not with records.  Both have their state and position under the checkpoint: a restart goes on with them and reports no
field as new twice.  (The engine takes no step with free state behind an aggregation in one query.)
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from veilspark.operators.drift import field_types
from veilspark.sources import storage
from veilspark.sources.files import write_batch

NEW_FIELD, NEW_TYPE, SEEN, GONE = "new_field", "new_type", "seen", "gone"

EVENT_SCHEMA = ("field STRING, event STRING, sql_type STRING, window_start TIMESTAMP, first_seen TIMESTAMP, last_seen TIMESTAMP, "
                "n_window BIGINT, n_total BIGINT")
STATE_SCHEMA = "first_seen TIMESTAMP, last_seen TIMESTAMP, last_ms BIGINT, totals STRING"


def windowed_types(df: DataFrame, ts: str, value_col: str = "value", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """``window, field, sql_type, n, first_seen, last_seen``: counts of each window, of a table or a stream.

    On a stream a window is given out once the watermark (latest time less ``delay``) has passed its end; later records of it are dropped and counted
    by the engine (``late_rows`` of the progress).  Records without a time are in no window."""
    timed = df.select(F.col(f"`{value_col}`").alias("value"), F.col(f"`{ts}`").cast("timestamp").alias("at")).where("at is not null")
    timed = timed.withWatermark("at", delay)
    each = field_types(timed, "value", keep=["at"])
    return (each.groupBy(F.window("at", width).alias("window"), "field", "sql_type")
            .agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first_seen"), F.max("at").alias("last_seen")))


WINDOW_SCHEMA = "window_start TIMESTAMP, window_end TIMESTAMP, field STRING, sql_type STRING, n BIGINT, first_seen TIMESTAMP, last_seen TIMESTAMP"


def field_events(windows: DataFrame, forget: str | None = None) -> DataFrame:
    """A row for each row of ``windows`` (``WINDOW_SCHEMA``, a stream in the order in which windows close): ``event`` is ``new_field`` for the field's first
    row ever, ``new_type`` for the first row of a further type, else ``seen``; ``n_total`` counts the type over all windows so far, ``first_seen``
    and ``last_seen`` are the field's up to here.

    Rows of a field come by window, inside it by the first time of each type, then by its name.  With ``forget``, a field without a record for so long (event
    time) gives a row ``gone`` (``n_total``: all its values) and its state is dropped, which bounds the state where field names are data; should it come
    back it is new again.  Without, a field's state stays for good."""
    if forget:
        windows = windows.withWatermark("window_end", "0 seconds")
    rows = windows.select("field", F.struct("sql_type", "n", "first_seen", "last_seen", "window_start", F.unix_millis("first_seen").alias("first_ms"),
                                            F.unix_millis("last_seen").alias("last_ms")).alias("row"), "window_end")
    forget_ms = int(pd.Timedelta(forget).total_seconds() * 1000) if forget else None

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, last_ms, totals = state.get if state.exists else (None, None, None, "{}")
        totals = json.loads(totals)
        left = lambda: (key[0], GONE, None, None, first, last, 0, sum(totals.values()))
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame([left()], columns=names)
            return
        found = sorted((r for p in parts for r in p["row"]), key=lambda r: (r["window_start"], r["first_seen"], r["sql_type"]))
        out = []
        for r in found:
            kind = r["sql_type"]
            # the same events however windows fall into batches
            if totals and forget_ms is not None and r["first_ms"] - last_ms > forget_ms:
                out.append(left())
                first, last, last_ms, totals = None, None, None, {}
            event = NEW_FIELD if not totals else SEEN if kind in totals else NEW_TYPE
            totals[kind] = totals.get(kind, 0) + int(r["n"])
            first = r["first_seen"] if first is None else min(first, r["first_seen"])
            last = r["last_seen"] if last is None else max(last, r["last_seen"])
            last_ms = max(last_ms or 0, int(r["last_ms"]))
            out.append((key[0], event, kind, r["window_start"], first, last, int(r["n"]), totals[kind]))
        state.update((first, last, last_ms, json.dumps(totals)))
        if forget_ms is not None:
            state.setTimeoutTimestamp(max(last_ms + forget_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame(out, columns=names)

    names = [c.strip().split(" ")[0] for c in EVENT_SCHEMA.split(",")]
    timeout = GroupStateTimeout.EventTimeTimeout if forget else GroupStateTimeout.NoTimeout
    return rows.groupBy("field").applyInPandasWithState(step, EVENT_SCHEMA, STATE_SCHEMA, "append", timeout)


class FieldWatch:
    """The report as a pair of queries: closed windows under ``path/windows``, events under ``path/events/batch=<id>``, overwritten when
    a batch is replayed."""

    def __init__(self, spark: SparkSession, path: str, ts: str, value_col: str = "value", width: str = "1 day", delay: str = "1 hour", forget: str | None = None):
        self.spark, self.path, self.forget = spark, path.rstrip("/"), forget
        self.settings = {"ts": ts, "value_col": value_col, "width": width, "delay": delay}

    def start_windows(self, source: DataFrame, checkpoint: str, trigger: dict | None = None):
        counts = windowed_types(source, **self.settings)
        flat = counts.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "field", "sql_type", "n", "first_seen", "last_seen")
        w = flat.writeStream.outputMode("append").format("parquet").option("path", f"{self.path}/windows")
        return w.option("checkpointLocation", f"{checkpoint.rstrip('/')}/windows").trigger(**(trigger or {"availableNow": True})).start()

    def start_events(self, checkpoint: str, trigger: dict | None = None):
        # the folder may not be there before the first window is written
        storage.make_folder(self.spark, f"{self.path}/windows")
        windows = self.spark.readStream.schema(WINDOW_SCHEMA).parquet(f"{self.path}/windows")
        w = field_events(windows, self.forget).writeStream.outputMode("append").option("checkpointLocation", f"{checkpoint.rstrip('/')}/events")
        return w.foreachBatch(self._write).trigger(**(trigger or {"availableNow": True})).start()

    def run(self, source: DataFrame, checkpoint: str) -> None:
        """Read what is there and stop; the next run goes on."""
        self.start_windows(source, checkpoint).awaitTermination()
        self.start_events(checkpoint).awaitTermination()

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        write_batch(rows, f"{self.path}/events", batch_id, fmt="parquet")

    def events(self) -> DataFrame:
        """All events so far."""
        storage.make_folder(self.spark, f"{self.path}/events")
        return self.spark.read.schema(EVENT_SCHEMA).parquet(f"{self.path}/events")
