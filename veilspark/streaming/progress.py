"""What the engine reports of a running query: a row for its start, each batch, and its end.

The rows come from a ``StreamingQueryListener``: rates, the phases of a trigger, offsets and how far they lie behind, the watermark,
state and late rows, and why a query failed.  They are small (one row a trigger), kept in bounded number on the
driver and, with a path, appended to a folder of JSON lines.
"""

from __future__ import annotations

import json
import logging
import threading
import uuid
from collections import deque

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from veilspark.sources import storage

log = logging.getLogger(__name__)

STARTED, PROGRESS, IDLE, FINISHED, FAILED = "started", "progress", "idle", "finished", "failed"

PROGRESS_SCHEMA = ("event STRING, query_id STRING, run_id STRING, name STRING, at STRING, batch_id BIGINT, input_rows BIGINT, input_rate DOUBLE, "
                   "processed_rate DOUBLE, phases_ms MAP<STRING,BIGINT>, watermark STRING, state_rows BIGINT, state_bytes BIGINT, late_rows BIGINT, "
                   "sources ARRAY<STRUCT<source:STRING,start:STRING,finish:STRING,latest:STRING,input_rows:BIGINT,behind:DOUBLE>>, error STRING")


def _sum_offsets(text: str | None) -> float | None:
    """The sum of all positions in an offset: a number, or positions by topic and partition."""
    try:
        value = json.loads(text) if text else None
    except ValueError:
        return None
    todo, total, found = [value], 0.0, False
    while todo:
        v = todo.pop()
        if isinstance(v, dict):
            todo.extend(v.values())
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            total, found = total + v, True
    return total if found else None


def behind(finish: str | None, latest: str | None, metrics: dict | None = None) -> float | None:
    """How many positions a source has that were not read: the difference of its offsets, else what it reports of
    its slowest partition; None where unknown."""
    a, b = _sum_offsets(finish), _sum_offsets(latest)
    if a is not None and b is not None:
        return max(0.0, b - a)
    most = (metrics or {}).get("maxOffsetsBehindLatest")
    return None if most is None else float(most)


def progress_row(p: dict) -> dict:
    """A row from the engine's progress report (its JSON form)."""
    ops = p.get("stateOperators") or []
    sources = [{"source": s.get("description"), "start": _text(s.get("startOffset")), "finish": _text(s.get("endOffset")), "latest": _text(s.get("latestOffset")),
                "input_rows": s.get("numInputRows"), "behind": behind(_text(s.get("endOffset")), _text(s.get("latestOffset")), s.get("metrics"))}
               for s in p.get("sources") or []]
    return {"event": PROGRESS, "query_id": p["id"], "run_id": p["runId"], "name": p.get("name"), "at": p.get("timestamp"), "batch_id": p.get("batchId"),
            "input_rows": p.get("numInputRows", sum(s["input_rows"] or 0 for s in sources)), "input_rate": _rate(p.get("inputRowsPerSecond")),
            "processed_rate": _rate(p.get("processedRowsPerSecond")), "phases_ms": p.get("durationMs") or {}, "watermark": (p.get("eventTime") or {}).get("watermark"),
            "state_rows": sum(o.get("numRowsTotal", 0) for o in ops), "state_bytes": sum(o.get("memoryUsedBytes", 0) for o in ops),
            "late_rows": sum(o.get("numRowsDroppedByWatermark", 0) for o in ops), "sources": sources, "error": None}


def _text(offset) -> str | None:
    return offset if offset is None or isinstance(offset, str) else json.dumps(offset, sort_keys=True)


def _rate(x) -> float | None:
    """A rate; an empty trigger has none (the engine writes it as no number)."""
    return float(x) if isinstance(x, (int, float)) and x == x and abs(x) != float("inf") else None


class ProgressLog(StreamingQueryListener):
    """Collects the rows of the session's queries, or after :meth:`follow` of one run.

    The last ``keep`` rows stay on the driver; sums cover all.  With ``path``, every ``every`` rows and the last ones are
    written as one file.  A row that can't be written is logged: the query goes on."""

    def __init__(self, spark: SparkSession, path: str | None = None, keep: int = 100, every: int = 10):
        self.spark, self.path, self.every = spark, path, every
        self.rows: deque[dict] = deque(maxlen=keep)
        self._open: list[dict] = []
        self._run: str | None = None
        self._sums: dict[str, dict] = {}
        self._ended: set[str] = set()
        self._change = threading.Condition()
        self._name, self._files, self._attached = uuid.uuid4().hex[:12], 0, False

    # -- registration ------------------------------------------------------
    def attach(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        self._attached = True
        return self

    def follow(self, run_id: str) -> None:
        """Keep only the rows of this run, also of those that came already."""
        with self._change:
            self._run = run_id
            kept = [r for r in self.rows if r["run_id"] == run_id]
            self.rows.clear()
            self.rows.extend(kept)
            self._open = [r for r in self._open if r["run_id"] == run_id]

    def detach(self, wait: bool = True, seconds: float = 20.0) -> None:
        """Stop listening; with ``wait`` only after the end of the followed run was reported, as reports come after the fact."""
        if not self._attached:
            return
        if wait and self._run:
            with self._change:
                self._change.wait_for(lambda: self._run in self._ended, timeout=seconds)
        self._attached = False
        self.spark.streams.removeListener(self)
        self.flush()

    # -- the engine's calls ------------------------------------------------
    def onQueryStarted(self, event) -> None:
        self._add(self._plain(STARTED, str(event.id), str(event.runId), event.timestamp, event.name))

    def onQueryProgress(self, event) -> None:
        self._add(progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:
        self._add(self._plain(IDLE, str(event.id), str(event.runId), event.timestamp))

    def onQueryTerminated(self, event) -> None:
        failed = event.exception
        self._add(self._plain(FAILED if failed else FINISHED, str(event.id), str(event.runId), None, error=failed.splitlines()[0] if failed else None))
        if self._run in (None, str(event.runId)):
            self.flush()
        with self._change:
            self._ended.add(str(event.runId))
            self._change.notify_all()

    # -- rows --------------------------------------------------------------
    @staticmethod
    def _plain(event: str, query_id: str, run_id: str, at: str | None, name: str | None = None, error: str | None = None) -> dict:
        empty = {"batch_id": None, "input_rows": None, "input_rate": None, "processed_rate": None, "phases_ms": None, "watermark": None,
                 "state_rows": None, "state_bytes": None, "late_rows": None, "sources": None}
        return {"event": event, "query_id": query_id, "run_id": run_id, "name": name, "at": at, **empty, "error": error}

    def _add(self, row: dict) -> None:
        with self._change:
            if self._run and row["run_id"] != self._run:
                return
            self.rows.append(row)
            sums = self._sums.setdefault(row["run_id"], {"triggers": 0, "input_rows": 0, "late_rows": 0, "trigger_ms": 0, "behind": None, "watermark": None, "error": None})
            if row["event"] == PROGRESS:
                sums["triggers"] += 1
                sums["input_rows"] += row["input_rows"] or 0
                sums["late_rows"] += row["late_rows"] or 0
                sums["trigger_ms"] += row["phases_ms"].get("triggerExecution", 0)
                known = [s["behind"] for s in row["sources"] if s["behind"] is not None]
                sums["behind"] = sum(known) if known else None
                sums["watermark"] = row["watermark"] or sums["watermark"]
            sums["error"] = row["error"] or sums["error"]
            if self.path:
                self._open.append(row)
            full = self.path is not None and self._run is not None and len(self._open) >= self.every
        if full:
            self.flush()

    def totals(self) -> dict:
        """Sums of the followed run, or of all runs by run id: triggers, rows read, late rows, milliseconds, last lag and watermark, error."""
        with self._change:
            return dict(self._sums.get(self._run, {})) if self._run else {k: dict(v) for k, v in self._sums.items()}

    def flush(self) -> None:
        """Write the rows that wait to be written."""
        with self._change:
            rows, self._open = self._open, []
            self._files += bool(rows)
            file = f"{self._name}-{self._files:06d}.json"
        if not rows or not self.path:
            return
        try:
            storage.write_text(self.spark, f"{self.path.rstrip('/')}/{file}", "".join(json.dumps(r) + "\n" for r in rows))
        except Exception as exc:  # the report of a query must not end it
            log.warning("progress rows were not written to %s: %s", self.path, exc)


def progress_frame(spark: SparkSession, path: str) -> DataFrame:
    """All rows in a folder of progress rows."""
    return spark.read.schema(PROGRESS_SCHEMA).option("pathGlobFilter", "*.json").json(path)
