"""Streaming protection job: JSON text in, protected JSON text out.

* the policy file is re-read on the driver between micro-batches, at most
  once per refresh interval; a failed re-read keeps the last good policy, a
  failed first read is fatal;
* each micro-batch is protected with one policy version, whose digest is kept
  in the batch metrics.  A replayed batch is the same if the policy is and no
  field is randomized, or ``seed_by`` is given;
* good records go to the sink, rejected ones (unparsable, no id) optionally
  to a quarantine sink; both writes are per-batch overwrites, so replays after
  a failure do not duplicate output;
* position tracking and restart come from the checkpoint location (Spark's
  offset log), which must be on shared storage on a cluster.

The same :func:`protect_batch` function serves a batch DataFrame, so batch and
stream give identical output for the same input and policy.
"""

from __future__ import annotations

import logging
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from veilspark.operators.drift import drift_report, undeclared_fields
from veilspark.operators.keys import KEY_COL, refuse_bare, with_key
from veilspark.operators.protect import json_output, protect_json
from veilspark.policy import Policy, check, load_policy
from veilspark.sources.files import write_batch
from veilspark.streaming.metrics import FAILED, MONITORING_FLAG, SUCCESS, Totals, count_columns, metrics_frame, run_row
from veilspark.streaming.progress import ProgressLog

log = logging.getLogger(__name__)
JOB = "veilspark.streaming.job.ProtectStream"


class PolicyMonitor:
    """Holds the current policy; re-reads the file when the interval has passed."""

    def __init__(self, spark: SparkSession, path: str, refresh_seconds: float = 60.0, strict: bool = False,
                 clock: Callable[[], float] = time.monotonic):
        self.spark, self.path, self.refresh_seconds, self.strict = spark, path, refresh_seconds, strict
        self._clock = clock
        self.policy = check(load_policy(path, spark), strict)  # fatal when the first read fails
        self._last_read = clock()
        self.reloads = 0

    def current(self) -> Policy:
        if self._clock() - self._last_read >= self.refresh_seconds:
            self._last_read = self._clock()
            try:
                fresh = check(load_policy(self.path, self.spark), self.strict)
            except Exception as exc:  # keep the last good policy
                log.warning("policy re-read failed, keeping version %s: %s", self.policy.digest[:12], exc)
                return self.policy
            if fresh.digest != self.policy.digest:
                self.policy = fresh
                self.reloads += 1
        return self.policy


def protect_batch(df: DataFrame, policy: Policy, value_col: str = "value", **kw) -> DataFrame:
    """All records with ``value`` (protected JSON or NULL), ``reason`` and ``raw``."""
    return protect_json(df, policy, value_col, with_raw=True, **kw)


class CompiledPolicy:
    """The output expression of the current policy, rebuilt only when the
    policy changes (column expressions refer to columns by name, so one
    expression serves every micro-batch; the random seed is not part of it)."""

    def __init__(self, hash_key: str | Column | None = None):
        self._digest: str | None = None
        self._column = None
        self._hash_key = hash_key

    def get(self, policy: Policy):
        if policy.digest != self._digest:
            self._column = json_output(policy, policy.field_names(), self._hash_key)
            self._digest = policy.digest
        return self._column


Sink = Callable[[DataFrame, int], None]


def file_sink(path: str) -> Sink:
    """Text lines under ``path/batch=<id>``, overwritten per batch (idempotent)."""
    return lambda df, batch_id: write_batch(df, path, batch_id)


def kafka_sink(topic: str, servers: str = "localhost:9092", options: dict | None = None) -> Sink:
    """Message values to a topic (at-least-once: a replayed batch is sent again)."""
    from veilspark.sources.kafka import write_kafka_batch

    return lambda df, batch_id: write_kafka_batch(df, topic, servers, options)


def console_sink(n: int = 20) -> Sink:
    """Print the first rows of each batch (for trying a policy out).  The rest
    is computed too, so that the counts are those of the whole batch."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        try:
            df.count()
            df.show(n, truncate=False)
        finally:
            df.unpersist()
    return sink


@dataclass
class ProtectStream:
    """A running protection job (the build → sink → metrics contract).

    ``output_path`` writes good records with :func:`file_sink`; ``sink``
    replaces it (e.g. :func:`kafka_sink`).  Rejected records go to
    ``quarantine_path`` (JSON lines with the raw text and the reason).
    ``metrics_path`` keeps one metrics row per micro-batch (counts, timing,
    policy digest) under ``batch_id=<id>``, overwritten when a batch is
    replayed; ``drift_path`` keeps the undeclared fields of each batch with
    their record counts the same way.  ``hash_key`` makes hashes HMACs under
    that key; ``seed_by`` is a secret that, with the record's text, seeds
    random values, so a replayed batch gives the same ones.

    ``keys_path`` is a table of keys (:mod:`veilspark.operators.keys`), read anew for each batch, in place of ``hash_key``: hashes are
    made under the key valid at ``key_time``, a time column of the source, else when the batch starts; they name it, and records
    without a valid one are rejected.  ``progress_path`` keeps what the engine reports of the query (rates, offsets and lag,
    state, failures; :class:`veilspark.streaming.progress.ProgressLog`)."""

    spark: SparkSession
    monitor: PolicyMonitor
    output_path: str | None = None
    quarantine_path: str | None = None
    value_col: str = "value"
    name: str = "Stream Job"
    sink: Sink | None = None
    metrics_path: str | None = None
    drift_path: str | None = None
    job_id: str | None = None
    hash_key: str | None = None
    seed_by: str | None = None
    keys_path: str | None = None
    key_time: str | None = None
    progress_path: str | None = None

    def __post_init__(self):
        if self.sink is None:
            if self.output_path is None:
                raise ValueError("an output path or a sink is required")
            self.sink = file_sink(self.output_path)
        self.job_id = self.job_id or str(uuid.uuid4())
        self.metrics = Totals()
        if self.hash_key and self.keys_path:
            raise ValueError("either a key or a table of keys")
        self._compiled = CompiledPolicy(F.col(KEY_COL) if self.keys_path else self.hash_key)
        self.progress: ProgressLog | None = None

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch: protect with the current policy, write, count.

        The counts are observed during the sink's write (no separate pass).
        Without a quarantine sink the batch is computed exactly once; with one,
        it is persisted because two outputs read it.  A sink must run an action
        on the DataFrame it receives."""
        policy = self.monitor.current()
        started = time.time()
        obs = Observation(f"veilspark_batch_{batch_id}_{uuid.uuid4().hex[:8]}")
        seed = F.concat_ws("\n", F.lit(self.seed_by), F.col(f"`{self.value_col}`")) if self.seed_by else None
        if self.keys_path:
            at = F.col(f"`{self.key_time}`") if self.key_time else F.timestamp_micros(F.lit(int(started * 1_000_000)))
            timed = batch.select(F.col(f"`{self.value_col}`"), at.alias("__at"))
            batch = with_key(timed, self.spark.read.parquet(self.keys_path), "__at")
        res = protect_batch(batch, policy, self.value_col, compiled=self._compiled.get(policy), seed_col=seed, hash_key=self.hash_key,
                            keep=[KEY_COL] if self.keys_path else None)
        if self.keys_path:
            res = refuse_bare(res, policy)
        counts = count_columns("reason")
        if self.drift_path:  # reads the keys of every record once more
            undeclared = F.size(F.coalesce(undeclared_fields(F.col("raw"), policy), F.array().cast("array<string>")))
            counts.append(F.count_if(undeclared > 0).alias("records_with_undeclared"))
        res = res.observe(obs, *counts)
        shared = bool(self.quarantine_path or self.drift_path)  # read by more than one output
        if shared:
            res = res.persist()
        try:
            self.sink(res.where(F.col("reason").isNull()).select("value"), batch_id)
            if self.quarantine_path:
                bad = res.where(F.col("reason").isNotNull()).select(F.col("raw").alias("value"), "reason")
                write_batch(bad, self.quarantine_path, batch_id, fmt="json")
            if self.drift_path:
                write_batch(drift_report(res, policy, "raw"), self.drift_path, batch_id, fmt="parquet")
            counts = obs.get
        finally:
            if shared:
                res.unpersist()
        m = run_row(JOB, self.name, self.job_id, started, counts, batch_id=batch_id, policy_digest=policy.digest)
        self.metrics.add(m)
        if self.metrics_path:
            metrics_frame(self.spark, [m]).write.mode("overwrite").parquet(
                f"{self.metrics_path.rstrip('/')}/batch_id={batch_id}")

    def start(self, source: DataFrame, checkpoint: str, trigger: dict | None = None):
        """Start the query; ``trigger`` e.g. ``{"processingTime": "10 seconds"}``
        or ``{"availableNow": True}``."""
        w = source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        w = w.trigger(**(trigger or {"processingTime": "10 seconds"}))
        return w.start()

    def run(self, source: DataFrame, checkpoint: str, trigger: dict | None = None,
            timeout_seconds: float | None = None) -> dict:
        """Start, wait for the end (``availableNow`` ends by itself) and return
        the job's metrics row: counts of all batches, duration, query and run id."""
        started, q = time.time(), None
        self.progress = ProgressLog(self.spark, self.progress_path).attach()
        try:
            q = self.start(source, checkpoint, trigger or {"availableNow": True})
            self.progress.follow(str(q.runId))
            if timeout_seconds is None:
                q.awaitTermination()
            elif not q.awaitTermination(timeout_seconds):
                q.stop()
        except Exception as exc:  # reported, then raised
            first_line = str(exc).splitlines()[0] if str(exc) else type(exc).__name__
            self.progress.detach(wait=q is not None)
            self.summary = self._job_row(started, q, FAILED, first_line)
            raise
        finally:
            self.progress.detach(wait=q is not None and not q.isActive)
        self.summary = self._job_row(started, q, SUCCESS, None)
        return self.summary

    def _job_row(self, started: float, q, status: str, error: str | None) -> dict:
        ids = {"query_id": str(q.id), "run_id": str(q.runId)} if q is not None else {}
        return run_row(JOB, self.name, self.job_id, started, self.metrics.counts, status, error,
                       batches=self.metrics.batches, policy_reloads=self.monitor.reloads, progress=self.progress.totals(), **MONITORING_FLAG, **ids)


def run_batch(spark: SparkSession, source: DataFrame, policy: Policy, output_path: str) -> None:
    """Batch mode of the same job: protect and write the good records."""
    res = protect_batch(source, policy)
    res.where(F.col("reason").isNull()).select("value").write.mode("overwrite").text(output_path)
