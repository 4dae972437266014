"""Run metrics: one row per run or micro-batch.

Record counts come from ``DataFrame.observe`` — computed by the executors
while the batch is written, with no extra pass over the data.
"""

from __future__ import annotations

import json
import time
from collections import deque
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Status words of a run and the one flag that every run reports.
SUCCESS, FAILED = "SUCCESS", "FAILED"
MONITORING_FLAG = {"schema_monitoring_enabled": True}

# A run or micro-batch as a row: who ran, when, how it ended, what was counted
# (``counts``: name -> number) and everything else as JSON (``details``).
METRICS_SCHEMA = ("job_id STRING, job STRING, name STRING, started TIMESTAMP, seconds DOUBLE, status STRING, error STRING, "
                  "counts MAP<STRING,BIGINT>, details MAP<STRING,STRING>")


def run_row(job: str, name: str, job_id: str, started: float, counts: dict, status: str = SUCCESS,
            error: str | None = None, **details) -> dict:
    """One metrics row, from the observed ``counts`` of a write and the details of the query that made it.

    ``started`` is seconds since the epoch; the row's duration ends now."""
    return {"job_id": job_id, "job": job, "name": name, "started": datetime.fromtimestamp(started, timezone.utc),
            "seconds": time.time() - started, "status": status, "error": error,
            "counts": {k: int(v) for k, v in counts.items()}, "details": {k: json.dumps(v) for k, v in details.items()}}


def metrics_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Metrics rows for appending to a metrics table."""
    return spark.createDataFrame([tuple(r.values()) for r in rows], METRICS_SCHEMA)


class Totals:
    """Sums of the counts of all batches, and the last rows only: a stream that
    runs for ever keeps a bounded list."""

    def __init__(self, keep: int = 100):
        self.rows: deque[dict] = deque(maxlen=keep)
        self.counts: dict[str, int] = {}
        self.batches = 0

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.batches += 1
        for k, v in row["counts"].items():
            self.counts[k] = self.counts.get(k, 0) + v

    @property
    def last(self) -> dict:
        return self.rows[-1]


def count_columns(reason_col: str = "reason") -> list[Column]:
    """Aggregate expressions for records in / out / rejected."""
    r = F.col(reason_col)
    return [
        F.count(F.lit(1)).alias("records_in"),
        F.count_if(r.isNull()).alias("records_out"),
        F.count_if(r.isNotNull()).alias("records_rejected"),
    ]


def observed(df: DataFrame, reason_col: str = "reason") -> tuple[DataFrame, Observation]:
    """Attach record counters to a DataFrame; read them after an action."""
    obs = Observation("veilspark_counts")
    return df.observe(obs, *count_columns(reason_col)), obs


def sketch_columns(id_col: str, value_col: str) -> list[Column]:
    """Aggregates of a batch that unite over batches: rows, a HyperLogLog sketch of the ids, a KLL sketch of the values."""
    return [F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(F.col(f"`{id_col}`").cast("string"), F.lit(14)).alias("ids"),
            F.kll_sketch_agg_double(F.col(f"`{value_col}`").cast("double")).alias("spread")]


def united(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``n_rows, n_ids`` (about 1 % off) and ``quantiles`` (ranks about 2 % off) over the sketch rows of any number of batches."""
    both = sketches.agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("ids").alias("ids"), F.kll_merge_agg_double("spread").alias("spread"))
    return both.select("n_rows", F.hll_sketch_estimate("ids").alias("n_ids"),
                       F.array(*[F.kll_sketch_get_quantile_double("spread", F.lit(q)) for q in quantiles]).alias("quantiles"))
