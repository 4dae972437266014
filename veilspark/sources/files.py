"""File sources and sinks for JSON text records (one object per line).

The streaming form is the same contract as a message-queue source: one
``value`` column of text.  The sink writes one folder per micro-batch id with
overwrite, so a replayed batch replaces its own output instead of adding
duplicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_json_text(spark: SparkSession, path: str) -> DataFrame:
    """Batch: every line of the files under ``path`` as ``value``."""
    return spark.read.text(path)


def read_json_text_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream: new files under ``path`` as they arrive, one line per ``value``."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def write_json_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write the ``value`` column as text lines."""
    df.select("value").write.mode(mode).text(path)


def write_batch(df: DataFrame, path: str, batch_id: int, fmt: str = "text") -> str:
    """Idempotent per-batch write: ``path/batch=<id>`` is overwritten as a whole."""
    target = f"{path.rstrip('/')}/batch={batch_id}"
    w = df.write.mode("overwrite")
    if fmt == "text":
        w.text(target)
    else:
        w.format(fmt).save(target)
    return target
