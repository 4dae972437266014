"""Command line: run the protection stream with ``key=value`` settings.

    python -m veilspark.streaming.cli schema-path=/policies/user.json \\
        input-topic=events output-topic=events-protected bootstrap-servers=broker:9092 \\
        checkpoint.dir=/shared/checkpoints/user

Keys (same names as the original tool's job settings where one exists):

==================================  ==============================================
``schema-path``                     policy file (any Hadoop filesystem), required; enrichment: optional, gives the column types
``input-topic`` / ``input-path``    message-queue topic, or folder of JSON lines
``output-topic`` / ``output-path``  topic, or folder (per-batch idempotent files)
``bootstrap-servers``, ``group-id`` queue connection (``localhost:9092``, ``pii-processor``)
``quarantine-path``                 folder for rejected records (optional)
``metrics-path``                    folder for per-batch metrics rows (optional)
``drift-path``                      folder for per-batch undeclared-field counts (optional)
``schema.refresh.interval.seconds`` policy re-read interval, default 60
``schema.strict``                   ``true``: refuse policies with lint errors
``checkpoint.dir``                  streaming checkpoint; default: ``spark.checkpoint.dir``/``<job-id>``, without
                                    a job id ``_checkpoint`` under the output, so the next run goes on
``checkpoint.interval``             trigger interval in ms, default 10000
``execution.mode``                  ``streaming`` (default) or ``batch`` (process what is there, then stop)
``job-id``, ``metrics-name``        run metrics identity
``hash-key-env``, ``seed-env``      environment variables with the key of keyed hashes and the seed of
                                    replay-stable random values
``hash-keys-path``                  table of keys instead: hashes under the key valid when a batch starts, which they name
``progress-path``                   folder for the engine's progress rows: rates, offsets and lag, state, failures (optional)
``keys-can-move``                   enrichment: ``false`` if a key's day never changes
``table-path``                      enrichment job instead: upsert protected records into this table
``partition-strategy``              enrichment: ``event`` (day, default), ``processing``, ``hour``, ``month``, ``bucket:N``
``max-fields``                      enrichment: most columns that records' fields get; all others share one map column
``input-table``, ``output-table``   table job instead: protect the typed columns of a parquet table
``id-column``, ``partition-by``     table job: the id column (kept as is) and output partition columns
``key``, ``event-time-field``,      enrichment: record key (``id``), event-time field and its format
``event-time-format``
==================================  ==============================================

Arguments without ``=`` are reported and ignored.  A missing output is an
error (the job would otherwise run without writing anything).
"""

from __future__ import annotations

import hashlib
import json
import os
import sys

from veilspark.operators.protect import apply_policy
from veilspark.policy import check, load_policy
from veilspark.session import checkpoint_dir, get_session
from veilspark.sources import storage
from veilspark.sources.files import read_json_text_stream
from veilspark.sources.kafka import DEFAULT_GROUP, DEFAULT_SERVERS, read_kafka
from veilspark.streaming.enrich import EnrichStream
from veilspark.streaming.job import PolicyMonitor, ProtectStream, kafka_sink


def parse_config(args: list[str]) -> tuple[dict[str, str], list[str]]:
    config, ignored = {}, []
    for a in args:
        if "=" in a:
            k, v = a.split("=", 1)
            config[k.strip()] = v.strip()
        else:
            ignored.append(a)
    return config, ignored


def build(spark, config: dict[str, str]) -> tuple[ProtectStream, object, str, dict]:
    """The job, its source, checkpoint folder and trigger from the settings."""
    if "schema-path" not in config:
        raise ValueError("schema-path is required")
    if "output-topic" not in config and "output-path" not in config:
        raise ValueError("output-topic or output-path is required")
    if "input-topic" not in config and "input-path" not in config:
        raise ValueError("input-topic or input-path is required")
    servers = config.get("bootstrap-servers", DEFAULT_SERVERS)
    monitor = PolicyMonitor(spark, config["schema-path"],
                            refresh_seconds=float(config.get("schema.refresh.interval.seconds", "60")),
                            strict=config.get("schema.strict", "false").lower() == "true")
    sink = kafka_sink(config["output-topic"], servers) if "output-topic" in config else None
    job = ProtectStream(spark, monitor, output_path=config.get("output-path"),
                        quarantine_path=config.get("quarantine-path"),
                        name=config.get("metrics-name", "Stream Job"), sink=sink,
                        metrics_path=config.get("metrics-path"), drift_path=config.get("drift-path"),
                        job_id=config.get("job-id"), hash_key=_secret(config, "hash-key-env"), seed_by=_secret(config, "seed-env"),
                        keys_path=config.get("hash-keys-path"), progress_path=config.get("progress-path"))
    source = _source(spark, config)
    ckpt = default_checkpoint(spark, config)
    if "output-path" in config and _has_batches(spark, config["output-path"]) and not storage.exists(spark, f"{ckpt}/offsets"):
        raise ValueError(f"{config['output-path']} holds the output of another run; name its checkpoint.dir or another output-path")
    return job, source, ckpt, _trigger(config)


def _secret(config: dict[str, str], name: str) -> str | None:
    """A secret by the name of the environment variable that holds it, so it is in no command line."""
    return os.environ[config[name]] if name in config else None


def default_checkpoint(spark, config: dict[str, str]) -> str:
    """Where the run's position is kept: the same for every run of the same
    job, input and output, so a run without ``checkpoint.dir`` goes on where the last one ended."""
    if "checkpoint.dir" in config:
        return config["checkpoint.dir"].rstrip("/")
    if "job-id" in config:
        return f"{checkpoint_dir(spark).rstrip('/')}/{config['job-id']}"
    home = config.get("output-path") or config.get("table-path")
    if home:
        return f"{home.rstrip('/')}/_checkpoint"
    same = "|".join(config.get(k, "") for k in ("schema-path", "input-topic", "input-path", "output-topic", "bootstrap-servers", "group-id"))
    return f"{checkpoint_dir(spark).rstrip('/')}/protect-{hashlib.sha256(same.encode()).hexdigest()[:16]}"


def _has_batches(spark, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(f.getPath().getName().startswith("batch=") for f in fs.listStatus(p))


def _source(spark, config: dict[str, str]):
    if "input-topic" in config:
        return read_kafka(spark, config["input-topic"], config.get("bootstrap-servers", DEFAULT_SERVERS),
                          config.get("group-id", DEFAULT_GROUP))
    if "input-path" in config:
        return read_json_text_stream(spark, config["input-path"])
    raise ValueError("input-topic or input-path is required")


def _trigger(config: dict[str, str]) -> dict:
    if config.get("execution.mode", "streaming") == "batch":
        return {"availableNow": True}
    return {"processingTime": f"{int(config.get('checkpoint.interval', '10000'))} milliseconds"}


def run_enrich(spark, config: dict[str, str]) -> int:
    """The enrichment job: protected records into the daily table at ``table-path``."""
    job = EnrichStream(spark, config["table-path"], key=config.get("key", "id"),
                       event_time_field=config.get("event-time-field"),
                       event_time_format=config.get("event-time-format"), quarantine_path=config.get("quarantine-path"),
                       keys_can_move=config.get("keys-can-move", "true").lower() == "true",
                       policy=load_policy(config["schema-path"], spark) if "schema-path" in config else None,
                       partition_from=config.get("partition-strategy", "event"),
                       max_fields=int(config["max-fields"]) if "max-fields" in config else None)
    q = job.start(_source(spark, config), default_checkpoint(spark, config), _trigger(config))
    q.awaitTermination()
    print(json.dumps({"status": "SUCCESS", "table": config["table-path"], "query_id": str(q.id)}))
    return 0


def run_table(spark, config: dict[str, str]) -> int:
    """The table job: typed columns of a parquet table protected into another table."""
    policy = check(load_policy(config["schema-path"], spark), config.get("schema.strict", "false").lower() == "true")
    parts = [c for c in config.get("partition-by", "").split(",") if c]
    df = spark.read.parquet(config["input-table"])
    out = apply_policy(df, policy, id_col=config.get("id-column", "id"), keep=parts)
    w = out.write.mode("overwrite")
    if parts:
        w = w.partitionBy(*parts)
    w.parquet(config["output-table"])
    print(json.dumps({"status": "SUCCESS", "output": config["output-table"], "columns": out.columns}))
    return 0


def _usage_error(message: str) -> int:
    print(f"error: {message}\n{__doc__}", file=sys.stderr)
    return 2


def main(argv: list[str] | None = None) -> int:
    config, ignored = parse_config(sys.argv[1:] if argv is None else argv)
    for a in ignored:
        print(f"ignored argument without '=': {a}", file=sys.stderr)
    if "table-path" not in config and "schema-path" not in config:
        return _usage_error("schema-path is required (or table-path for the enrichment job)")
    if "input-table" in config and "output-table" not in config:
        return _usage_error("output-table is required")
    if "input-table" not in config and "table-path" not in config:
        if "output-topic" not in config and "output-path" not in config:
            return _usage_error("output-topic or output-path is required")
        if "input-topic" not in config and "input-path" not in config:
            return _usage_error("input-topic or input-path is required")
    spark = get_session()
    if "table-path" in config:
        return run_enrich(spark, config)
    if "input-table" in config:
        return run_table(spark, config)
    job, source, ckpt, trigger = build(spark, config)
    summary = job.run(source, ckpt, trigger)
    print(json.dumps({k: summary[k] for k in ("job_id", "status", "error", "seconds", "counts", "details")}))
    return 0 if summary["status"] == "SUCCESS" else 1


if __name__ == "__main__":
    sys.exit(main())
