"""Message-queue (Kafka) source and sink for JSON text records.

Only the message value is read, as text; the position to resume from is kept
in the streaming checkpoint, so a restart continues after the last committed
batch.  The sink is at-least-once (as Spark's Kafka sink is); use the file
sink's per-batch overwrite where exactly-once output is needed.

The Kafka connector is a separate package; :func:`kafka_available` tells
whether it is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DEFAULT_SERVERS = "localhost:9092"
DEFAULT_GROUP = "pii-processor"


def kafka_available(spark: SparkSession) -> bool:
    try:
        spark.sparkContext._jvm.java.lang.Class.forName("org.apache.spark.sql.kafka010.KafkaSourceProvider")
        return True
    except Exception:
        return False


def _reader_options(topic: str, servers: str, group_id: str | None, starting_offsets: str,
                    extra: dict | None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting_offsets}
    if group_id:
        opts["kafka.group.id"] = group_id
    for k, v in (extra or {}).items():
        opts[k if k.startswith("kafka.") or k in ("failOnDataLoss", "maxOffsetsPerTrigger") else f"kafka.{k}"] = str(v)
    return opts


CONNECTOR_MISSING = ("the Kafka connector is not on the classpath; add the spark-sql-kafka-0-10 package "
                     "matching this Spark version (spark.jars.packages)")


def require_kafka(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError(CONNECTOR_MISSING)


def read_kafka(spark: SparkSession, topic: str, servers: str = DEFAULT_SERVERS, group_id: str | None = None,
               starting_offsets: str = "earliest", options: dict | None = None, stream: bool = True) -> DataFrame:
    """Message values of ``topic`` as a ``value`` text column (stream or batch)."""
    require_kafka(spark)
    r = spark.readStream if stream else spark.read
    r = r.format("kafka")
    for k, v in _reader_options(topic, servers, group_id, starting_offsets, options).items():
        r = r.option(k, v)
    return r.load().selectExpr("CAST(value AS STRING) AS value")


def kafka_sink_options(topic: str, servers: str = DEFAULT_SERVERS, options: dict | None = None) -> dict:
    opts = {"kafka.bootstrap.servers": servers, "topic": topic}
    for k, v in (options or {}).items():
        opts[k if k.startswith("kafka.") else f"kafka.{k}"] = str(v)
    return opts


def write_kafka_batch(df: DataFrame, topic: str, servers: str = DEFAULT_SERVERS, options: dict | None = None) -> None:
    """Write the ``value`` column of a (micro-)batch to ``topic``."""
    require_kafka(df.sparkSession)
    w = df.select("value").write.format("kafka")
    for k, v in kafka_sink_options(topic, servers, options).items():
        w = w.option(k, v)
    w.save()
