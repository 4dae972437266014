"""Inputs for the registered queries, derived by Spark from the driver tables.

Message-queue style JSON text is produced from typed tables with ``to_json``
so that its size grows with the tables.  Optional keys are made absent by
data-driven conditions (``to_json`` leaves SQL NULL members out).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; its partitions are the scan's splits (``spark.sql.files.*``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per customer; ``id`` is the customer key."""
    c = table(spark, sf_dir, "customer")
    doc = F.struct(F.col("c_custkey").alias("id"), "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return c.select(F.to_json(doc).alias("value"))


def event_json(spark: SparkSession, sf_dir: str, with_ts: bool = False) -> DataFrame:
    """One JSON object per event.  ``props`` is embedded as an object; ``value``
    is present only for purchases and ``note`` (JSON null) only for errors.
    ``with_ts`` also carries the event time as a column (a message timestamp)."""
    e = table(spark, sf_dir, "events")
    doc = F.struct(
        F.col("event_id").alias("id"),
        F.col("user_id"),
        F.col("event_type"),
        F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
        F.date_format(F.col("ts"), "yyyy-MM-dd").alias("day"),
        F.col("ts").cast("string").alias("ts"),
        F.parse_json(F.col("props")).alias("props"),
        F.when(F.col("event_type") == "error", F.parse_json(F.lit("null"))).alias("note"),
    )
    return e.select(F.to_json(doc).alias("value"), *([F.col("ts")] if with_ts else []))


def event_json_with_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event JSON where error events are cut short (unparsable) and events
    with ``value < 1`` carry no id; every row is kept."""
    e = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(
        F.when(F.col("value") >= 1, F.col("event_id")).alias("id"),
        F.col("user_id"), F.col("event_type"), F.col("value")))
    broken = F.substring(doc, 1, F.length(doc) - 1)
    return e.select(F.when(F.col("event_type") == "error", broken).otherwise(doc).alias("value"))


def event_json_with_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event JSON, by ``event_id % 7``: good; cut short after many sibling arrays; nested too deep; a number too long;
    a string that is not ended and holds as many digits; brackets and digits inside a string (good); without an id."""
    e = table(spark, sf_dir, "events")
    turn = F.col("event_id") % 7
    member = (F.when(turn == 1, F.concat(F.lit("["), F.repeat(F.lit("[],"), 600)))
              .when(turn == 2, F.concat(F.repeat(F.lit("["), 600), F.repeat(F.lit("]"), 600), F.lit("}")))
              .when(turn == 3, F.concat(F.repeat(F.lit("7"), 1200), F.lit("}")))
              .when(turn == 4, F.concat(F.lit('"'), F.repeat(F.lit("7"), 1200)))
              .when(turn == 5, F.concat(F.lit('"\\"'), F.repeat(F.lit("[{7"), 600), F.repeat(F.lit("7"), 1200), F.lit('"}')))
              .otherwise(F.lit("1}")))
    head = F.when(turn == 6, F.lit("{")).otherwise(F.concat(F.lit('{"id":'), F.col("event_id").cast("string"), F.lit(",")))
    return e.select(F.concat(head, F.lit('"m":'), member).alias("value"))


def conversation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON object per conversation turn; the whole turn text is a member."""
    c = table(spark, sf_dir, "conversations")
    doc = F.struct(F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
                   "role", "text", F.col("turn"))
    return c.select(F.to_json(doc).alias("value"))


def mixed_member() -> Column:
    """A member of events that changes its type from record to record, by
    ``event_id % 7``: int, 64-bit int, double, boolean, null, text, absent."""
    turn = F.col("event_id") % 7
    return (F.when(turn == 0, F.col("user_id").cast("variant"))
            .when(turn == 1, (F.col("event_id") * 3_000_000_000).cast("variant"))
            .when(turn == 2, F.col("value").cast("variant"))
            .when(turn == 3, (F.col("value") > 50).cast("variant"))
            .when(turn == 4, F.parse_json(F.lit("null")))
            .when(turn == 5, F.col("event_type").cast("variant")))


def mixed_json(spark: SparkSession, sf_dir: str, names: tuple[str, ...] = ("m",)) -> DataFrame:
    """Event JSON with :func:`mixed_member` under each of ``names``."""
    members = [mixed_member().alias(n) for n in names]
    return table(spark, sf_dir, "events").select(F.to_json(F.struct(F.col("event_id").alias("id"), *members)).alias("value"))
