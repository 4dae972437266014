"""Shared helpers: tables, words, shared scratch tables."""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.session import scratch_dir
from veilspark.sources import storage

# fixed values: the white space that separates words
SPACES = r"[\x20\x09-\x0D]+"
NON_SPACES = r"[^\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_SAVED_AT: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table under the shared checkpoint folder and read it
    back: cuts the lineage, survives lost executors, and gives later joins a
    plan with known sizes."""
    spark = df.sparkSession
    path = scratch_dir(spark, f"llm-{name}-{uuid.uuid4().hex}")
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")  # the table is what is read from here on, not the shuffles that made it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    table = spark.read.schema(df.schema).parquet(path)
    _SAVED_AT[table] = path
    return table


def forget(*tables: DataFrame | None) -> None:
    """Delete tables made by :func:`saved` that nothing reads any more."""
    for t in tables:
        if t is not None and t in _SAVED_AT:
            storage.delete(t.sparkSession, [_SAVED_AT.pop(t)])


def kept(df: DataFrame) -> DataFrame:
    """Persist ``df`` on the executors' disks: computed once, and computed again
    from its lineage where an executor is lost.  For intermediate results that are
    a function of the input rows; ``spark.catalog.clearCache()`` lets go of them."""
    return df.persist(StorageLevel.DISK_ONLY)


# Texts are long: batches of this size keep a Python worker's memory small.
# Each setting with Spark's default and the value used in its place.
BATCH_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
              "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", str(4 << 20))}


def map_arrow(df: DataFrame, fn, schema) -> DataFrame:
    """``mapInArrow`` with batches of bounded bytes, unless the session sets its own sizes."""
    conf = df.sparkSession.conf
    for key, (default, value) in BATCH_CONF.items():
        if conf.get(key, default) == default:
            conf.set(key, value)
    return df.mapInArrow(fn, schema)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    """Number of words; the split of a text with outer white space has empty ends."""
    parts = F.split(text, SPACES)
    return F.size(F.filter(parts, lambda w: w != F.lit(""))).cast("long")


def id_bucket(col: str, buckets: int) -> Column:
    """crc32 of the id as text, modulo ``buckets``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(buckets)).cast("int")


def with_replaced(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """``withColumns`` where a result column replaces an input column of the same name in any case."""
    lower = {c.lower() for c in cols}
    keep = [c for c in df.columns if c.lower() not in lower]
    return df.select(*[F.col(f"`{c}`") for c in keep], *[v.alias(k) for k, v in cols.items()])
