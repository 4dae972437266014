"""Sharding by jump consistent hashing, built-in functions only.

A key is the seed of a stream of pseudo-random numbers; the shard starts at 0
and jumps forward to ``floor((shard + 1) / r)`` while that is below the number
of shards.  Appending a shard moves a row only into the new one, and moves the
fraction ``1 / (n + 1)`` of the rows.  No ring table is held.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import text_or_empty, with_replaced

USUAL_STEPS = 40         # jumps tried for every row; the few rows that need more get the rest
ROWS_PER_BLOCK = 50_000  # rows numbered together in one sort


def jump_shard(key: Column, shards: int) -> Column:
    """Shard of ``key`` (any type) out of ``shards``; a null key has a shard as any other.

    The numbers of a key's stream are 31 bits of ``xxhash64(key, step)``.
    Every jump goes forward, so ``shards`` steps always suffice."""
    if shards < 1:
        raise ValueError("shards must be positive")
    seed = F.xxhash64(key)

    def step(state, i):
        r = (F.shiftrightunsigned(F.xxhash64(seed, i), 33) + 1) / F.lit(float(1 << 31))  # in (0, 1]
        jump = F.floor((state["next"] + 1) / r).cast("long")
        return F.when(state["next"] < shards, F.struct(state["next"].alias("at"), jump.alias("next"))).otherwise(state)

    # ``at`` is the shard reached, ``next`` where its next jump leads
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit(0).cast("long").alias("next"))
    few = min(shards, USUAL_STEPS)
    state = F.aggregate(F.sequence(F.lit(1), F.lit(few)), state, step)
    if shards > few:
        rest = F.aggregate(F.sequence(F.lit(few + 1), F.lit(shards)), state, step)
        state = F.when(state["next"] < shards, rest).otherwise(state)
    return state["at"].cast("int")


def shard_rows(docs: DataFrame, shards: int, key: str = "doc_id", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """``docs`` plus ``size`` (UTF-8 bytes of the text plus 8; null: 8),
    ``text_crc32``, ``law``, ``shard``, ``slot`` and ``grown_shard`` (with one
    more shard).  Result columns replace input columns of the same name.

    ``slot`` numbers the rows of a shard from 0 without gaps.  A shard is cut
    into blocks by another hash of the key, text and sizes included, so that
    no sort holds a whole shard; a block's rows follow those of the blocks before it.
    Rows equal in key and text share a block; their order is immaterial.
    """
    size = (F.octet_length(text_or_empty()) + 8).cast("long")
    crc = F.crc32(text_or_empty().cast("binary")).cast("long")
    d = with_replaced(docs, {"size": size, "text_crc32": crc, "law": F.lit("key"),
                             "shard": jump_shard(F.col(key), shards), "grown_shard": jump_shard(F.col(key), shards + 1)})
    return number_slots(d, shards, [key, "text_crc32", "size"], rows_per_block)


def number_slots(d: DataFrame, shards: int, order: list[str], rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    n = d.count()
    blocks = max(1, -(-n // (shards * rows_per_block)))
    d = d.withColumn("__block", F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(blocks)).cast("int"))
    sizes = d.groupBy("shard", "__block").agg(F.count("*").alias("__n"))
    before = sizes.select("shard", "__block", (F.sum("__n").over(
        W.partitionBy("shard").orderBy("__block").rowsBetween(W.unboundedPreceding, -1))).alias("__before"))
    local = F.row_number().over(W.partitionBy("shard", "__block").orderBy(*order)) - 1
    return (d.withColumn("__local", local).join(before, ["shard", "__block"])
            .withColumn("slot", (F.col("__local") + F.coalesce("__before", F.lit(0))).cast("long"))
            .drop("__block", "__local", "__before"))


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """The rows of ``docs`` as files, one folder per shard."""
    d = with_replaced(docs, {"shard": jump_shard(F.col(key), shards)})
    d.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
