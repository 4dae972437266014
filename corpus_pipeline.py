"""Training-data pipeline over ``documents``: quality, exact and near copies, mix, tokens.

``STAGES`` lists ``(name, function)``; a function takes ``(spark, docs, sf_dir)`` and
returns a table with the columns of ``docs`` (the last: the token digests),
which is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from veilspark.llm import bpe, exact_dedup, mixing, near_dedup, quality
from veilspark.llm.common import saved, table


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, its evidence joined with that of their source and language."""
    return quality.keep_accepted(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest id."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 0.8 of their five-word shingles, the one with the smallest id."""
    return near_dedup.drop_near_copies(docs, k=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, up to three times."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every row."""
    # smaller tables, as the executors hold what the stages before have left in their heaps
    ids = bpe.bpe_encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, task_words=50_000, keep_words=False)
    return bpe.token_digests(ids)


STAGES = [("quality", accept_quality), ("exact_dedup", drop_exact), ("near_dedup", drop_near), ("mix", mix), ("bpe", encode)]

# The classifier's decisions are learned; SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
