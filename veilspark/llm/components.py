"""Connected components of an edge table, by large-star and small-star steps.

Each step links every node to the smallest node it knows of.  Edges become
stars around the smallest node of each component; the number of rounds grows
with the logarithm of the longest path.  Only whether there is an open node reaches the driver, per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.llm.common import forget, saved


def _large_star(e: DataFrame) -> DataFrame:
    """For every node, its larger neighbours link to the smallest of it and its neighbours."""
    both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """For every node, its smaller neighbours and itself link to the smallest of them.  Edges have u > v."""
    low = e.groupBy("u").agg(F.min("v").alias("low"))
    far = e.join(low, "u").where("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return far.unionByName(low.select("u", F.col("low").alias("v"))).where("u <> v").distinct()


def _all_stars(e: DataFrame) -> bool:
    """Whether every node is either a centre or a leaf with one edge.  Edges have u > v, distinct."""
    ends = e.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("end"))
    node = ends.select("end.*").groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("n"))
    return node.where("up > 1 or up = 1 and n > 1").isEmpty()


def stars(edges: DataFrame) -> DataFrame:
    """``(u, v)`` with long ids, any direction, repeats and loops allowed ->
    ``(u, v)`` where ``v`` is the smallest id of ``u``'s component and ``u > v``.
    Ids that only have loops, and edges with a null end, are left out."""
    e = saved(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while not _all_stars(e):
        last, e = e, saved(_small_star(_large_star(e)), "edges")
        forget(last)
    return e
