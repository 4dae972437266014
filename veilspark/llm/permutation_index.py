"""Permutation index for nearest neighbours.

Every vector is represented by its nearest pivots in order.  In each block
of the table the vectors are posted in one inverted file per pivot, with the
pivot's place in their order.  A query reads the files of its own nearest
pivots, ranks the block's vectors by footrule distance between the two orders,
and the best of that ranking are compared by exact distance.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import kept, map_arrow

PIVOTS = 128          # bounded sample that the index is fitted on
PLACES = 64           # nearest pivots that represent a vector
BLOCK_ROWS = 4096     # vectors per block
QUERY_ROWS = 8192     # queries per block
SHARE, LEAST = 0.35, 1000  # of a block's vectors, at least so many, are compared exactly


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows that take part: an id, and a vector that is not
    null, empty or zero and holds only finite numbers."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0.0)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).where(F.col("vec_id").isNotNull() & fine)


def fit_pivots(rows: DataFrame, pivots: int = PIVOTS) -> np.ndarray:
    """Up to ``pivots`` distinct vectors of one length, the first in the order of
    a hash of the id out of eight times as many rows.  The sample is all that reaches the driver."""
    sample = [tuple(r["v"]) for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(8 * pivots).collect()]
    if not sample:
        return np.zeros((0, 0))
    sizes = [len(v) for v in sample]
    dim = max(set(sizes), key=sizes.count)
    return np.array(list(dict.fromkeys(v for v in sample if len(v) == dim))[:pivots], float)


def _flat(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), float).reshape(len(column), dim)


def build_index(rows: DataFrame, pivots: np.ndarray, places: int = PLACES) -> DataFrame:
    """``vec_id, v, near``: the numbers of the nearest pivots in order, ties to the smaller number.

    Vectors of another length than the pivots take no part."""
    count, dim = pivots.shape
    places = min(places, count)

    def run(batches):
        for b in batches:
            x = _flat(b.column("v"), dim)
            d = ((x[:, None, :] - pivots[None]) ** 2).sum(2) if len(x) * count * dim < 1 << 22 else \
                np.stack([((x - p) ** 2).sum(1) for p in pivots], 1)
            near = np.argsort(d, axis=1, kind="stable")[:, :places].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * places, pa.int32()), pa.array(near.ravel(), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("v"), lists], ["vec_id", "v", "near"])

    schema = T.StructType([*rows.schema.fields, T.StructField("near", T.ArrayType(T.IntegerType()))])
    return map_arrow(rows.where(F.size("v") == dim), run, schema)


def _search(k: int, dim: int, count: int, places: int, share: float, least: int):
    """Best ``k`` of a block for each query of a block of queries."""
    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if data.num_rows and queries.num_rows:
            ids = data.column("vec_id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, x = ids[order], _flat(data.column("v"), dim)[order]
            near = _flat(data.column("near"), places).astype(np.int64)[order]
            # the inverted file of a pivot: its vectors, and its place in their order
            flat = np.argsort(near.ravel(), kind="stable")
            ends = np.searchsorted(near.ravel()[flat], np.arange(count + 1))
            posted, place = (flat // places).astype(np.int32), (flat % places).astype(np.int32)
            top = min(len(ids), max(least, math.ceil(share * len(ids))))
            for q, v, pivots in zip(queries.column("vec_id").to_pylist(), _flat(queries.column("v"), dim), _flat(queries.column("near"), places).astype(int)):
                # footrule with absent pivots at the end: a constant less twice the overlap
                overlap = np.zeros(len(ids), np.int32)
                for at, p in enumerate(pivots):
                    i = slice(ends[p], ends[p + 1])
                    overlap[posted[i]] += places - np.maximum(place[i], at)
                overlap[ids == q] = -1
                best = np.argsort(-overlap, kind="stable")[:top] if top < len(ids) else np.arange(len(ids))
                best = best[overlap[best] >= 0]
                d = np.sqrt(((x[best] - v) ** 2).sum(1))
                first = np.lexsort((ids[best], d))[:k]
                out_q += [q] * len(first)
                out_v.append(ids[best][first])
                out_s.append(d[first])
        return pa.table({"query_id": pa.array(out_q, pa.int64()), "vec_id": pa.array(np.concatenate(out_v) if out_v else [], pa.int64()),
                         "score": pa.array(np.concatenate(out_s) if out_s else [], pa.float64())})
    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, pivots: int = PIVOTS, places: int = PLACES, block_rows: int = BLOCK_ROWS,
            query_rows: int = QUERY_ROWS, share: float = SHARE, least: int = LEAST) -> DataFrame:
    """``query_id, rank, vec_id, score``: up to ``k`` nearest rows of ``vectors`` for
    every row of ``queries`` (``vec_id, embedding`` both), by Euclidean distance in double precision, ties to the smaller id.

    Rows that :func:`usable` leaves out take no part; a row is no candidate of
    a query with its own id.  Of queries that repeat an id one counts; rows that
    repeat an id are candidates each.  All rows are indexed.  Blocks are dealt
    by hash and meet every block of queries, so equal vectors spread over blocks;
    each block returns ``k`` rows per query.
    """
    rows = kept(usable(vectors))
    basis = fit_pivots(rows, pivots)
    spark = vectors.sparkSession
    if not basis.size:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    count, dim = basis.shape
    places = min(places, count)
    index = kept(build_index(rows, basis, places))
    asked = usable(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = kept(build_index(asked, basis, places))
    blocks = max(1, -(-index.count() // block_rows))
    groups = max(1, -(-asked.count() // query_rows))
    data = index.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks))).withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    ask = asked.withColumn("group", F.pmod(F.xxhash64("vec_id"), F.lit(groups)).cast("int")).withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    found = data.groupBy("block", "group").cogroup(ask.groupBy("block", "group")).applyInArrow(
        _search(k, dim, count, places, share, least), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
