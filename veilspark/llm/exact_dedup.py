"""Exact deduplication by Grace hashing.

Records are dealt to tasks by the hash of their normalised text (Spark's
shuffle is the first partitioning).  Inside a task an open-addressing table
compares complete contents; once the table outgrows its memory budget, the
records go to spill files by the next hash digit, and every file is treated
the same way with the digit after that, until each fits.

The same table runs before the shuffle and leaves one record per distinct
text and task, so a text held by a third of all rows crosses the network once
per map task.
"""

from __future__ import annotations

import os
import shutil
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import SPACES, map_arrow, text_or_empty

MEMORY_BYTES = 64 << 20  # of distinct text held by one table
FANOUT_BITS = 4          # spill files per level: 2 ** FANOUT_BITS
BATCH_BYTES = 8 << 20    # of text per batch handed back to Spark

_HEAD = "<32sqqqqqI"  # key, no_id, id, row, n, ties, length of the text that follows
NO_ID = -(1 << 63)  # stands for "no id" inside spill records; has_id tells it from a real id


class _Table:
    """Open addressing with linear probing; an entry is one distinct content."""

    def __init__(self) -> None:
        self.slots = [-1] * 1024
        self.entries: list[list] = []
        self.bytes = 0

    def add(self, key: bytes, text: bytes, best: tuple, n: int, ties: int) -> None:
        mask = len(self.slots) - 1
        at = int.from_bytes(key[8:16], "little") & mask
        while (i := self.slots[at]) >= 0:
            e = self.entries[i]
            if e[0] == key and e[1] == text:
                e[4] = ties if best[:2] < e[2][:2] else e[4] + ties if best[:2] == e[2][:2] else e[4]
                e[2] = min(e[2], best)
                e[3] += n
                return
            at = (at + 1) & mask
        self.slots[at] = len(self.entries)
        self.entries.append([key, text, best, n, ties])
        self.bytes += len(text) + 200
        if 2 * len(self.entries) > len(self.slots):
            self._grow()

    def _grow(self) -> None:
        size = 2 * len(self.slots)
        self.slots = [-1] * size
        for i, e in enumerate(self.entries):
            at = int.from_bytes(e[0][8:16], "little") & (size - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (size - 1)
            self.slots[at] = i


def grace_groups(records: Iterator[tuple], memory_bytes: int = MEMORY_BYTES, level: int = 0) -> Iterator[list]:
    """``(key, text, best, n, ties)`` records in, one such list per distinct
    ``(key, text)`` out: the smallest ``best``, the sum of ``n``, and in
    ``ties`` the number of rows with that smallest id.  ``best`` is ``(no_id,
    id, row)``.  Levels end with the 64 hash bits."""
    table = _Table()
    last = (level + 1) * FANOUT_BITS > 64
    for r in records:
        table.add(*r)
        if table.bytes > memory_bytes and not last:
            break
    else:
        yield from table.entries
        return
    folder = tempfile.mkdtemp(prefix="grace-")
    try:
        fan = 1 << FANOUT_BITS
        files = [open(os.path.join(folder, str(i)), "wb") for i in range(fan)]

        def spill(key, text, best, n, ties):
            digit = (int.from_bytes(key[:8], "little") >> (level * FANOUT_BITS)) & (fan - 1)
            files[digit].write(struct.pack(_HEAD, key, *best, n, ties, len(text)) + text)

        for e in table.entries:
            spill(*e)
        del table
        for r in records:
            spill(*r)
        for f in files:
            f.close()
        for f in files:
            yield from grace_groups(_read_spill(f.name), memory_bytes, level + 1)
            os.remove(f.name)
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def _read_spill(path: str) -> Iterator[tuple]:
    with open(path, "rb") as f:
        while head := f.read(struct.calcsize(_HEAD)):
            key, no_id, i, row, n, ties, size = struct.unpack(_HEAD, head)
            yield key, f.read(size), (no_id, i, row), n, ties


_GROUP_SCHEMA = T.StructType([
    T.StructField("key", T.BinaryType()), T.StructField("body", T.BinaryType()),
    T.StructField("no_id", T.LongType()), T.StructField("id", T.LongType()),
    T.StructField("row", T.LongType()), T.StructField("n", T.LongType()), T.StructField("ties", T.LongType())])


def _groups_of_task(memory_bytes: int, with_body: bool):
    """A mapInArrow function: the rows of a task to one row per distinct text."""
    names = [f.name for f in _GROUP_SCHEMA if with_body or f.name != "body"]
    kinds = {"key": pa.binary(), "body": pa.binary()}

    def run(batches):
        def records():
            for b in batches:
                cols = [b.column(f.name).to_pylist() for f in _GROUP_SCHEMA]
                for key, body, no_id, i, row, n, ties in zip(*cols):
                    yield key, body, (no_id, i, row), n, ties

        def batch(rows):
            cols = {"key": [r[0] for r in rows], "body": [r[1] for r in rows], "no_id": [r[2][0] for r in rows],
                    "id": [r[2][1] for r in rows], "row": [r[2][2] for r in rows], "n": [r[3] for r in rows], "ties": [r[4] for r in rows]}
            return pa.RecordBatch.from_arrays([pa.array(cols[c], kinds.get(c, pa.int64())) for c in names], names)

        held, size = [], 0
        for e in grace_groups(records(), memory_bytes):
            held.append(e)
            size += 64 + len(e[1]) * with_body
            if size > BATCH_BYTES:
                yield batch(held)
                held, size = [], 0
        if held:
            yield batch(held)
    return run


def _with_keys(docs: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of ``docs`` with the normalised text (``__body``), its
    SHA-256 (``__key``), the id or its stand-in (``__id``) and a row number."""
    d = docs.select(*[F.col(f"`{c}`") for c in columns], F.col("doc_id").cast("long").alias("__id"),
                    F.regexp_replace(text_or_empty(), SPACES, " ").alias("__body"),
                    F.monotonically_increasing_id().alias("__row"))
    return d.withColumns({"__key": F.unhex(F.sha2(F.col("__body").cast("binary"), 256)),
                          "__no_id": F.col("__id").isNull().cast("long"),
                          "__id": F.coalesce("__id", F.lit(NO_ID))})


def text_classes(docs: DataFrame, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """One row per distinct normalised text: ``key`` (SHA-256), the row that
    stays (``no_id, id, row``), ``n`` rows, ``ties`` rows with the id that stays."""
    records = _with_keys(docs).select(
        F.col("__key").alias("key"), F.col("__body").cast("binary").alias("body"), F.col("__no_id").alias("no_id"),
        F.col("__id").alias("id"), F.col("__row").alias("row"),
        F.lit(1).cast("long").alias("n"), F.lit(1).cast("long").alias("ties"))
    local = map_arrow(records, _groups_of_task(memory_bytes, True), _GROUP_SCHEMA)
    bare = T.StructType([f for f in _GROUP_SCHEMA if f.name != "body"])
    return map_arrow(local.repartition("key"), _groups_of_task(memory_bytes, False), bare)


def exact_groups(docs: DataFrame, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after each run of white space became one
    space; null counts as empty.  The row with the smallest ``doc_id`` stays;
    a null id comes after all others.  Of rows that repeat the id that stays
    (or of a group without any id) the first in scan order stays, so exactly
    one row of each group has ``kept``.  ``keep_id`` is null only for a
    group without any id.  Empty input gives an empty result; extra columns
    are ignored.

    Texts are grouped by complete content.  Two contents of equal SHA-256
    would form two classes of one key; none are known to exist.
    """
    c = text_classes(docs, memory_bytes).withColumnsRenamed({"id": "keep", "row": "keep_row", "no_id": "keep_no_id"})
    rows = _with_keys(docs).select("__key", "__id", "__no_id", "__row")
    same_id = (F.col("__id") == F.col("keep")) & (F.col("__no_id") == F.col("keep_no_id"))
    return rows.join(c, rows["__key"] == c["key"]).select(
        F.when(F.col("__no_id") == 0, F.col("__id")).alias("doc_id"),
        F.when(F.col("keep_no_id") == 0, F.col("keep")).alias("keep_id"),
        F.col("n").alias("group_size"),
        (same_id & ((F.col("ties") == 1) | (F.col("__row") == F.col("keep_row")))).alias("kept"),
        F.lower(F.hex("key")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, memory_bytes: int = MEMORY_BYTES) -> DataFrame:
    """The rows of ``docs`` that :func:`exact_groups` keeps, with all columns.

    The join is on text key and id, so the copies of one text do not meet in
    one task."""
    c = text_classes(docs, memory_bytes)
    d = _with_keys(docs, *docs.columns).drop("__body")
    stays = ((d["__key"] == c["key"]) & (d["__id"] == c["id"]) & (d["__no_id"] == c["no_id"])
             & ((c["ties"] == 1) | (d["__row"] == c["row"])))
    return d.join(c, stays, "left_semi").select(*[F.col(f"`{x}`") for x in docs.columns])
