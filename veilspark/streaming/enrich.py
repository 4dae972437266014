"""Enrichment job: protected JSON records into a partitioned table.

Per micro-batch: find the types of the batch's fields (one small
aggregation), turn the records into typed columns, align them with the
table's existing column types (new fields extend the schema), add the time
columns and upsert into the table — latest row per key wins, only the touched
partitions are rewritten (see :func:`veilspark.operators.lake.merge_into`).

A field keeps its column from batch to batch, also where another differs from it only in case.  Where
names may be data (ids as keys), ``max_fields`` bounds the columns: the most frequent fields, by a sketch
per batch that is united over all batches, have columns; all others go into one map column.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators import lake
from veilspark.operators.values import parse_json_text
from veilspark.policy import Policy
from veilspark.sources.files import write_batch
from veilspark.streaming.metrics import Totals, run_row

JOB = "veilspark.streaming.enrich.EnrichStream"
OTHERS = "other_fields"
SKETCHES = "_fields"
TRACKED = 16  # names that a sketch tracks for each column there may be


def enrich_frame(df: DataFrame, value_col: str = "value", event_time_field: str | None = None,
                 event_time_format: str | None = None, types: dict[str, str] | None = None,
                 required: tuple[str, ...] = (), columns: dict[str, str] | None = None, others: str | None = None,
                 partition_from: str = "event", key: str | None = None) -> DataFrame:
    """Typed columns of the records plus ``event_date``, ``processing_timestamp``
    and ``event_date_prt``.  The event time comes from ``event_time_field``
    (text parsed with ``event_time_format``, or a timestamp); text that is no time,
    or a record without the field, has no event day.  Without
    ``event_time_field`` the processing time is used.  ``required`` fields are columns
    (text) even where no record has them.  ``columns``: field → column of the table so far (see :func:`columns_of`);
    ``others``: a map column for fields that are not in ``types``; ``partition_from``, ``key``: see :func:`lake.add_time_columns`."""
    types = dict(types if types is not None else lake.record_field_types(df, value_col))
    for n in (*required, *([event_time_field] if event_time_field else [])):
        types.setdefault(n, "string")
    named = dict(zip(types, lake.column_names(list(types), columns)))
    cols = lake.records_to_columns(df, types, value_col, columns, others)
    ts = F.current_timestamp()
    if event_time_field:
        text = F.col(f"`{named[event_time_field]}`").cast("string")
        ts = F.try_to_timestamp(text, F.lit(event_time_format)) if event_time_format else F.try_to_timestamp(text)
    return lake.add_time_columns(cols.withColumn("__event_ts", ts), "__event_ts", partition_from, named[key] if key else None).drop("__event_ts")


def frequent_fields(spark: SparkSession, folder: str, batch: DataFrame, batch_id: int, k: int, value_col: str = "value") -> list[str]:
    """The (about) ``k`` most frequent field names of all batches so far, sorted.

    A batch leaves one sketch row in ``folder`` (its folder is overwritten when the batch is replayed); the rows are united.
    A sketch holds ``TRACKED * k`` names at most, however many there are."""
    target = f"{folder.rstrip('/')}/batch={batch_id}"
    names = lake.record_fields(batch, value_col)
    names.select(F.expr(f"approx_top_k_accumulate(field, {TRACKED * k})").alias("sketch")).coalesce(1).write.mode("overwrite").parquet(target)
    union = spark.read.parquet(folder).select(F.expr(f"approx_top_k_estimate(approx_top_k_combine(sketch, {TRACKED * k}), {k})").alias("top"))
    return sorted(r["item"] for r in union.first()["top"])


def field_text(table: DataFrame, field: str) -> Column:
    """A field as text wherever the table has it: in its column, or in the map of the rows from before it had one."""
    column = lake.field_columns(table.schema).get(field)
    parts = [F.col(f"`{column}`").cast("string")] if column else []
    if OTHERS in table.columns:
        member = F.col(OTHERS)[field]
        parts.append(F.coalesce(F.try_variant_get(member, "$", "string"), F.to_json(member)))
    return F.coalesce(*parts) if parts else F.lit(None).cast("string")


def fields_map(table: DataFrame) -> Column:
    """Every field that a row has, by name, as text: from the columns and from the map."""
    known = [F.struct(F.lit(f).alias("key"), F.col(f"`{c}`").cast("string").alias("value")) for f, c in lake.field_columns(table.schema).items()]
    own = F.filter(F.array(*known), lambda e: e["value"].isNotNull())
    if OTHERS not in table.columns:
        return F.map_from_entries(own)
    text = F.transform_values(F.coalesce(OTHERS, F.create_map().cast("map<string,variant>")), lambda k, v: F.coalesce(F.try_variant_get(v, "$", "string"), F.to_json(v)))
    names = F.transform(own, lambda e: e["key"])
    return F.map_concat(F.map_from_entries(own), F.map_filter(text, lambda k, v: ~F.array_contains(names, k)))


@dataclass
class EnrichStream:
    """Upsert protected records into the table at ``table_path``.

    Lines that can't be parsed and records without the key are counted and, with
    ``quarantine_path``, kept there with the reason.  ``keys_can_move=False``
    (a key's partition never changes) spares the key locator.  With ``policy`` (the one that made the records)
    column types come from its operations and only fields that pass through are looked at.  ``partition_from``: a
    partition strategy.  ``max_fields``: most fields that get a column."""

    spark: SparkSession
    table_path: str
    key: str = "id"
    order: tuple[str, ...] = (lake.EVENT_DATE, lake.PROCESSING_TS)
    event_time_field: str | None = None
    event_time_format: str | None = None
    value_col: str = "value"
    quarantine_path: str | None = None
    keys_can_move: bool = True
    name: str = "Enrich Job"
    job_id: str = "enrich"
    policy: Policy | None = None
    partition_from: str = "event"
    max_fields: int | None = None

    def __post_init__(self):
        self.metrics = Totals()

    def _types(self, batch: DataFrame, batch_id: int, known: dict[str, str]) -> dict[str, str]:
        if self.policy is not None:
            return lake.protected_types(batch, self.policy, self.value_col)
        if self.max_fields is None:
            return lake.record_field_types(batch, self.value_col)
        top = frequent_fields(self.spark, f"{self.table_path.rstrip('/')}/{SKETCHES}", batch, batch_id, self.max_fields, self.value_col)
        must = [self.key, *([self.event_time_field] if self.event_time_field else [])]
        room = max(0, self.max_fields - len({*known, *must}))  # columns stay; new ones as long as there is room
        new = [f for f in top if f not in known and f not in must][:room]
        return lake.record_field_types(batch, self.value_col, only=[*known, *(m for m in must if m not in known), *new])

    def process(self, batch: DataFrame, batch_id: int) -> None:
        started = time.time()
        # on disk: a batch may be larger than memory, which the merge's sorts need
        batch = batch.persist(StorageLevel.DISK_ONLY)
        rows = None
        try:
            known = lake.field_columns(lake.read_table(self.spark, self.table_path).schema) if lake.is_table(self.spark, self.table_path) else {}
            types = self._types(batch, batch_id, known)
            fields = dict.fromkeys([*types, self.key, *([self.event_time_field] if self.event_time_field else [])])
            fields = dict(zip(fields, lake.column_names(list(fields), known)))
            key = fields[self.key]
            # the rows feed the counts and several steps of the merge: made once
            rows = enrich_frame(batch, self.value_col, self.event_time_field, self.event_time_format, types, required=(self.key,), columns=known,
                                others=OTHERS if self.max_fields is not None else None, partition_from=self.partition_from,
                                key=self.key).persist(StorageLevel.DISK_ONLY)
            has_key = F.col(f"`{key}`").isNotNull()
            parsed = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(has_key).alias("keyed"),
                              F.count_if(has_key & F.col(lake.PARTITION_COL).isNull()).alias("undated")).first()
            counts = {"records_in": batch.count(), "records_applied": parsed["keyed"], "records_without_day": parsed["undated"]}
            counts["records_rejected"] = counts["records_in"] - parsed["keyed"]
            if self.quarantine_path:
                v = parse_json_text(F.col(f"`{self.value_col}`"))
                member = F.try_variant_get(v, f"$['{self.key}']", "string")
                bad = batch.select(F.col(f"`{self.value_col}`").alias("value"), F.when(v.isNull(), F.lit("parse_error")).when(
                    member.isNull(), F.lit("missing_key")).alias("reason")).where("reason is not null")
                write_batch(bad, self.quarantine_path, batch_id, fmt="json")
            emptied: list = []
            if parsed["keyed"]:
                emptied = lake.merge_evolving(self.spark, self.table_path, rows.where(has_key), key, list(self.order), self.keys_can_move, fields)
        finally:
            if rows is not None:
                rows.unpersist()
            batch.unpersist()
        self.metrics.add(run_row(JOB, self.name, self.job_id, started, counts, batch_id=batch_id, emptied_days=[str(d) for d in emptied]))

    def start(self, source: DataFrame, checkpoint: str, trigger: dict | None = None):
        w = source.writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
        return w.trigger(**(trigger or {"processingTime": "10 seconds"})).start()
