"""Lake-table operators: time columns, partitions, latest-wins upsert and schema evolution.

No table format with MERGE is available here, so the upsert is expressed with
plain DataFrame operations:

* the latest row per key is an aggregation ``max_by(row, ordering)``.  It is
  combined map-side before the shuffle, so a key that holds a third of all
  rows costs one row per map task, never one task holding the whole group
  (a ``row_number`` window would sort the whole hot group in one task);
* only the partitions that change are rewritten: those of the updates and those that
  the updates' keys live in now, which a key locator beside the table tells
  (:mod:`veilspark.operators.locator`);
* a merge is staged under the table's folder and then announced by one small file, written
  atomically.  Before that the table is as it was; from then on readers see the merged rows, from the
  staging folder until they are in place, and a merge that was interrupted is completed by the next one.
  One writer at a time is assumed.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.operators import values as V
from veilspark.operators.locator import KeyLocator, counted, no_null_key
from veilspark.operators.values import parse_json_text
from veilspark.policy import Policy
from veilspark.sources import storage

EVENT_DATE = "event_date"
PROCESSING_TS = "processing_timestamp"
PARTITION_COL = "event_date_prt"


RESERVED = (EVENT_DATE, PROCESSING_TS, PARTITION_COL)

#: Partition strategies: name -> partition value from the event time, the processing time and the rows' columns.
Partitioning = Callable[[Column, Column], Column]
_STRATEGIES: dict[str, Partitioning] = {
    "event": lambda event, now: F.to_date(event),
    "processing": lambda event, now: F.to_date(now),
    "hour": lambda event, now: F.date_format(event, "yyyy-MM-dd-HH"),
    "month": lambda event, now: F.date_format(event, "yyyy-MM"),
}


def register_partitioning(name: str, strategy: Partitioning) -> None:
    """Make a partition strategy known by name; writing, merging and pruning all go by the value it gives."""
    _STRATEGIES[name] = strategy


def partitioning(name: str, key: str | None = None) -> Partitioning:
    """A strategy by name; ``bucket:N`` deals the rows to N partitions by a hash of ``key``."""
    if name.startswith("bucket:"):
        n = int(name.split(":", 1)[1])
        if n < 1 or key is None:
            raise ValueError("bucket:N needs a positive N and a key")
        return lambda event, now: F.pmod(F.xxhash64(F.col(f"`{key}`").cast("string")), F.lit(n)).cast("int")
    if name not in _STRATEGIES:
        raise ValueError(f"unknown partition strategy {name!r}; known: {', '.join(sorted(_STRATEGIES))}, bucket:N")
    return _STRATEGIES[name]


def add_time_columns(df: DataFrame, event_ts_col: str, partition_from: str | Partitioning = "event", key: str | None = None) -> DataFrame:
    """Adds ``event_date`` (the original timestamp), ``processing_timestamp`` and the partition
    ``event_date_prt``: by default the day of the event; ``partition_from`` names another strategy or is one.

    Columns of ``df`` that have one of these names are kept under ``name__2`` (``name__3``, ..)."""
    taken = {c.lower() for c in df.columns} | set(RESERVED)
    for c in [c for c in df.columns if c.lower() in RESERVED and c != event_ts_col]:
        n = 2
        while f"{c}__{n}".lower() in taken:
            n += 1
        taken.add(f"{c}__{n}".lower())
        df = df.withColumnRenamed(c, f"{c}__{n}")
    now = F.current_timestamp()
    strategy = partition_from if callable(partition_from) else partitioning(partition_from, key)
    # the partition first: where the event time is itself one of these columns, it is still as it was
    return (df.withColumn(PARTITION_COL, strategy(F.col(f"`{event_ts_col}`"), now))
              .withColumn(EVENT_DATE, F.col(f"`{event_ts_col}`"))
              .withColumn(PROCESSING_TS, now))


def latest_per_key(df: DataFrame, key: list[str] | str, order: list[str] | str) -> DataFrame:
    """The row with the greatest ``order`` tuple for every key (ties broken by
    the later columns of ``order``).  A null key is equal to no other: such rows all stay."""
    key = [key] if isinstance(key, str) else list(key)
    order = [order] if isinstance(order, str) else list(order)
    payload = [c for c in df.columns if c not in key]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), F.struct(*[F.col(f"`{c}`") for c in order]))
    named = no_null_key(key)
    latest = df.where(named).groupBy(*key).agg(best.alias("__row")).select(*key, *[F.col(f"__row.`{c}`").alias(c) for c in payload])
    return latest.unionByName(df.where(~named).select(*key, *payload))


def evolve_union(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Union by column name; columns missing on either side become NULL, so new
    fields extend the schema and old fields stay readable."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def upsert_latest(existing: DataFrame, updates: DataFrame, key: list[str] | str,
                  order: list[str] | str) -> DataFrame:
    """Update-if-exists, insert-if-new: the latest row per key over both sides."""
    return latest_per_key(evolve_union(existing, updates), key, order)


def rebalance_days(df: DataFrame) -> DataFrame:
    """Cluster rows by day before a partitioned write, with AQE splitting a day
    that holds a large share of the rows and merging small ones: a bounded
    number of files per day, and no task that writes a hot day alone."""
    return df.hint("rebalance", PARTITION_COL)


def write_daily(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write partitioned by day; ``overwrite`` replaces only the days present in ``df``."""
    w = rebalance_days(df).write.mode(mode).partitionBy(PARTITION_COL)
    if mode == "overwrite":
        w = w.option("partitionOverwriteMode", "dynamic")
    w.parquet(path)


SCHEMA_FOLDER = "_schema"  # hidden from partition discovery
SCHEMA_FILE = "schema.json"
INTENT = "_intent.json"    # an announced merge that is not in place yet
STAGING = "_staging"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: the folder of rows without a partition value


def save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Keep the table's schema beside its data, so that reading it opens no data file."""
    storage.write_text(spark, f"{path.rstrip('/')}/{SCHEMA_FOLDER}/{SCHEMA_FILE}", schema.json())


def _schema_of(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def is_table(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path`` (its folder alone, say with a checkpoint in it, is none)."""
    found = storage.names(spark, path)
    return INTENT in found or SCHEMA_FOLDER in found or any(n.startswith(f"{PARTITION_COL}=") for n in found)


def _pending(spark: SparkSession, path: str) -> dict | None:
    text = storage.read_text(spark, f"{path.rstrip('/')}/{INTENT}")
    return json.loads(text) if text else None


def _in_place(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    path = path.rstrip("/")
    if schema is None:
        kept = storage.read_text(spark, f"{path}/{SCHEMA_FOLDER}/{SCHEMA_FILE}")
        if kept is None:
            if not any(n.startswith(f"{PARTITION_COL}=") for n in storage.names(spark, path)):
                raise ValueError(f"no table at {path}")
            return spark.read.option("mergeSchema", "true").parquet(path)
        schema = _schema_of(kept)
    return spark.read.schema(schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a partitioned table with its kept schema; without one, from all its files.

    An announced merge counts: its partitions are read from where they are staged."""
    path = path.rstrip("/")
    intent = _pending(spark, path)
    if intent is None:
        return _in_place(spark, path)
    schema = _schema_of(intent["schema"])
    staged = spark.read.schema(schema).parquet(f"{path}/{STAGING}/{intent['id']}/data")
    if not any(n.startswith(f"{PARTITION_COL}=") for n in storage.names(spark, path)):
        return staged
    rest = _in_place(spark, path, schema).where(~_in_days([_day(d, schema) for d in intent["days"]]))
    return rest.unionByName(staged)


def _in_days(days: list) -> Column:
    """Rows of the listed partitions; None stands for rows without a value."""
    some = [d for d in days if d is not None]
    out = F.coalesce(F.col(PARTITION_COL).isin(some), F.lit(False)) if some else F.lit(False)
    return out | F.col(PARTITION_COL).isNull() if any(d is None for d in days) else out


def _day(text: str | None, schema: T.StructType):
    """A partition value from its text, as a literal of the partition column's type."""
    return None if text is None else F.lit(text).cast(schema[PARTITION_COL].dataType)


def _partitions(df: DataFrame) -> list[str | None]:
    """The distinct partition values as text; there are as many as the table has partitions at most."""
    return [r[0] for r in df.select(F.col(PARTITION_COL).cast("string")).distinct().collect()]


def merge_into(spark: SparkSession, path: str, updates: DataFrame, key: list[str] | str,
               order: list[str] | str, keys_can_move: bool = True, schema: T.StructType | None = None) -> list:
    """Latest-wins upsert of ``updates`` (which must carry ``event_date_prt``)
    into the table at ``path``, made if there is none; rewrites the touched partitions only and
    returns those that were left without rows (and removed).

    The touched partitions become a constant filter on the partition column, so
    only those folders are read, and no join shuffles the table by partition.  They are the updates' own and
    those that the updates' keys live in: the key locator is asked for them and kept up.  Its first use
    reads the key columns of the whole table once.  ``keys_can_move=False`` (a key's partition never
    changes) does without.  Rows with a null key match no other: they are added.

    ``schema``: the types that the table is to have from now on (see :func:`merge_evolving`); where one of its
    columns changes its type, every partition is rewritten, once."""
    key = [key] if isinstance(key, str) else list(key)
    path = path.rstrip("/")
    complete_merge(spark, path)
    existing = _in_place(spark, path) if is_table(spark, path) else None
    if schema is None:
        schema = updates.schema if existing is None else widened_schema(existing.schema, updates.schema)
    updates = align_to(updates, schema)
    keys = updates.where(no_null_key(key)).select(*key).distinct()
    touched, locator, known = set(_partitions(updates)), None, 0
    if existing is not None:
        if any(schema[f.name].dataType != f.dataType for f in existing.schema.fields):
            touched |= set(_partitions(existing))
        elif keys_can_move:
            locator = KeyLocator.load(spark, path)
            if locator is None or not locator.fits(existing.schema, key, PARTITION_COL):
                locator = KeyLocator.build(spark, path, existing, key, PARTITION_COL)
            places = locator.locate(keys).groupBy(F.col("day").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("n")).collect()
            touched |= {r["day"] for r in places}
            known = sum(r["n"] for r in places)
    if not touched:
        return []
    days = sorted(touched, key=lambda d: (d is not None, d or ""))
    if existing is None:
        merged = latest_per_key(updates, key, order)
    else:
        merged = upsert_latest(align_to(existing.where(_in_days([_day(d, existing.schema) for d in days])), schema), updates, key, order)
    columns = [f.name for f in schema.fields if f.name in merged.columns]
    merged = merged.select(*[F.col(f"`{c}`") for c in columns])
    name = uuid.uuid4().hex
    staging = f"{path}/{STAGING}/{name}"
    rebalance_days(merged).write.mode("overwrite").partitionBy(PARTITION_COL).parquet(f"{staging}/data")
    staged = spark.read.schema(schema).parquet(f"{staging}/data")
    left = set(_partitions(staged))
    emptied = [d for d in days if d not in left]
    version, n_keys = None, 0
    if locator is not None:
        n_keys = keys.count()
        version = locator.meta["version"] + 1
        staged.join(counted(keys, n_keys), key, "left_semi").select(*key, F.col(PARTITION_COL).alias("day")).distinct().write.mode("overwrite").parquet(f"{staging}/keys")
    intent = {"id": name, "days": days, "emptied": emptied, "schema": schema.json(), "key": key, "version": version,
              "new_keys": max(0, n_keys - known)}
    storage.write_text(spark, f"{path}/{INTENT}", json.dumps(intent))
    complete_merge(spark, path)
    return [r[0] for r in spark.createDataFrame([(d,) for d in emptied], "d string").select(F.col("d").cast(schema[PARTITION_COL].dataType)).collect()] if emptied else []


def complete_merge(spark: SparkSession, path: str) -> bool:
    """Put an announced merge in place; True if there was one.  Each step can be repeated, so an interrupted one is done again."""
    path = path.rstrip("/")
    intent = _pending(spark, path)
    if intent is None:
        storage.delete(spark, [f"{path}/{STAGING}"] if storage.exists(spark, f"{path}/{STAGING}") else [])  # of a merge that was never announced
        return False
    schema = _schema_of(intent["schema"])
    staging = f"{path}/{STAGING}/{intent['id']}"
    write_daily(spark.read.schema(schema).parquet(f"{staging}/data"), path, mode="overwrite")
    # touched partitions left without rows (every key moved away) are not rewritten by a dynamic overwrite
    storage.delete(spark, [f"{path}/{PARTITION_COL}={NULL_FOLDER if d is None else d}" for d in intent["emptied"]])
    save_schema(spark, path, schema)
    locator = KeyLocator.load(spark, path)
    if locator is not None and intent["version"] is None:
        locator.forget()  # it was not kept up; the next merge that needs it builds it anew
    elif locator is not None:
        locator.append(spark.read.parquet(f"{staging}/keys"), intent["version"], intent["new_keys"])
        if locator.outgrown():
            KeyLocator.build(spark, path, _in_place(spark, path, schema), intent["key"], PARTITION_COL)
    storage.delete(spark, [f"{path}/{INTENT}"])
    storage.delete(spark, [f"{path}/{STAGING}"])
    return True


# Column type for a field, from the merged runtime type name of its values.
_SIMPLE_TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "STRING": "string", "BOOLEAN": "boolean"}


def _column_type(variant_type: str) -> str:
    if variant_type.startswith("DECIMAL"):
        return "double"
    return _SIMPLE_TYPES.get(variant_type, "string")


EXACT = 1 << 53  # whole numbers up to this one are doubles without loss


def _beyond_double(fv: Column) -> Column:
    """Whether a value is a whole number that a double might not hold."""
    whole = F.schema_of_variant(fv).rlike(r"^(BIGINT|DECIMAL\(\d+,0\))$")
    return F.coalesce(F.bool_or(whole & (F.abs(F.try_variant_get(fv, "$", "decimal(38,0)")) > F.lit(EXACT))), F.lit(False))


def _merged_type(variant_type: str | None, beyond: bool) -> str:
    """Column type from the merged type of a field's values; whole numbers that a double would round stay whole, or are text beside fractions."""
    t = variant_type or "VOID"
    if beyond and t != "BIGINT":
        return "string"
    return _column_type(t)


def record_fields(df: DataFrame, value_col: str = "value") -> DataFrame:
    """``field, fv`` for every field of every record."""
    m = F.try_variant_get(parse_json_text(F.col(f"`{value_col}`")), "$", "map<string,variant>")
    return df.select(F.explode(m).alias("field", "fv"))


def record_field_types(df: DataFrame, value_col: str = "value", only: list[str] | None = None) -> dict[str, str]:
    """Field name → column type over all JSON records of ``df``, or over the fields in ``only``.

    One aggregation keyed by field name (combined map-side), one row per distinct field: where names are
    data, choose the fields first (:func:`frequent_fields`).  Objects, arrays, fields with mixed types, all-null
    fields and whole numbers beyond 2^53 beside fractions become text."""
    rows = record_fields(df, value_col)
    if only is not None:
        rows = rows.where(F.col("field").isin(only) if only else F.lit(False))
    found = rows.groupBy("field").agg(F.schema_of_variant_agg("fv").alias("t"), _beyond_double(F.col("fv")).alias("beyond")).collect()
    return {r.field: _merged_type(r.t, r.beyond) for r in sorted(found, key=lambda r: r.field)}


def protected_types(df: DataFrame, policy: Policy, value_col: str = "value") -> dict[str, str]:
    """Field name → column type of the records that ``policy`` makes of the raw
    records ``df`` (or of records that it has made).  An operation fixes the type of what it writes; only
    fields that pass through are looked at, in one parse and one aggregation."""
    types, open_ = {"id": "string"}, []
    for r in policy.effective_rules():
        t = None
        if r.is_pii:
            t = {"hash": "string", "redact": "string", "generalize": "string"}.get(r.operation) or ("string" if r.type == "string" else None)
            if r.operation == "randomize":
                t = {"string": "string", "integer": "bigint", "int": "bigint", "double": "double", "float": "double"}.get(r.type)
        types[r.name] = t or "string"
        if t is None:
            open_.append(r.name)
    if open_:
        v = df.select(F.explode(F.array(parse_json_text(F.col(f"`{value_col}`")))).alias("__v"))
        v = v.select(*[V.variant_field(F.col("__v"), n).alias(f"f{i}") for i, n in enumerate(open_)])
        seen = v.agg(*[F.schema_of_variant_agg(f"f{i}").alias(f"t{i}") for i in range(len(open_))],
                     *[_beyond_double(F.col(f"f{i}")).alias(f"b{i}") for i in range(len(open_))]).first()
        for i, n in enumerate(open_):
            # integers beyond 64 bits are written as text
            big = re.match(r"DECIMAL\((\d+),0\)", seen[i] or "")
            types[n] = "string" if big and int(big[1]) > 18 else _merged_type(seen[i], seen[f"b{i}"])
    return types


def column_names(fields: list[str], known: dict[str, str] | None = None) -> list[str]:
    """Column names for fields.  A field that has a column already (``known``: field → column) keeps it; a
    new one that differs from a used name only in case, or has the name of a column that the table adds, gets a number."""
    known = dict(known or {})
    used = {c.lower() for c in known.values()} | set(RESERVED)
    for f in fields:
        if f not in known:
            n, name = 1, f
            while name.lower() in used:
                n += 1
                name = f"{f}__{n}"
            used.add(name.lower())
            known[f] = name
    return [known[f] for f in fields]


def field_columns(schema: T.StructType) -> dict[str, str]:
    """Field → column of a table that records were made into; the field stands in the column's metadata."""
    return {f.metadata["field"]: f.name for f in schema.fields if "field" in (f.metadata or {})}


def records_to_columns(df: DataFrame, types: dict[str, str], value_col: str = "value", columns: dict[str, str] | None = None,
                       others: str | None = None) -> DataFrame:
    """JSON records as typed columns (one parse); text columns hold strings as
    they are and other values as compact JSON text (objects in their original
    key order).  ``columns``: field → column where a field has one already; ``others``: a map column
    with every field that is not in ``types``, by its name."""
    names = list(types)
    columns = column_names(names, columns)
    parsed = df.select(F.col(f"`{value_col}`").alias("__raw"),
                       F.explode(F.array(parse_json_text(F.col(f"`{value_col}`")))).alias("__v"))
    parsed = parsed.where(F.col("__v").isNotNull())
    rest = []
    if others:
        all_fields = F.try_variant_get(F.col("__v"), "$", "map<string,variant>")
        rest = [F.map_filter(all_fields, lambda k, _: ~k.isin(names)).alias("__others")]
    fields = parsed.select("__raw", *rest, *[V.variant_field(F.col("__v"), n).alias(f"__f{i}") for i, n in enumerate(names)])
    text_fields = [i for i, n in enumerate(names) if types[n] == "string"]
    schemas = fields.select("__raw", *([F.col("__others")] if others else []), *[F.col(f"__f{i}") for i in range(len(names))],
                            *[F.schema_of_variant(f"__f{i}").alias(f"__s{i}") for i in text_fields])
    cols = []
    for i, n in enumerate(names):
        if types[n] == "string":
            kind = V.kind_sql(f"`__f{i}`", f"`__s{i}`")
            cols.append(F.expr(V.text_sql(f"`__f{i}`", f"({kind})", "`__raw`", n)).alias(columns[i]))
        else:
            cols.append(F.try_variant_get(F.col(f"__f{i}"), "$", types[n]).alias(columns[i]))
    if others:
        cols.append(F.when(F.size("__others") > 0, F.col("__others")).alias(others))
    return schemas.select(*cols)


WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FRACTIONAL = (T.FloatType, T.DoubleType)


def common_type(a: T.DataType, b: T.DataType, exact: bool = True) -> T.DataType:
    """The type that holds the values of both: whole numbers and fractions widen to double where all of
    the whole ones are ``exact`` as doubles, anything else becomes text."""
    if a == b:
        return a
    if isinstance(a, WHOLE) and isinstance(b, WHOLE):
        return T.LongType()
    numbers = isinstance(a, (*WHOLE, *FRACTIONAL)) and isinstance(b, (*WHOLE, *FRACTIONAL))
    return T.DoubleType() if numbers and exact else T.StringType()


def widened_schema(table: T.StructType, incoming: T.StructType, rounded: frozenset[str] = frozenset()) -> T.StructType:
    """The table's fields with types that also hold the incoming values, then new fields.  ``rounded``: columns
    with a whole number that a double would round."""
    new = {f.name: f.dataType for f in incoming.fields}
    known = [T.StructField(f.name, common_type(f.dataType, new.get(f.name, f.dataType), f.name not in rounded), True, f.metadata) for f in table.fields]
    names = {f.name for f in table.fields}
    return T.StructType(known + [f for f in incoming.fields if f.name not in names])


def _rounded(existing: DataFrame, updates: DataFrame) -> frozenset[str]:
    """Columns that are whole on one side and fractional on the other, with a whole number beyond 2^53."""
    new = {f.name: f.dataType for f in updates.schema.fields}
    out: set[str] = set()
    for side, other in ((existing, new), (updates, {f.name: f.dataType for f in existing.schema.fields})):
        asked = [f.name for f in side.schema.fields if isinstance(f.dataType, T.LongType) and isinstance(other.get(f.name), FRACTIONAL)]
        if asked:  # one column's smallest and largest value each: read from the files' statistics where they have them
            r = side.agg(*[F.min(f"`{c}`").alias(f"l{i}") for i, c in enumerate(asked)], *[F.max(f"`{c}`").alias(f"h{i}") for i, c in enumerate(asked)]).first()
            out |= {c for i, c in enumerate(asked) if r[f"l{i}"] is not None and (r[f"l{i}"] < -EXACT or r[f"h{i}"] > EXACT)}
    return frozenset(out)


def align_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``df`` in the types of ``schema``, which hold all their values."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if df.schema[c].dataType != types[c] else F.col(f"`{c}`") for c in df.columns])


def merge_evolving(spark: SparkSession, path: str, updates: DataFrame, key: list[str] | str, order: list[str] | str,
                   keys_can_move: bool = True, fields: dict[str, str] | None = None) -> list:
    """:func:`merge_into`, also where columns are new or have another type than
    the table's: the type widens (whole numbers to double where no digit is lost, else to text), nothing is cast down.
    Makes the table if there is none.  ``fields`` (field → column) is kept with the table's schema."""
    complete_merge(spark, path)
    if is_table(spark, path):
        existing = _in_place(spark, path)
        schema = widened_schema(existing.schema, updates.schema, _rounded(existing, updates))
    else:
        schema = updates.schema
    by_column = {c: f for f, c in (fields or {}).items()}
    schema = T.StructType([T.StructField(f.name, f.dataType, True, {**(f.metadata or {}), "field": by_column[f.name]} if f.name in by_column else f.metadata)
                           for f in schema.fields])
    return merge_into(spark, path, updates, key, order, keys_can_move, schema)
