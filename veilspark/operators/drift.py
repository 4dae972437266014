"""Schema drift: undeclared fields and runtime type profile of JSON records.

Both reports are one aggregation keyed by a field name (and a type name).
The key space is the set of distinct field names, which is small even when a
single field appears in every record, and the aggregation is combined
map-side before the shuffle, so a hot key costs one row per map task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.operators import values as V
from veilspark.policy import Policy


def undeclared_fields(value: Column, policy: Policy) -> Column:
    """Keys of the JSON object that no rule names (``id`` counts as declared).

    NULL for text that is not a JSON object."""
    keys = F.array_distinct(F.json_object_keys(value))
    declared = sorted(policy.declared_names())
    return F.array_except(keys, F.array(*[F.lit(n) for n in declared]).cast("array<string>"))


def with_undeclared(df: DataFrame, policy: Policy, value_col: str = "value") -> DataFrame:
    return df.withColumn("undeclared", undeclared_fields(F.col(value_col), policy))


def drift_report(df: DataFrame, policy: Policy, value_col: str = "value") -> DataFrame:
    """``(field, n_records)``: how many records carry each undeclared field."""
    und = df.select(F.explode(undeclared_fields(F.col(value_col), policy)).alias("field"))
    return und.groupBy("field").agg(F.count(F.lit(1)).alias("n_records"))


def sql_type_of(fv: Column, schema: Column) -> Column:
    """SQL type name of a runtime JSON value, given its ``schema_of_variant``: STRING, INT,
    BIGINT, DOUBLE, BOOLEAN; null, containers and integers beyond 64 bits are STRING.
    The value itself is read again only where its size decides."""
    beyond = F.abs(F.try_variant_get(fv, "$", "decimal(38,0)")) >= F.lit(V.TWO_POW_63).cast("decimal(38,0)")
    return (
        F.when(schema == "STRING", F.lit("STRING"))
        .when(schema == "BIGINT", F.when(F.try_variant_get(fv, "$", "int").isNotNull(), F.lit("INT")).otherwise(F.lit("BIGINT")))
        .when(schema.isin("DOUBLE", "BOOLEAN"), schema)
        .when(~schema.startswith("DECIMAL"), F.lit("STRING"))
        .when(schema.endswith(",0)") & beyond, F.lit("STRING"))
        .otherwise(F.lit("DOUBLE"))
    )


def field_types(df: DataFrame, value_col: str = "value", include_id: bool = False, keep: list[str] | None = None) -> DataFrame:
    """One row per (record, field): ``keep`` columns, ``field`` and ``sql_type``.

    Text that is not a JSON object yields no rows.  A repeated key counts
    once, with its last value (the parse keeps the last one)."""
    carry = [F.col(f"`{c}`") for c in keep or []]
    m = F.try_variant_get(V.parse_json_text(F.col(f"`{value_col}`")), "$", "map<string,variant>")
    rows = df.select(*carry, F.explode(m).alias("field", "fv"))
    rows = rows if include_id else rows.where(F.col("field") != "id")
    named = rows.select(*carry, "field", "fv", F.schema_of_variant("fv").alias("s"))
    return named.select(*carry, "field", sql_type_of(F.col("fv"), F.col("s")).alias("sql_type"))


def type_profile(df: DataFrame, value_col: str = "value", include_id: bool = False) -> DataFrame:
    """``(field, sql_type, n_values)`` over all records."""
    return field_types(df, value_col, include_id).groupBy("field", "sql_type").agg(F.count(F.lit(1)).alias("n_values"))


def sql_type_name(dtype: T.DataType) -> str:
    """SQL type name of a typed column, in the same vocabulary."""
    if isinstance(dtype, T.StringType):
        return "STRING"
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        return "INT"
    if isinstance(dtype, T.LongType):
        return "BIGINT"
    if isinstance(dtype, T.DoubleType):
        return "DOUBLE"
    if isinstance(dtype, T.FloatType):
        return "FLOAT"
    if isinstance(dtype, T.BooleanType):
        return "BOOLEAN"
    if isinstance(dtype, T.DateType):
        return "DATE"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP(3)"
    return "STRING"


def table_type_profile(df: DataFrame) -> DataFrame:
    """``(field, sql_type, n_values)`` for a typed table: one aggregation pass
    counting non-null values of every column, then an unpivot of that one row."""
    counts = df.agg(*[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(df.schema.fields)])
    rows = [F.struct(F.lit(f.name).alias("field"), F.lit(sql_type_name(f.dataType)).alias("sql_type"),
                     F.col(f"c{i}").alias("n_values")) for i, f in enumerate(df.schema.fields)]
    return counts.select(F.inline(F.array(*rows)))


# rules tables larger than this are joined with a shuffle instead of a broadcast
MAX_BROADCAST_RULES = 100_000


def field_inventory(df: DataFrame, policy: Policy, value_col: str = "value", spark=None) -> DataFrame:
    """``(field, n_records, declared, is_pii, operation)`` for every key seen in
    the records: the per-field rule lookup of the original tool as an equi-join
    of observed keys with the rules table (first rule per name).

    Keys are counted first (combined map-side), so the join sees one row per
    distinct key.  The rules side is broadcast only below a checked size.
    """
    from veilspark.policy import rules_frame

    spark = spark or df.sparkSession
    keys = (df.select(F.explode(F.array_distinct(F.json_object_keys(F.col(value_col)))).alias("field"))
              .groupBy("field").agg(F.count(F.lit(1)).alias("n_records")))
    firsts = {}
    for r in policy.rules:
        if r.name and r.name not in firsts:
            firsts[r.name] = r
    rules = rules_frame(spark, Policy.from_rules(list(firsts.values()))).select(
        F.col("name").alias("field"), F.lit(True).alias("declared"), "is_pii", "operation")
    if len(firsts) <= MAX_BROADCAST_RULES:
        rules = F.broadcast(rules)
    out = keys.join(rules, "field", "left")
    is_id = F.col("field") == "id"
    return out.select(
        "field", "n_records",
        (F.coalesce(F.col("declared"), F.lit(False)) | is_id).alias("declared"),
        F.when(is_id, F.lit(False)).otherwise(F.coalesce(F.col("is_pii"), F.lit(False))).alias("is_pii"),
        F.when(is_id | ~F.coalesce(F.col("is_pii"), F.lit(False)), F.lit(None).cast("string"))
         .otherwise(F.col("operation")).alias("operation"),
    )
