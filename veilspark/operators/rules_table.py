"""Policies as data: rule columns instead of compiled rules, as-of joined from a table of versions.

A compiled policy puts every version into the plan; a table of versions (per tenant, say) has any number of
rows and the plan stays as it is.  The rule of a field is then a column of the row: a struct with
the attributes of :class:`veilspark.policy.Rule` that decide what an operation writes (``RULE``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.functions.masking import hash_text, mask_text, redacted
from veilspark.functions.randomness import random_alnum, randomize_double, randomize_int32, row_seed, uniform
from veilspark.operators import values as V
from veilspark.operators.protect import parse_records

RULE = "struct<is_pii:boolean,operation:string,type:string,mask_format:string,ranges:array<int>>"
REASON_NO_POLICY = "no_policy"


def mask_by_format(text: Column, fmt: Column) -> Column:
    """The position mask with the format as a column: characters under an X or x stay, all others become a star."""
    shown = F.lower(fmt)
    masked = F.array_join(F.transform(F.split(text, ""), lambda c, i: F.when(F.substring(shown, i + 1, F.lit(1)) == "x", c).otherwise("*")), "")
    return F.when(F.length(text) == 0, text).otherwise(masked)


def range_label_of(x: Column, ranges: Column) -> Column:
    """The range label with the boundaries as a column."""
    b = F.array_sort(F.array_distinct(ranges))
    below = F.size(F.filter(b, lambda v: v <= x))  # boundaries at or below the value
    return (F.when(below == 0, F.concat(F.lit("<"), F.get(b, F.lit(0)).cast("string")))
            .when(below == F.size(b), F.concat(F.get(b, below - 1).cast("string"), F.lit("+")))
            .otherwise(F.concat(F.get(b, below - 1).cast("string"), F.lit("-"), F.get(b, below).cast("string"))))


def _written(fv: V.FieldValue, rule: Column, seed: Column, same: Column, wrap: Callable[[Column], Column], nothing: Column) -> Column:
    """What the rule column's operation writes; ``same``: the value as it is, ``wrap``: a result in the output's form."""
    text, op, kind = fv.text, rule["operation"], rule["type"]
    is_text = kind == "string"
    default = F.when(is_text, wrap(mask_text(text, None))).otherwise(same)
    random = (F.when(is_text, wrap(random_alnum(F.length(text), seed)))
              .when(kind.isin("integer", "int"), wrap(randomize_int32(fv.int32, uniform(seed, 1))))
              .when(kind.isin("double", "float"), wrap(randomize_double(fv.dbl, uniform(seed, 2)))).otherwise(same))
    some = F.coalesce(F.size(rule["ranges"]) > 0, F.lit(False))
    formatted = is_text & F.coalesce(F.length(rule["mask_format"]) > 0, F.lit(False))
    return (F.when(~F.coalesce(rule["is_pii"], F.lit(False)), same)
            .when(op == "mask", F.when(formatted, wrap(mask_by_format(text, rule["mask_format"]))).otherwise(default))
            .when(op == "hash", wrap(hash_text(text, fv.hash_key)))
            .when(op == "redact", F.when(is_text, wrap(redacted())).otherwise(nothing))
            .when(op == "generalize", wrap(F.when(some, range_label_of(fv.int32, rule["ranges"])).otherwise(text)))
            .when(op == "randomize", random)
            .otherwise(default))


def by_rule(fv: V.FieldValue, rule: Column) -> Column:
    """A typed value as its rule column has it, as text; null without a rule.  The same values as the compiled operations write."""
    out = _written(fv, rule, F.xxhash64(fv.seed, F.lit(fv.name)), fv.text, lambda c: c.cast("string"), F.lit(None).cast("string"))
    return F.when(rule.isNotNull() & fv.present, out)


MAX_BROADCAST_RULES = 100_000
SALTS = 32


def protect_json_by_table(df: DataFrame, rules: DataFrame, value_col: str = "value", *, seed_col: Column | None = None, hash_key: str | None = None) -> DataFrame:
    """Good records as JSON text, protected by a table of rules (``position, name, is_pii, operation, type, mask_format,
    ranges``): what :func:`veilspark.operators.protect.apply_policy_json` gives for the same rules compiled.

    Records are taken apart into fields, each field meets its rule by name, is rewritten, and a record's fields
    are put together again in the order of the rules (``id`` first).  A record is named by its place in the input meanwhile, so ``df`` should
    read files or a written table.  Fields without a rule are dropped; the first of repeated rules wins; a rule for
    ``id`` has no effect.  The rules go to the fields below a counted size.  Beyond it both are shuffled by name, and as a field may be in every record, its rows
    are dealt to ``SALTS`` parts with a copy of the rule each."""
    rule = F.struct("is_pii", "operation", "type", "mask_format", "ranges").cast(RULE)
    first = (rules.where("name is not null and name <> 'id'").groupBy(F.col("name").alias("field"))
             .agg(F.min("position").alias("pos"), F.min_by(rule, "position").alias("rule")))
    parsed = parse_records(df, value_col).where(F.col("__reason").isNull())
    members = F.map_entries(F.map_filter(F.try_variant_get(F.col("__v"), "$", "map<string,variant>"), lambda k, _: k != F.lit("id")))
    keys = F.json_object_keys("__raw")
    # the entry without a name stands for the record itself, so that one without a listed field stays
    own = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("__id").cast("variant").alias("value")))
    each = parsed.select("__raw", F.monotonically_increasing_id().alias("__rec"), (F.size(keys) == F.size(F.array_distinct(keys))).alias("__single"),
                         (seed_col if seed_col is not None else F.rand()).alias("__seed"), F.concat(own, members).alias("__m"))
    each = each.select("__raw", "__rec", "__single", "__seed", F.explode("__m").alias("m")).select("*", F.col("m.key").alias("field"), F.col("m.value").alias("fv"))
    each = each.withColumn("kind", V.variant_kind(F.col("fv")))
    # objects and arrays in their original key order, unless a key of the record repeats
    raw = F.call_function("get_json_object", F.col("__raw"), F.concat(F.lit("$['"), F.col("field"), F.lit("']")))
    container = F.coalesce(F.when(F.col("__single") & ~F.col("field").contains("'"), raw), F.to_json("fv"))
    each = each.select("__rec", "field", "fv", "kind", V.variant_text(F.col("fv"), F.col("kind"), container).alias("text"),
                       F.xxhash64("__seed", "field").alias("seed"))
    if first.count() <= MAX_BROADCAST_RULES:
        met = each.join(F.broadcast(first), "field", "left")
    else:
        copies = first.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        # the record's own entry has no name: spread by record, it meets nothing
        met = each.withColumn("__salt", F.pmod("__rec", F.lit(SALTS)).cast("int")).join(copies, ["field", "__salt"], "left")
    met = met.where("field is null or pos is not null")
    value = V.json_value(F.col("fv"), F.col("kind"), F.col("text"), "", F.col("seed"), hash_key)
    written = _written(value, F.col("rule"), F.col("seed"), value.passthrough, value.out, value.null_out)
    out = F.when(F.col("field").isNull(), F.col("fv")).when(value.present, written).otherwise(F.col("fv"))
    pair = F.to_json(F.create_map(F.coalesce("field", F.lit("id")), out))
    piece = F.struct(F.coalesce("pos", F.lit(-1)).alias("pos"), F.substring(pair, F.lit(2), F.length(pair) - 2).alias("text"))
    whole = met.select("__rec", piece.alias("piece")).groupBy("__rec").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    return whole.select(F.concat(F.lit("{"), F.array_join("pieces.text", ","), F.lit("}")).alias("value"))


def asof_join(events: DataFrame, versions: DataFrame, by: list[str], ts: str, valid_from: str, tie: list[str] | None = None,
              width: int = 86_400, salts: int = 8) -> DataFrame:
    """``events`` plus ``version``: the row of ``versions`` (as a struct) that is the latest of its ``by`` at or before ``ts``; null
    before the first.  Of versions with one ``valid_from`` the greatest by ``tie`` counts.

    Time is cut into stretches of ``width`` seconds.  Inside a stretch the last version is carried along the rows; what a stretch
    starts with is carried from stretch to stretch (a row for each and ``by``).  The events of a stretch are dealt to ``salts``
    tasks with a copy of its versions each, so neither a tenant nor a day of a tenant with a third of all rows is one task's.
    No version meets an event but in a window, so nulls in ``by`` are equal to each other; events without a time have no version."""
    columns = [c for c in versions.columns]
    stretch = lambda c: F.floor(F.unix_seconds(F.col(f"`{c}`").cast("timestamp")) / width)
    payload = F.struct(*[F.col(f"`{c}`") for c in columns])
    order = F.struct(*[F.col(f"`{c}`") for c in (tie or [valid_from])])
    v = (versions.where(F.col(f"`{valid_from}`").isNotNull()).groupBy(*by, F.col(f"`{valid_from}`").cast("timestamp").alias("__at"), stretch(valid_from).alias("__stretch"))
         .agg(F.max_by(payload, order).alias("__v")))
    e = events.select(*by, F.col(f"`{ts}`").cast("timestamp").alias("__at"), stretch(ts).alias("__stretch"),
                      F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in events.columns]), F.lit(salts)).cast("int").alias("__salt"),
                      F.struct(*[F.col(f"`{c}`") for c in events.columns]).alias("__e"))
    # stretch -> the version that is valid when it starts
    ends = v.groupBy(*by, "__stretch").agg(F.max_by("__v", "__at").alias("__last"))
    wanted = e.where("__stretch is not null").select(*by, "__stretch").distinct().withColumn("__ask", F.lit(True))
    both = wanted.withColumn("__last", F.lit(None).cast(ends.schema["__last"].dataType)).unionByName(ends.withColumn("__ask", F.lit(False)))
    both = both.groupBy(*by, "__stretch").agg(F.max("__ask").alias("__ask"), F.first("__last", ignorenulls=True).alias("__last"))
    earlier = W.partitionBy(*by).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    starts = both.withColumn("__v", F.last("__last", ignorenulls=True).over(earlier)).where("__ask and __v is not null")
    starts = starts.select(*by, F.lit(None).cast("timestamp").alias("__at"), "__stretch", "__v")
    known = starts.unionByName(v.select(*by, "__at", "__stretch", "__v")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = e.withColumn("__v", F.lit(None).cast(known.schema["__v"].dataType)).unionByName(known.withColumn("__e", F.lit(None).cast(e.schema["__e"].dataType)))
    # versions come before events of the same time, and what a stretch starts with before all
    along = (W.partitionBy(*by, "__stretch", "__salt").orderBy(F.col("__at").asc_nulls_first(), F.col("__e").isNotNull())
             .rowsBetween(W.unboundedPreceding, W.currentRow))
    done = rows.withColumn("version", F.last("__v", ignorenulls=True).over(along)).where("__e is not null")
    return done.select("__e.*", F.when(F.col("__stretch").isNotNull(), F.col("version")).alias("version"))


def protect_asof_table(events: DataFrame, versions: DataFrame, by: list[str], ts: str, fields: list[str], *, valid_from: str = "valid_from",
                       rules: str = "rules", label: str = "label", tie: list[str] | None = None, keep: list[str] | None = None,
                       seed_col: Column | None = None, hash_key: str | None = None, width: int = 86_400, salts: int = 8) -> DataFrame:
    """``keep`` columns, ``policy_version`` (the version's ``label``), ``fields`` as text, each as the rule of its name in the version's
    ``rules`` map has it (null without one), and ``reason``: ``no_policy`` for rows before the first version, which stay."""
    dtypes = {f.name: f.dataType for f in events.schema.fields}
    joined = asof_join(events, versions, by, ts, valid_from, tie, width, salts)
    joined = joined.withColumn("__seed", row_seed(seed_col))
    out = []
    for n in fields:
        fv = V.typed_value(F.col(f"`{n}`"), n, dtypes[n], F.col("__seed"), hash_key)
        out.append(by_rule(fv, F.col(f"version.`{rules}`")[n]).alias(n))
    return joined.select(*[F.col(f"`{c}`") for c in keep or []], F.col(f"version.`{label}`").alias("policy_version"), *out,
                         F.when(F.col("version").isNull(), F.lit(REASON_NO_POLICY)).alias("reason"))
