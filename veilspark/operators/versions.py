"""As-of policy versions: protect each record with the policy valid at its time.

The original tool keeps only the latest policy; replaying old data with it
re-protects history under today's rules.  Here a list of versions (policy,
valid-from time) is compiled into the plan: the version of a row is a CASE
over the sorted start times (a projection, no join and no shuffle), and each
field's protected value is a CASE over the version.  The versions are driver
objects whose expressions are compiled anyway, so their number is bounded by
what the driver holds; nothing grows with the data.

Rows older than the first version have no policy and are dropped, as records
that arrive before any policy are dropped by the streaming operator.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.randomness import row_seed
from veilspark.operators.protect import SEED_COL, json_output, json_stages, needs_seed, protected_columns, seed_for
from veilspark.policy import Policy


@dataclass(frozen=True)
class PolicyVersion:
    valid_from: dt.datetime
    policy: Policy
    label: str | None = None


def _ts_lit(t: dt.datetime, ts_type: str = "timestamp_ntz") -> Column:
    return F.lit(t.isoformat(sep=" ")).cast(ts_type)


def version_index(ts: Column, versions: list[PolicyVersion], ts_type: str = "timestamp_ntz") -> Column:
    """1-based index of the version valid at ``ts`` (0 before the first one)."""
    expr = None
    for i in range(len(versions), 0, -1):
        cond = ts >= _ts_lit(versions[i - 1].valid_from, ts_type)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(0)) if expr is not None else F.lit(0)


def apply_policy_asof(df: DataFrame, versions: list[PolicyVersion], ts_col: str, id_col: str | None = "id", *,
                      keep: list[str] | None = None, seed_col: Column | None = None,
                      hash_key: str | None = None) -> DataFrame:
    """Typed input: ``keep``, ``id_col``, ``policy_version`` and the union of all
    versions' fields (NULL where the row's version does not keep the field).
    A field whose output type differs between versions is returned as text."""
    versions = sorted(versions, key=lambda v: v.valid_from)
    keep = list(keep or [])
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    ts_type = dtypes[ts_col].simpleString()
    ver = version_index(F.col(ts_col), versions, ts_type)
    base = df.where(F.col(ts_col) >= _ts_lit(versions[0].valid_from, ts_type)).withColumn("policy_version", ver)
    fields: list[str] = []
    for v in versions:
        for n in v.policy.field_names():
            if n in dtypes and n != id_col and n not in keep and n not in fields:
                fields.append(n)
    if any(needs_seed(v.policy, [n for n in fields if n in v.policy.field_names()]) for v in versions):
        base = base.withColumn(SEED_COL, row_seed(seed_col))
    seed = F.col(SEED_COL)
    per_version = []
    for v in versions:
        own = [n for n in fields if n in v.policy.field_names()]
        per_version.append(protected_columns(dtypes, v.policy, own, seed, hash_key))
    # output type per field: common type of its versions, or text when they differ
    probe = base.select(*[c.alias(f"{n}__{i}") for i, cols in enumerate(per_version) for n, c in cols.items()]).schema
    out_cols = []
    for n in fields:
        types = {probe[f"{n}__{i}"].dataType for i, cols in enumerate(per_version) if n in cols}
        as_text = len(types) > 1
        expr = None
        for i, cols in enumerate(per_version, start=1):
            if n not in cols:
                continue
            c = cols[n].cast("string") if as_text else cols[n]
            cond = F.col("policy_version") == i
            expr = F.when(cond, c) if expr is None else expr.when(cond, c)
        out_cols.append(expr.alias(n))
    head = [F.col(f"`{c}`") for c in keep] + ([F.col(f"`{id_col}`")] if id_col and id_col in dtypes else [])
    return base.select(*head, "policy_version", *out_cols)


REASON_NO_POLICY = "no_policy"


def protect_json_asof(df: DataFrame, versions: list[PolicyVersion], ts: Column, value_col: str = "value", *,
                      keep: list[str] | None = None, seed_col: Column | None = None, hash_key: str | None = None,
                      output_col: str = "value", ts_type: str = "timestamp_ntz") -> DataFrame:
    """JSON records, each protected with the version valid at ``ts`` (a column
    of the input, e.g. the message timestamp, or an expression over it).

    One parse serves all versions: the stages are built for the union of the
    versions' fields and the output is a CASE over the version of
    per-version JSON expressions.  Output: ``keep``, ``policy_version``,
    ``output_col`` and ``reason`` (``no_policy`` before the first version)."""
    versions = sorted(versions, key=lambda v: v.valid_from)
    keep = list(keep or [])
    names: list[str] = []
    for v in versions:
        names += [n for n in v.policy.field_names() if n not in names]
    src = df.withColumn("__ver", version_index(ts, versions, ts_type))
    st = json_stages(src, names, value_col, keep + ["__ver"],
                     seed_for([v.policy for v in versions], seed_col))
    ver = F.col("__ver")
    out = None
    for i, v in enumerate(versions, start=1):
        expr = json_output(v.policy, names, hash_key)
        out = F.when(ver == i, expr) if out is None else out.when(ver == i, expr)
    reason = F.coalesce(F.col("__reason"), F.when(ver == 0, F.lit(REASON_NO_POLICY)))
    return st.select(*[F.col(f"`{c}`") for c in keep], ver.alias("policy_version"),
                     F.when(reason.isNull(), out).alias(output_col), reason.alias("reason"))


def versions_frame(spark, versions: list[PolicyVersion]) -> DataFrame:
    """The version list as a small table (label, valid_from, valid_to, digest)."""
    vs = sorted(versions, key=lambda v: v.valid_from)
    rows = []
    for i, v in enumerate(vs, start=1):
        nxt = vs[i].valid_from if i < len(vs) else None
        rows.append((i, v.label or v.policy.version or str(i), v.valid_from, nxt, v.policy.digest))
    schema = T.StructType([
        T.StructField("policy_version", T.IntegerType()), T.StructField("label", T.StringType()),
        T.StructField("valid_from", T.TimestampNTZType()), T.StructField("valid_to", T.TimestampNTZType()),
        T.StructField("digest", T.StringType()),
    ])
    return spark.createDataFrame(rows, schema)
