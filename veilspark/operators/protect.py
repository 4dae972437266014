"""Apply a policy to a DataFrame — the flagship operator.

Two inputs are supported:

* **typed columns** (:func:`apply_policy`): each kept column is protected by
  its rule; the runtime type is the column type.
* **JSON text** (:func:`apply_policy_json`): a ``value`` column holds one JSON
  object per row, as read from a message queue or text files.  The text is
  parsed once into a VARIANT, the id rule and allow-list are applied, the
  sensitive fields are rewritten and the record is written back as JSON.

Both compile the policy to a few stacked projections of built-in expressions:
no shuffle, no Python worker, generated code (random text is kept in its own
projection, see :func:`apply_policy`; very large JSON output expressions fall
back to per-operator code, see ``veilspark.session``).  The work is a narrow
map, so it scales linearly with input partitions and needs no tuning beyond
the scan split size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions import registry
from veilspark.functions.randomness import row_seed
from veilspark.operators import values as V
from veilspark.policy import Policy, Rule

REASON_PARSE = "parse_error"
REASON_TOO_DEEP = "too_deep"
REASON_LONG_NUMBER = "long_number"
REASON_TOO_LARGE = "too_large"
REASON_MISSING_ID = "missing_id"


def _c(name: str) -> Column:
    """A column by its exact name (dots and blanks are part of the name)."""
    return F.col(f"`{name}`")


def _protect(fv: V.FieldValue, rule: Rule | None) -> Column:
    if rule is None or not rule.is_pii:
        return fv.passthrough
    out = F.when(fv.present, registry.build(fv, rule))
    return out if fv.fallback is None else out.otherwise(fv.fallback)


def _uses_random_text(rule: Rule | None) -> bool:
    return bool(rule and rule.is_pii and rule.operation == "randomize" and rule.type == "string")


# ---------------------------------------------------------------------------
# typed columns
# ---------------------------------------------------------------------------
def protected_columns(dtypes: dict, policy: Policy, fields: list[str], seed: Column,
                      hash_key: str | Column | None = None) -> dict[str, Column]:
    """Protected expression of each typed field (by name), in ``fields`` order."""
    out: dict[str, Column] = {}
    for n in fields:
        fv = V.typed_value(F.col(f"`{n}`"), n, dtypes[n], seed, hash_key)
        out[n] = _protect(fv, policy.rule(n)).alias(n)
    return out


def needs_seed(policy: Policy, fields: list[str]) -> bool:
    """Whether any of ``fields`` is randomized (and so needs a per-row seed)."""
    return any(policy.rule(n).is_pii and policy.rule(n).operation == "randomize"  # type: ignore[union-attr]
               for n in fields if policy.rule(n) is not None)


SEED_COL = "__veil_seed"


def apply_policy(df: DataFrame, policy: Policy, id_col: str | None = "id", *,
                 seed_col: Column | None = None, hash_key: str | Column | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Protect a typed DataFrame.

    Output columns: ``keep`` columns (carried unchanged, e.g. partition keys),
    then ``id_col`` unchanged, then every policy field present in ``df`` in
    policy order.  Columns without a rule are dropped (allow-list).  A rule
    for the id column has no effect, as in the original tool.
    """
    dtypes = dict((f.name, f.dataType) for f in df.schema.fields)
    keep = list(keep or [])
    fields = [n for n in policy.field_names() if n in dtypes and n != id_col and n not in keep]
    base = df.withColumn(SEED_COL, row_seed(seed_col)) if needs_seed(policy, fields) else df
    seed = F.col(SEED_COL)
    head = [F.col(f"`{c}`") for c in keep] + ([F.col(f"`{id_col}`")] if id_col and id_col in dtypes else [])
    cols = protected_columns(dtypes, policy, fields, seed, hash_key)
    texty = [n for n in fields if _uses_random_text(policy.rule(n))]
    if not texty:
        return base.select(*head, *cols.values())
    # random text uses a lambda, which leaves whole-stage codegen; it gets its
    # own projection so the other columns stay in the generated code.
    staged = base.select(*head, *[cols[n] if n not in texty else F.col(f"`{n}`") for n in fields], seed)
    texty_cols = protected_columns(dtypes, policy, texty, seed, hash_key)
    final = [texty_cols[n] if n in texty else F.col(f"`{n}`") for n in fields]
    return staged.select(*head, *final)


# ---------------------------------------------------------------------------
# JSON text
# ---------------------------------------------------------------------------
def parse_records(df: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse once: adds ``__v`` (VARIANT) and ``__id`` (id text) and ``__reason``.

    The parse sits under a generator so that later filters on the id cannot be
    pushed below it and parse the text a second time.
    """
    keep = list(keep or [])
    parsed = df.select(*[_c(c) for c in keep], _c(value_col).alias("__raw"),
                       F.explode(F.array(V.parse_json_text(_c(value_col)))).alias("__v"))
    idv = V.variant_field(F.col("__v"), "id")
    with_id = parsed.select("*", idv.alias("__idv"), F.schema_of_variant(idv).alias("__ids"))
    bad = F.col("__v").isNull()
    reason = (F.when(bad & (F.octet_length("__raw") > V.MAX_BYTES), F.lit(REASON_TOO_LARGE))
              .when(bad & (V.nesting_depth(F.col("__raw")) > V.MAX_DEPTH), F.lit(REASON_TOO_DEEP))
              .when(bad & V.outside_strings(F.col("__raw")).rlike("[0-9]{%d}" % (V.MAX_DIGITS + 1)), F.lit(REASON_LONG_NUMBER))
              .when(F.col("__v").isNull(), F.lit(REASON_PARSE))
              .when(F.col("__idv").isNull(), F.lit(REASON_MISSING_ID)))
    return with_id.select(*[_c(c) for c in keep], "__raw", "__v", V.id_text(F.col("__idv"), "__raw").alias("__id"),
                          reason.alias("__reason"))


def json_stages(df: DataFrame, names: list[str], value_col: str = "value", keep: list[str] | None = None,
                seed: Column | None = None) -> DataFrame:
    """Parse once and prepare every named field for the operations.

    Output: ``keep`` columns, ``__raw``, ``__id``, ``__reason``, ``__seed`` and,
    per field ``i`` of ``names``, its raw VARIANT ``__f{i}``, runtime kind
    ``__k{i}`` and text ``__t{i}``.  Each step is its own projection so that
    the parse, the type name and the text are computed once per field and
    shared by every expression that reads them."""
    keep = list(keep or [])
    carry = keep + ["__raw"]
    parsed = parse_records(df, value_col, keep)
    v = F.col("__v")
    head = [_c(c) for c in carry] + [F.col("__id"), F.col("__reason")]
    st1 = parsed.select(*head, (seed if seed is not None else F.lit(0).cast("bigint")).alias("__seed"),
                        *[V.variant_field(v, n).alias(f"__f{i}") for i, n in enumerate(names)])
    head = head + [F.col("__seed")]
    fvs = [F.col(f"__f{i}") for i in range(len(names))]
    st2a = st1.select(*head, *[c for i, fv in enumerate(fvs)
                               for c in (fv, F.schema_of_variant(fv).alias(f"__s{i}"))])
    # kind and text are fixed per field: one SQL expression each builds fast for wide policies
    st2 = st2a.select(*head, *[c for i, (n, fv) in enumerate(zip(names, fvs))
                               for c in (fv, F.expr(V.kind_sql(f"`__f{i}`", f"`__s{i}`", "`__raw`", n)).alias(f"__k{i}"))])
    texts = []
    for i, (n, fv) in enumerate(zip(names, fvs)):
        texts += [fv, F.col(f"__k{i}"),
                  F.expr(V.text_sql(f"`__f{i}`", f"`__k{i}`", "`__raw`", n)).alias(f"__t{i}")]
    return st2.select(*head, *texts)


def json_output(policy: Policy, names: list[str], hash_key: str | Column | None = None) -> Column:
    """The protected record as JSON text, from the columns of :func:`json_stages`
    (``names`` is the field list the stages were built for)."""
    fields: list[Column] = [F.col("__id").alias("id")]
    for n in policy.field_names():
        i = names.index(n)
        fv = V.json_value(F.col(f"__f{i}"), F.col(f"__k{i}"), F.col(f"__t{i}"), n, F.col("__seed"), hash_key)
        fields.append(_protect(fv, policy.rule(n)).alias(n))
    return F.to_json(F.struct(*fields))


def seed_for(policies: list[Policy], seed_col: Column | None) -> Column | None:
    """A per-row seed column when any policy randomizes, else None."""
    random = any(r.is_pii and r.operation == "randomize" for p in policies for r in p.effective_rules())
    return row_seed(seed_col) if random else None


def protect_json(df: DataFrame, policy: Policy, value_col: str = "value", *, keep: list[str] | None = None,
                 seed_col: Column | None = None, hash_key: str | Column | None = None,
                 output_col: str = "value", with_raw: bool = False, compiled: Column | None = None) -> DataFrame:
    """All records with the protected JSON in ``output_col`` (NULL for rejected
    records) and ``reason`` (NULL for good records); ``with_raw`` also carries
    the input text as ``raw``.  ``compiled`` is a reusable
    ``json_output(policy, policy.field_names(), hash_key)`` built earlier for
    the same policy (a stream reuses it across micro-batches)."""
    keep = list(keep or [])
    names = policy.field_names()
    st = json_stages(df, names, value_col, keep, seed_for([policy], seed_col))
    body = compiled if compiled is not None else json_output(policy, names, hash_key)
    out = F.when(F.col("__reason").isNull(), body)
    raw = [F.col("__raw").alias("raw")] if with_raw else []
    return st.select(*[_c(c) for c in keep], out.alias(output_col), F.col("__reason").alias("reason"), *raw)


def apply_policy_json(df: DataFrame, policy: Policy, value_col: str = "value", **kw) -> DataFrame:
    """Good records only, as the original tool emits them: one JSON text column."""
    out_col = kw.pop("output_col", "value")
    keep = kw.get("keep") or []
    res = protect_json(df, policy, value_col, output_col=out_col, **kw)
    return res.where(F.col("reason").isNull()).select(*[_c(c) for c in keep], _c(out_col))


def split_rejected(df: DataFrame, policy: Policy, value_col: str = "value", **kw) -> tuple[DataFrame, DataFrame]:
    """``(good, rejected)``: good rows carry the protected JSON; rejected rows
    carry the raw text and a reason.  Both read the same projection — persist
    the input (as a streaming micro-batch writer does) when both are consumed."""
    keep = kw.get("keep") or []
    res = protect_json(df, policy, value_col, output_col="__out", with_raw=True, **kw)
    good = res.where(F.col("reason").isNull()).select(*[_c(c) for c in keep], F.col("__out").alias("value"))
    rejected = res.where(F.col("reason").isNotNull()).select(*[_c(c) for c in keep], F.col("raw").alias("value"),
                                                              "reason")
    return good, rejected


def keep_all_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """No policy: every field but ``id`` is kept, with values normalized as
    the original tool writes them (containers as text, decimals as doubles).
    Output keys: ``id``, then the other keys in sorted order (the original
    tool's order is that of a hash map, i.e. unspecified)."""
    parsed = parse_records(df, value_col)
    m = F.try_variant_get(F.col("__v"), "$", "map<string,variant>")
    keys = F.json_object_keys("__raw")
    parsed = parsed.select("__raw", "__id", "__reason", F.map_filter(m, lambda k, _: k != F.lit("id")).alias("__m"),
                           (F.size(keys) == F.size(F.array_distinct(keys))).alias("__single"))

    def norm(k, fv):
        kind = V.variant_kind(fv)
        # objects and arrays in their original key order, unless a key of the record repeats
        plain = F.col("__single") & ~k.contains("'")
        member = F.call_function("get_json_object", F.col("__raw"), F.concat(F.lit("$['"), k, F.lit("']")))
        text = F.coalesce(F.when(plain, member), F.to_json(fv))
        return V.variant_passthrough(fv, kind, V.variant_text(fv, kind, text))

    idmap = F.create_map(F.lit("id"), F.col("__id").cast("variant"))
    out = F.to_json(F.map_concat(idmap, F.transform_values("__m", norm)))
    return parsed.where(F.col("__reason").isNull()).select(out.alias("value"))
