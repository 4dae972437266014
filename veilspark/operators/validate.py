"""Field validation against declared types.

For each rule, a present value must match the declared type: ``string`` →
text (containers and huge integers count as text, as the record model stores
them so), ``integer``/``int`` → integer, ``double``/``float`` → floating
point, ``boolean`` → boolean, anything else → valid.  An absent field is
valid.  A JSON null is valid unless the rule says ``required``.  Type names
are compared case-insensitively.  When two rules share a name, the later one
decides (results are collected into a map in rule order).

A rule's ``size`` is read by nothing in the original tool; with ``sizes=True``
text of more code points than it is invalid, whatever type is declared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.operators import values as V
from veilspark.operators.protect import parse_records
from veilspark.policy import Policy, Rule

RESULTS_COL = "__validationResults"


def _valid(kind: Column, rule: Rule) -> Column:
    t = rule.type.lower()
    if t == "string":
        ok = kind.isin(V.TEXT, V.BIG_INTEGER, V.CONTAINER)
    elif t in ("integer", "int"):
        ok = kind == V.INTEGER
    elif t in ("double", "float"):
        ok = kind == V.DOUBLE
    elif t == "boolean":
        ok = kind == V.BOOLEAN
    else:
        ok = F.lit(True)
    null_ok = F.lit(not rule.required)
    return F.when(kind == V.ABSENT, F.lit(True)).when(kind == V.NULL, null_ok).otherwise(ok)


def _decisive_rules(policy: Policy) -> dict[str, Rule]:
    out: dict[str, Rule] = {}
    for r in policy.rules:
        if r.name:
            out[r.name] = r
    return out


def validate_fields(df: DataFrame, policy: Policy, value_col: str = "value",
                    keep: list[str] | None = None, sizes: bool = False) -> DataFrame:
    """Records with an id, with ``id`` (text), the input ``value`` and a
    ``__validationResults`` map of field name → valid.  ``sizes`` also holds
    text to the size of its rule."""
    keep = list(keep or [])
    rules = _decisive_rules(policy)
    parsed = parse_records(df, value_col, keep).where(F.col("__reason").isNull())
    v = F.col("__v")
    names = list(rules)
    carried = [F.col(f"`{c}`") for c in keep] + [F.col("__id").alias("id"), F.col("__raw").alias(value_col)]
    fields = parsed.select(*carried, *[V.variant_field(v, n).alias(f"__f{i}") for i, n in enumerate(names)])
    carried = [F.col(f"`{c}`") for c in keep] + [F.col("id"), F.col(f"`{value_col}`")]
    schemas = fields.select(*carried, *[c for i in range(len(names))
                                        for c in (F.col(f"__f{i}"), F.schema_of_variant(f"__f{i}").alias(f"__s{i}"))])
    # the id is not a field of the record: its rule always sees "absent"
    held = [i for i, n in enumerate(names) if sizes and rules[n].size is not None and n != "id"]
    kinds = schemas.select(*carried, *[
        (F.lit(V.ABSENT) if n == "id" else F.expr(V.kind_sql(f"`__f{i}`", f"`__s{i}`"))).alias(f"__k{i}")
        for i, n in enumerate(names)], *[
        F.when(F.col(f"__s{i}") == "STRING", F.length(F.try_variant_get(f"__f{i}", "$", "string"))).alias(f"__n{i}") for i in held])
    pairs: list[Column] = []
    for i, n in enumerate(names):
        ok = _valid(F.col(f"__k{i}"), rules[n])
        if i in held:
            ok &= F.coalesce(F.col(f"__n{i}") <= rules[n].size, F.lit(True))
        pairs += [F.lit(n), ok]
    results = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,boolean>")
    return kinds.select(*[F.col(f"`{c}`") for c in keep], "id", F.col(f"`{value_col}`"), results.alias(RESULTS_COL))


def validation_summary(validated: DataFrame) -> DataFrame:
    """``(field, n_valid, n_invalid)`` over validated records."""
    ex = validated.select(F.explode(F.col(RESULTS_COL)).alias("field", "ok"))
    return ex.groupBy("field").agg(
        F.count_if(F.col("ok")).alias("n_valid"),
        F.count_if(~F.col("ok")).alias("n_invalid"),
    )
