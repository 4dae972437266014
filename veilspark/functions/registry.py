"""Operation registry: operation name → Column builder.

A builder receives a :class:`~veilspark.operators.values.FieldValue` (the value
in every form an operation may need) and the field's :class:`Rule`, and
returns the protected value in the output representation.  Null and absent
values never reach a builder.  New techniques are added with
:func:`register_operation`; names are case-sensitive, and an unknown name
falls back to the default mask for declared text and to the unchanged value
otherwise.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspark.functions.masking import hash_text, mask_text, redacted
from veilspark.functions.numeric import range_label
from veilspark.functions.randomness import random_alnum, randomize_double, randomize_int32, uniform
from veilspark.policy import Rule

Builder = Callable[["FieldValue", Rule], Column]  # noqa: F821

_OPERATIONS: dict[str, Builder] = {}


def register_operation(name: str, builder: Builder) -> None:
    _OPERATIONS[name] = builder


def operation_names() -> list[str]:
    return sorted(_OPERATIONS)


def build(value, rule: Rule) -> Column:
    builder = _OPERATIONS.get(rule.operation, _unknown)
    return builder(value, rule)


def _mask(v, r: Rule) -> Column:
    if r.type != "string":
        return v.passthrough
    return v.out(mask_text(v.text, r.mask_format))


def _hash(v, r: Rule) -> Column:
    return v.out(hash_text(v.text, v.hash_key))


def _redact(v, r: Rule) -> Column:
    return v.out(redacted()) if r.type == "string" else v.null_out


def _generalize(v, r: Rule) -> Column:
    if not r.ranges:
        return v.out(v.text)
    return v.out(range_label(v.int32, r.ranges))


def _randomize(v, r: Rule) -> Column:
    # every field draws from its own stream: its name is part of the seed
    seed = F.xxhash64(v.seed, F.lit(v.name))
    if r.type == "string":
        return v.out(random_alnum(F.length(v.text), seed))
    if r.type in ("integer", "int"):
        return v.out(randomize_int32(v.int32, uniform(seed, 1)))
    if r.type in ("double", "float"):
        return v.out(randomize_double(v.dbl, uniform(seed, 2)))
    return v.passthrough


def _unknown(v, r: Rule) -> Column:
    if r.type != "string":
        return v.passthrough
    return v.out(mask_text(v.text, None))


register_operation("mask", _mask)
register_operation("hash", _hash)
register_operation("redact", _redact)
register_operation("generalize", _generalize)
register_operation("randomize", _randomize)
