"""A field value in every form the operations need.

The original tool meets two type systems: the declared type of the rule and
the runtime type of the value.  ``FieldValue`` carries the runtime side:

* ``text``   – the value as text (JVM formatting for doubles, compact JSON for
  objects and arrays),
* ``int32``  – the value converted to a 32-bit int (wrap, saturate, strict parse → 0),
* ``dbl``    – the value converted to a double (lenient parse → 0.0),
* ``passthrough`` – the unchanged value in the output representation,
* ``out(c)`` – wraps a computed result into the output representation.

Two constructors exist: one for a typed DataFrame column (the runtime type is
static, so the conversions are chosen at plan time) and one for a VARIANT
field read from JSON text (the runtime type is tested per row).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.numeric import parse_double_lenient, parse_int_strict, saturate_int32, wrap_int32

# Runtime kinds of a JSON value (a small int column, computed once per field).
ABSENT, NULL, TEXT, INTEGER, DOUBLE, BOOLEAN, BIG_INTEGER, CONTAINER = range(8)
TWO_POW_63 = "9223372036854775808"


class FieldValue:
    """Forms of one field value; each form is built on first use, so an
    operation pays only for the conversions it reads."""

    def __init__(self, name: str, present: Column, text: Callable[[], Column], int32: Callable[[], Column],
                 dbl: Callable[[], Column], passthrough: Callable[[], Column], out: Callable[[Column], Column],
                 null_out: Callable[[], Column], seed: Column, hash_key: str | Column | None = None,
                 fallback: Column | None = None):
        self.name, self.present, self.out, self.seed, self.hash_key = name, present, out, seed, hash_key
        # value used for null/absent input; None means "NULL of the result type"
        self.fallback = fallback
        self._make = {"text": text, "int32": int32, "dbl": dbl, "passthrough": passthrough, "null_out": null_out}
        self._built: dict[str, Column] = {}

    def _get(self, key: str) -> Column:
        if key not in self._built:
            self._built[key] = self._make[key]()
        return self._built[key]

    text = property(lambda self: self._get("text"))
    int32 = property(lambda self: self._get("int32"))
    dbl = property(lambda self: self._get("dbl"))
    passthrough = property(lambda self: self._get("passthrough"))
    null_out = property(lambda self: self._get("null_out"))


# ---------------------------------------------------------------------------
# typed columns
# ---------------------------------------------------------------------------
def typed_value(c: Column, name: str, dtype: T.DataType, seed: Column, hash_key: str | Column | None = None) -> FieldValue:
    if isinstance(dtype, T.StringType):
        text = lambda: c
        int32 = lambda: parse_int_strict(c)
        dbl = lambda: parse_double_lenient(c)
    elif isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType)):
        text = lambda: c.cast("string")
        int32 = lambda: c.cast("int")
        dbl = lambda: c.cast("double")
    elif isinstance(dtype, T.LongType):
        text = lambda: c.cast("string")
        int32 = lambda: wrap_int32(c)
        dbl = lambda: c.cast("double")
    elif isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType)):
        # the type's own digits: a detour over double would make distinct decimals equal
        text = lambda: c.cast("string")
        int32 = lambda: saturate_int32(c.cast("double"))
        dbl = lambda: c.cast("double")
    elif isinstance(dtype, T.BooleanType):
        text = lambda: c.cast("string")
        int32 = lambda: F.lit(0)
        dbl = lambda: F.lit(0.0)
    else:
        complex_ = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
        text = lambda: F.to_json(c) if complex_ else c.cast("string")
        int32 = lambda: parse_int_strict(text())
        dbl = lambda: parse_double_lenient(text())
    return FieldValue(
        name=name,
        present=c.isNotNull(),
        text=text,
        int32=int32,
        dbl=dbl,
        passthrough=lambda: c,
        out=lambda r: r,
        null_out=lambda: F.lit(None).cast(dtype),
        seed=seed,
        hash_key=hash_key,
    )


# ---------------------------------------------------------------------------
# VARIANT fields
# ---------------------------------------------------------------------------
def variant_path(name: str) -> str:
    """JSON path of a top-level key; bracket form keeps dots and blanks literal."""
    if "'" not in name:
        return f"$['{name}']"
    if '"' not in name:
        return f'$["{name}"]'
    raise ValueError(f"field name with both quote kinds is not supported: {name!r}")


def variant_field(v: Column, name: str) -> Column:
    """The raw value of key ``name`` as VARIANT; SQL NULL when the key is absent."""
    return F.try_variant_get(v, variant_path(name), "variant")


# Limits of the JSON reader: a record is at most 128 MiB as a VARIANT (MAX_BYTES: of text, short
# of that by what a record's own bookkeeping may take); strings have no limit beside it.  A number
# has up to MAX_DIGITS digits (the path lookup that keeps the digits of large integers
# reads no more).  Writing a VARIANT back as text recurses per
# level and ends the executor when the thread's stack is used up (seen at 1,000
# nested objects), so deeper nesting than this stays a counted reason for rejection.
MAX_DEPTH, MAX_DIGITS = 500, 1_000
MAX_BYTES = (1 << 27) - (1 << 16)
PARSE_OPTIONS = {"maxStringLen": "2147483647", "maxNumLen": str(MAX_DIGITS), "maxNestingDepth": str(MAX_DEPTH),
                 "allowNonNumericNumbers": "false"}


def parse_json_text(text: Column) -> Column:
    """JSON text as VARIANT; NULL where it can't be parsed.  The last of repeated keys wins."""
    return F.from_json(text, "variant", PARSE_OPTIONS)


def outside_strings(text: Column) -> Column:
    """A record's text with every string emptied, also one that is not ended."""
    return F.regexp_replace(text, r'(?s)"(?:[^"\\\\]|\\\\.)*+"?', '""')


def nesting_depth(text: Column) -> Column:
    """How many brackets are open at once at most, those in strings left out.  Up to MAX_DEPTH brackets: their number."""
    brackets = F.regexp_replace(outside_strings(text), r"[^\[\]{}]++", "")

    def step(state, c):
        now = state["now"] + F.when(c.isin("[", "{"), 1).otherwise(-1)
        return F.struct(now.alias("now"), F.greatest(state["most"], now).alias("most"))

    zero = F.lit(0)
    walked = F.aggregate(F.split(brackets, ""), F.struct(zero.alias("now"), zero.alias("most")), step, lambda s: s["most"])
    return F.when(F.length(brackets) > MAX_DEPTH, walked).otherwise(F.length(brackets))


# A number as it is written, where no key of the record repeats (the path
# lookup below would find the first of repeated keys, the parse keeps the last).
_WHOLE = "^-?[0-9]+$"


def _single_keys(raw: str) -> str:
    return f"size(json_object_keys({raw})) = size(array_distinct(json_object_keys({raw})))"


def variant_kind(fv: Column, schema: Column | None = None) -> Column:
    """Runtime kind of a VARIANT value (see the constants above).  ``schema`` is
    ``schema_of_variant(fv)`` when an earlier projection already computed it."""
    s = F.schema_of_variant(fv) if schema is None else schema
    big = F.abs(F.try_variant_get(fv, "$", "decimal(38,0)")) >= F.lit(TWO_POW_63).cast("decimal(38,0)")
    return (
        F.when(fv.isNull(), F.lit(ABSENT))
        .when(s == "VOID", F.lit(NULL))
        .when(s == "STRING", F.lit(TEXT))
        .when(s == "BIGINT", F.lit(INTEGER))
        .when(s == "BOOLEAN", F.lit(BOOLEAN))
        .when(s == "DOUBLE", F.lit(DOUBLE))
        .when(s.startswith("DECIMAL") & s.endswith(",0)") & big, F.lit(BIG_INTEGER))
        .when(s.startswith("DECIMAL"), F.lit(DOUBLE))
        .otherwise(F.lit(CONTAINER))
    )


def _raw_member(raw: str | None, name: str | None) -> str | None:
    """SQL of a top-level member's text in the raw record."""
    if raw is None or name is None or "'" in name:
        return None
    path = "$['" + name + "']"
    return f"get_json_object({raw}, {_sql_str(path)})"


def kind_sql(fv: str, schema: str, raw: str | None = None, name: str | None = None) -> str:
    """:func:`variant_kind` as one SQL expression over named columns (one call
    to build, which matters for policies with hundreds of fields).  With ``raw``
    and ``name``, numbers beyond 64 bits are told apart by how they are
    written: digits alone are integers of any length, others are doubles."""
    big = f"abs(try_variant_get({fv}, '$', 'decimal(38,0)')) >= CAST('{TWO_POW_63}' AS DECIMAL(38,0))"
    huge = ""
    member = _raw_member(raw, name)
    if member:
        whole = f"{member} RLIKE '{_WHOLE}'"
        big += f" AND NOT ({_single_keys(raw)} AND NOT {whole})"
        huge = (f"WHEN {schema} = 'DOUBLE' AND abs(try_variant_get({fv}, '$', 'double')) >= 1e37 AND "
                f"{_single_keys(raw)} AND {whole} THEN {BIG_INTEGER} ")
    return (f"CASE WHEN {fv} IS NULL THEN {ABSENT} WHEN {schema} = 'VOID' THEN {NULL} "
            f"WHEN {schema} = 'STRING' THEN {TEXT} WHEN {schema} = 'BIGINT' THEN {INTEGER} "
            f"WHEN {schema} = 'BOOLEAN' THEN {BOOLEAN} {huge}WHEN {schema} = 'DOUBLE' THEN {DOUBLE} "
            f"WHEN startswith({schema}, 'DECIMAL') AND endswith({schema}, ',0)') AND {big} "
            f"THEN {BIG_INTEGER} WHEN startswith({schema}, 'DECIMAL') THEN {DOUBLE} ELSE {CONTAINER} END")


def text_sql(fv: str, kind: str, raw: str | None = None, name: str | None = None) -> str:
    """:func:`variant_text` as one SQL expression over named columns; with
    ``raw`` and ``name``, containers and integers beyond 64 bits take their text
    from the raw record unless a key of it repeats."""
    container, big = f"to_json({fv})", f"try_variant_get({fv}, '$', 'string')"
    member = _raw_member(raw, name)
    if member:
        container = f"coalesce(CASE WHEN {_single_keys(raw)} THEN {member} END, to_json({fv}))"
        big = f"CASE WHEN {_single_keys(raw)} AND {member} RLIKE '{_WHOLE}' THEN {member} ELSE {big} END"
    return (f"CASE WHEN {kind} IN ({TEXT}, {INTEGER}, {BOOLEAN}) THEN try_variant_get({fv}, '$', 'string') "
            f"WHEN {kind} = {BIG_INTEGER} THEN {big} "
            f"WHEN {kind} = {DOUBLE} THEN CAST(try_variant_get({fv}, '$', 'double') AS STRING) "
            f"WHEN {kind} = {CONTAINER} THEN {container} END")


def _sql_str(text: str) -> str:
    """A SQL string literal for any text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def variant_text(fv: Column, kind: Column, container_text: Column | None = None) -> Column:
    """Text form of a VARIANT value given its kind (NULL for absent / null).

    Objects and arrays become compact JSON.  A VARIANT keeps object keys
    sorted, so ``container_text`` (the member's text taken from the raw
    record) is used when given, to keep the original key order."""
    return (
        F.when(kind.isin(TEXT, INTEGER, BOOLEAN, BIG_INTEGER), F.try_variant_get(fv, "$", "string"))
        .when(kind == DOUBLE, F.try_variant_get(fv, "$", "double").cast("string"))
        .when(kind == CONTAINER, F.to_json(fv) if container_text is None else container_text)
    )


def variant_passthrough(fv: Column, kind: Column, text: Column | None = None) -> Column:
    """The value as the original tool writes it back: decimals become doubles,
    containers and integers beyond 64 bits become text."""
    if text is None:
        text = variant_text(fv, kind)
    return (
        F.when(kind == DOUBLE, F.try_variant_get(fv, "$", "double").cast("variant"))
        .when(kind.isin(BIG_INTEGER, CONTAINER), text.cast("variant"))
        .otherwise(fv)
    )


def json_value(fv: Column, kind: Column, text: Column, name: str, seed: Column,
               hash_key: str | Column | None = None) -> FieldValue:
    """A FieldValue for a VARIANT field; ``kind`` and ``text`` should be columns
    computed in an earlier projection so that every operation shares them."""
    def as_text():
        return kind.isin(TEXT, BIG_INTEGER, CONTAINER)

    def int32():
        return (F.when(kind == INTEGER, wrap_int32(F.try_variant_get(fv, "$", "bigint")))
                .when(kind == DOUBLE, saturate_int32(F.try_variant_get(fv, "$", "double")))
                .when(as_text(), parse_int_strict(text))
                .otherwise(F.lit(0)))

    def dbl():
        return (F.when(kind == INTEGER, F.try_variant_get(fv, "$", "bigint").cast("double"))
                .when(kind == DOUBLE, F.try_variant_get(fv, "$", "double"))
                .when(as_text(), parse_double_lenient(text))
                .otherwise(F.lit(0.0)))

    return FieldValue(
        name=name,
        present=kind > NULL,
        text=lambda: text,
        int32=int32,
        dbl=dbl,
        passthrough=lambda: variant_passthrough(fv, kind, text),
        out=lambda r: r.cast("variant"),
        null_out=lambda: F.parse_json(F.lit("null")),
        seed=seed,
        hash_key=hash_key,
        fallback=fv,
    )


def id_text(idv: Column, raw: str | None = None) -> Column:
    """The record id as text: strings and integers as written, doubles in JVM
    form, JSON null as ``"null"``, objects and arrays as ``""``; SQL NULL when
    absent.  ``raw`` names the column of the record's text."""
    kind = variant_kind(idv)
    if raw is None:
        text = variant_text(idv, kind)
        return F.when(kind == NULL, F.lit("null")).when(kind == CONTAINER, F.lit("")).otherwise(text)
    k = kind_sql("__idv", "__ids", raw, "id")
    return F.expr(f"CASE WHEN ({k}) = {NULL} THEN 'null' WHEN ({k}) = {CONTAINER} THEN '' "
                  f"ELSE {text_sql('__idv', f'({k})', raw, 'id')} END")
