"""Numeric conversions and range labels.

The original tool converts values with JVM rules: a 64-bit integer keeps its
low 32 bits, a double is truncated and saturated, text is parsed strictly and
falls back to 0.  These builders reproduce those rules with built-in functions
(ANSI mode is on, so every narrowing step is explicit).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT32_MIN = -(2**31)
INT32_MAX = 2**31 - 1

# Strict decimal integer text: optional sign, ASCII digits, nothing else.
INT_TEXT_PATTERN = r"^[+-]?[0-9]+\z"
# Decimal floating-point text accepted by the JVM parser (leading/trailing
# blanks, optional exponent, optional d/f suffix) plus NaN and Infinity.
DOUBLE_TEXT_PATTERN = (
    r"^\s*[+-]?(NaN|Infinity|(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]?))\s*\z"
)


def wrap_int32(x: Column) -> Column:
    """Low 32 bits of a bigint, as a signed int (two's complement wrap)."""
    return F.shiftright(F.shiftleft(x.cast("bigint"), 32), 32).cast("int")


def saturate_int32(d: Column) -> Column:
    """Double → int with truncation toward zero, saturation at the int range and NaN → 0."""
    return (
        F.when(F.isnan(d), F.lit(0))
        .when(d >= INT32_MAX, F.lit(INT32_MAX))
        .when(d <= INT32_MIN, F.lit(INT32_MIN))
        .otherwise(d.cast("int"))
    )


def parse_int_strict(txt: Column) -> Column:
    """Strict integer parse of text; anything else (blanks, decimals, overflow) → 0."""
    return F.coalesce(F.when(txt.rlike(INT_TEXT_PATTERN), txt.try_cast("int")), F.lit(0))


def parse_double_lenient(txt: Column) -> Column:
    """JVM-style double parse of text; unparsable → 0.0."""
    cleaned = F.regexp_replace(F.trim(txt), r"[dDfF]$", "")
    return F.coalesce(F.when(txt.rlike(DOUBLE_TEXT_PATTERN), cleaned.try_cast("double")), F.lit(0.0))


def range_label(x: Column, ranges: tuple[int, ...] | list[int]) -> Column:
    """``lo-hi`` for lo <= x < hi over the sorted boundaries, ``<first`` below,
    ``last+`` at or above the last boundary.  Boundaries are constants, so this
    is a plain CASE chain."""
    b = sorted(ranges)
    expr = F.when(x < b[0], F.lit(f"<{b[0]}"))
    for lo, hi in zip(b, b[1:]):
        if lo < hi:
            expr = expr.when(x < hi, F.lit(f"{lo}-{hi}"))
    return expr.otherwise(F.lit(f"{b[-1]}+"))
