"""Randomizing expressions.

``rand()`` is evaluated per row inside the JVM; the random string is built from
a per-row seed hashed with the character position, so no Python runs.  Pass
``seed_col`` (for example a hash of the record key and a secret) to make the
output replay-stable across task retries and reruns.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilspark.functions.numeric import INT32_MIN, wrap_int32

# Fixed value: the alphabet of randomized text, in its natural order.
ALPHANUMERIC = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"


def row_seed(seed_col: Column | None = None) -> Column:
    """A 64-bit per-row seed: random by default, derived from ``seed_col`` when given."""
    if seed_col is not None:
        return F.xxhash64(seed_col)
    return F.xxhash64(F.rand(), F.rand())


def uniform(seed: Column, salt: int) -> Column:
    """A double in [0, 1) derived from a row seed (one independent stream per salt)."""
    h = F.xxhash64(seed, F.lit(salt))
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


# Characters taken from one block: 21 full Base64 groups of a SHA-512 digest
# (the last, partial group is not uniform and is left out).
_BLOCK_CHARS = 84
# After dropping '+' and '/', a block keeps 84 * 62/64 characters on average;
# planning for 60 per block leaves a margin that is never used up in practice.
_PLANNED_PER_BLOCK = 60


def random_alnum(n: Column, seed: Column) -> Column:
    """Random text of length ``n``, each character uniform over [a-zA-Z0-9].

    Characters come in blocks: the Base64 text of SHA-512(seed, block number),
    full groups only, with '+' and '/' removed — uniform 6-bit symbols with the
    two non-alphanumeric ones rejected, so the rest is uniform over the 62.
    One lambda step yields about 80 characters.

    The text is cut to exactly ``n`` characters.  There would be too few only if
    the rejections removed more than about 0.4 n + 84 of the characters, against
    an expected 0.044 n + 5 — a chance below 1e-90 for every n (Chernoff
    bound); such a row fails rather than being filled up."""
    blocks = F.floor(n / _PLANNED_PER_BLOCK).cast("int") + 2

    def block(j):
        digest = F.base64(F.unhex(F.sha2(F.concat_ws(":", seed.cast("string"), j.cast("string")), 512)))
        full_groups = F.substring(F.translate(digest, "\r\n", ""), 1, _BLOCK_CHARS)
        return F.translate(full_groups, "+/", "")

    text = F.array_join(F.transform(F.sequence(F.lit(1), blocks), block), "")
    cut = F.substring(text, F.lit(1), n)
    short = F.raise_error(F.lit("random text came out too short")).cast("string")
    return F.when(n <= 0, F.lit("")).otherwise(F.when(F.length(text) >= n, cut).otherwise(short))


def randomize_int32(x: Column, u: Column) -> Column:
    """Uniform in [x - v, x + v - 1] with v = int(max(1, |x| * 0.2)); 32-bit wrap as the JVM."""
    v = F.when(x == INT32_MIN, F.lit(1)).otherwise(
        F.greatest(F.lit(1.0), F.abs(x.cast("double")) * 0.2).cast("int"))
    return wrap_int32(x.cast("bigint") + F.floor(u * (v * 2)).cast("bigint") - v)


def randomize_double(x: Column, u: Column) -> Column:
    """Uniform in [x - v, x + v) with v = max(0.1, |x| * 0.2)."""
    v = F.greatest(F.lit(0.1), F.abs(x) * 0.2)
    return x + (u * v * 2) - v
