"""String protection expressions: default mask, position-format mask, hash.

All builders take and return ``Column``s made of built-in functions only, so
they stay inside whole-stage codegen.  A mask format is a constant of the
policy; it is compiled here into runs of kept and starred positions, so no
per-character loop runs at execution time.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the protection recipes (must equal the original tool's output).
MASK_CHAR = "*"
KEEP_CHARS = ("X", "x")
REDACTED_TEXT = "[REDACTED]"

HASH_BLOCK = 64  # bytes of a SHA-256 block


def mask_default(c: Column) -> Column:
    """First and last character kept, the rest starred; up to two characters all starred."""
    n = F.length(c)
    return (
        F.when(n <= 2, F.repeat(F.lit(MASK_CHAR), n))
        .otherwise(F.concat(F.left(c, F.lit(1)), F.repeat(F.lit(MASK_CHAR), n - 2), F.right(c, F.lit(1))))
    )


def format_runs(fmt: str) -> list[tuple[bool, int, int]]:
    """Split a mask format into ``(keep, start, length)`` runs (1-based starts)."""
    runs: list[tuple[bool, int, int]] = []
    for i, ch in enumerate(fmt, start=1):
        keep = ch in KEEP_CHARS
        if runs and runs[-1][0] == keep:
            k, s, ln = runs[-1]
            runs[-1] = (k, s, ln + 1)
        else:
            runs.append((keep, i, 1))
    return runs


def mask_with_format(c: Column, fmt: str) -> Column:
    """Position mask: ``X``/``x`` keeps the character, any other format character
    writes ``*``; characters beyond the format are starred; output length is the
    value length."""
    n = F.length(c)
    parts: list[Column] = []
    for keep, start, ln in format_runs(fmt):
        if keep:
            parts.append(F.substring(c, start, ln))
        else:
            parts.append(F.repeat(F.lit(MASK_CHAR), F.greatest(F.lit(0), F.least(F.lit(ln), n - (start - 1)))))
    parts.append(F.repeat(F.lit(MASK_CHAR), F.greatest(F.lit(0), n - len(fmt))))
    return F.concat(*parts)


def mask_text(c: Column, fmt: str | None) -> Column:
    """The mask operation on text: empty stays empty; a non-empty format wins over the default."""
    body = mask_with_format(c, fmt) if fmt else mask_default(c)
    return F.when(F.length(c) == 0, c).otherwise(body)


def hmac_sha256(c: Column, key: str | Column) -> Column:
    """HMAC-SHA256 (RFC 2104) of the UTF-8 text under a key, as binary.

    The pads of a constant key are constants computed here; those of a key column are its members ``inner_pad`` and
    ``outer_pad``.  Either way the expression is two built-in SHA-256 calls over concatenated binaries."""
    if isinstance(key, Column):
        ipad, opad = key["inner_pad"], key["outer_pad"]
    else:
        k = key.encode("utf-8")
        if len(k) > HASH_BLOCK:
            k = hashlib.sha256(k).digest()
        k = k.ljust(HASH_BLOCK, b"\0")
        ipad, opad = F.lit(bytes(b ^ 0x36 for b in k)), F.lit(bytes(b ^ 0x5C for b in k))
    inner = F.unhex(F.sha2(F.concat(ipad, F.encode(c, "UTF-8")), 256))
    return F.unhex(F.sha2(F.concat(opad, inner), 256))


def hash_text(c: Column, key: str | Column | None = None) -> Column:
    """SHA-256 over the UTF-8 text, Base64 encoded; empty stays empty.

    With ``key`` the digest is an HMAC-SHA256 under that key, which defeats
    enumeration of short values; without it the output equals the original
    unsalted hash.  A key column (``key_id, inner_pad, outer_pad``) also names
    the key: ``key_id:digest``; null where the row has no key.
    """
    if isinstance(key, Column):
        digest = F.concat(key["key_id"], F.lit(":"), F.base64(hmac_sha256(c, key)))
    else:
        digest = F.base64(hmac_sha256(c, key) if key else F.unhex(F.sha2(c, 256)))
    return F.when(F.length(c) == 0, c).otherwise(digest)


def redacted() -> Column:
    return F.lit(REDACTED_TEXT)
