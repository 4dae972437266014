"""A plain-Python model of the record semantics (deterministic operations),
used as the brute-force side of property tests.  Written from the operator
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
import re

from veilspark.policy import Policy, java_double_text

INT_RE = re.compile(r"[+-]?[0-9]+")


def is_big(v) -> bool:
    return isinstance(v, int) and not isinstance(v, bool) and not (-(2**63) <= v < 2**63)


_LOWER_ESCAPE = re.compile(r"(?<!\\)((?:\\\\)*)\\u00([0-9a-f]{2})")


def compact(v) -> str:
    """Compact JSON as the JVM writer prints it (control characters as \\u00XX, upper-case hex)."""
    out = json.dumps(v, separators=(",", ":"), ensure_ascii=False)
    return _LOWER_ESCAPE.sub(lambda m: m.group(1) + "\\u00" + m.group(2).upper(), out)


def text(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return java_double_text(v)
    if isinstance(v, str):
        return v
    return compact(v)


def runtime_string(v) -> bool:
    """Values the record model holds as text: strings, containers, huge integers."""
    return isinstance(v, (str, dict, list)) or is_big(v)


def to_int32(v) -> int:
    if isinstance(v, bool):
        return 0
    if isinstance(v, int) and not is_big(v):
        return ((v + 2**31) % 2**32) - 2**31
    if isinstance(v, float):
        if math.isnan(v):
            return 0
        return max(-(2**31), min(2**31 - 1, int(v))) if abs(v) < 2**63 else (2**31 - 1 if v > 0 else -(2**31))
    if runtime_string(v):
        t = text(v)
        if INT_RE.fullmatch(t) and -(2**31) <= int(t) < 2**31:
            return int(t)
        return 0
    return 0


def label(x: int, ranges) -> str:
    b = sorted(ranges)
    for lo, hi in zip(b, b[1:]):
        if lo <= x < hi:
            return f"{lo}-{hi}"
    return f"{b[-1]}+" if x >= b[-1] else f"<{b[0]}"


def mask(t: str, fmt) -> str:
    if t == "":
        return t
    if fmt:
        out = "".join(t[i] if fmt[i] in "Xx" else "*" for i in range(min(len(fmt), len(t))))
        return out + "*" * max(0, len(t) - len(fmt))
    return "*" * len(t) if len(t) <= 2 else t[0] + "*" * (len(t) - 2) + t[-1]


def passthrough(v):
    if isinstance(v, (dict, list)) or is_big(v):
        return text(v)
    return v


def protect_value(v, rule):
    if v is None:
        return None
    op, typ = rule.operation, rule.type
    if op == "mask":
        return mask(text(v), rule.mask_format) if typ == "string" else passthrough(v)
    if op == "hash":
        t = text(v)
        return t if t == "" else base64.b64encode(hashlib.sha256(t.encode("utf-8")).digest()).decode()
    if op == "redact":
        return "[REDACTED]" if typ == "string" else None
    if op == "generalize":
        return label(to_int32(v), rule.ranges) if rule.ranges else text(v)
    if op == "randomize":
        raise ValueError("not modelled")
    return mask(text(v), None) if typ == "string" else passthrough(v)


def id_text(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, (dict, list)):
        return ""
    return text(v)


def protect_record(doc, policy: Policy):
    """Expected output object, or None when the record is dropped."""
    if not isinstance(doc, dict) or "id" not in doc:
        return None
    out = {"id": id_text(doc["id"])}
    for name in policy.field_names():
        if name in doc:
            rule = policy.rule(name)
            out[name] = protect_value(doc[name], rule) if rule.is_pii else passthrough(doc[name])
    return out
