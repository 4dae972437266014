"""Protection policy: the JSON document that lists which fields are kept and how
each sensitive field is protected.

A policy is a small driver-side object.  It is compiled into Column expressions
(see ``veilspark.operators.protect``), so it never travels with the data: the
rules become literals inside the physical plan.

Document shape::

    {"name": ..., "version": ..., "fields": [
        {"name": "email", "type": "string", "isPII": true,
         "piiOperation": "mask", "maskFormat": "X****@****X",
         "ranges": [0, 18, 30], "size": 100, "required": false}, ...]}

Reading rules follows the JSON-tree accessors of the original tool: missing
``type`` means ``"string"``, missing ``piiOperation`` means ``"mask"``,
``isPII`` uses lenient boolean reading, ``ranges`` keeps only 32-bit integer
elements, and a document without a ``fields`` array has no rules.
"""

from __future__ import annotations

import hashlib
import json
import math
from decimal import Decimal
from dataclasses import dataclass, field
from typing import Any

INT32_MIN = -(2**31)
INT32_MAX = 2**31 - 1


def java_double_text(x: float) -> str:
    """Text of a double the way the JVM prints it (``1.0E7``, ``7.5``, ``NaN``)."""
    if math.isnan(x):
        return "NaN"
    if math.isinf(x):
        return "Infinity" if x > 0 else "-Infinity"
    if x == 0:
        return "-0.0" if math.copysign(1.0, x) < 0 else "0.0"
    a = abs(x)
    if 1e-3 <= a < 1e7:
        r = repr(x)
        return r if "." in r else r + ".0"
    sign, digits, exp = Decimal(repr(x)).as_tuple()
    sci_exp = len(digits) - 1 + exp
    digits = "".join(map(str, digits)).rstrip("0") or "0"
    return f"{'-' if sign else ''}{digits[0]}.{digits[1:] or '0'}E{sci_exp}"


def node_text(node: Any) -> str:
    """Text of a JSON tree node (scalar text; ``"null"`` for null; ``""`` for containers)."""
    if node is None:
        return "null"
    if isinstance(node, bool):
        return "true" if node else "false"
    if isinstance(node, int):
        return str(node)
    if isinstance(node, float):
        return java_double_text(node)
    if isinstance(node, str):
        return node
    return ""


def node_bool(node: Any) -> bool:
    """Lenient boolean reading of a JSON node (text ``"true"``, non-zero integers)."""
    if isinstance(node, bool):
        return node
    if isinstance(node, int):
        return node != 0
    if isinstance(node, str):
        return node.strip() == "true"
    return False


def _is_int32(node: Any) -> bool:
    return isinstance(node, int) and not isinstance(node, bool) and INT32_MIN <= node <= INT32_MAX


@dataclass(frozen=True)
class Rule:
    """One field rule of a policy."""

    name: str
    type: str = "string"
    is_pii: bool = False
    operation: str = "mask"
    mask_format: str | None = None
    ranges: tuple[int, ...] = ()
    size: int | None = None
    required: bool = False
    description: str | None = None

    @classmethod
    def from_node(cls, node: Any) -> "Rule":
        if not isinstance(node, dict):
            return cls(name="")
        name = node_text(node["name"]) if "name" in node else ""
        ranges_node = node.get("ranges")
        ranges = tuple(e for e in ranges_node if _is_int32(e)) if isinstance(ranges_node, list) else ()
        return cls(
            name=name,
            type=node_text(node["type"]) if "type" in node else "string",
            is_pii=node_bool(node["isPII"]) if "isPII" in node else False,
            operation=node_text(node["piiOperation"]) if "piiOperation" in node else "mask",
            mask_format=node_text(node["maskFormat"]) if "maskFormat" in node else None,
            ranges=ranges,
            size=node["size"] if _is_int32(node.get("size")) else None,
            required=node_bool(node.get("required", False)),
            description=node.get("description") if isinstance(node.get("description"), str) else None,
        )

    def to_node(self) -> dict:
        out: dict[str, Any] = {"name": self.name, "type": self.type, "isPII": self.is_pii,
                               "piiOperation": self.operation}
        if self.mask_format is not None:
            out["maskFormat"] = self.mask_format
        if self.ranges:
            out["ranges"] = list(self.ranges)
        if self.size is not None:
            out["size"] = self.size
        if self.required:
            out["required"] = True
        return out


@dataclass(frozen=True)
class Policy:
    """A parsed policy document."""

    rules: tuple[Rule, ...]
    name: str | None = None
    version: str | None = None
    description: str | None = None
    has_fields_array: bool = True
    digest: str = ""
    source: dict = field(default_factory=dict, compare=False, repr=False)

    # ---- construction -------------------------------------------------
    @classmethod
    def from_dict(cls, doc: Any) -> "Policy":
        fields = doc.get("fields") if isinstance(doc, dict) else None
        has_array = isinstance(fields, list)
        rules = tuple(Rule.from_node(n) for n in fields) if has_array else ()
        canonical = json.dumps(doc, sort_keys=True, separators=(",", ":"))
        meta = doc if isinstance(doc, dict) else {}
        return cls(
            rules=rules,
            name=meta.get("name") if isinstance(meta.get("name"), str) else None,
            version=node_text(meta["version"]) if "version" in meta else None,
            description=meta.get("description") if isinstance(meta.get("description"), str) else None,
            has_fields_array=has_array,
            digest=hashlib.sha256(canonical.encode("utf-8")).hexdigest(),
            source=doc if isinstance(doc, dict) else {},
        )

    @classmethod
    def from_json(cls, text: str) -> "Policy":
        return cls.from_dict(json.loads(text))

    @classmethod
    def from_rules(cls, rules: list[Rule], **meta: Any) -> "Policy":
        doc = dict(meta)
        doc["fields"] = [r.to_node() for r in rules]
        return cls.from_dict(doc)

    # ---- accessors ----------------------------------------------------
    def rule(self, name: str) -> Rule | None:
        """First rule with this name (later duplicates are ignored)."""
        for r in self.rules:
            if r.name == name:
                return r
        return None

    def field_names(self) -> list[str]:
        """Names kept in the output besides ``id``, in policy order, without duplicates."""
        seen: list[str] = []
        for r in self.rules:
            if r.name and r.name != "id" and r.name not in seen:
                seen.append(r.name)
        return seen

    def declared_names(self) -> set[str]:
        """Every rule name plus ``id`` (used for undeclared-field detection)."""
        return {r.name for r in self.rules} | {"id"}

    def pii_rules(self) -> list[Rule]:
        return [r for r in self.rules if r.is_pii]

    def effective_rules(self) -> list[Rule]:
        """The rule that applies to each kept field (first rule per name)."""
        return [self.rule(n) for n in self.field_names()]  # type: ignore[misc]


def load_policy(path: str, spark=None) -> Policy:
    """Read a policy file.  With a session the path may be on any Hadoop
    filesystem; the file itself is small and is read as one whole text."""
    if spark is not None:
        from veilspark.sources.policy_files import read_policy_text

        return Policy.from_json(read_policy_text(spark, path))
    with open(path, encoding="utf-8") as fh:
        return Policy.from_json(fh.read())


# ---------------------------------------------------------------------------
# lint
# ---------------------------------------------------------------------------
KNOWN_OPERATIONS = ("mask", "hash", "redact", "generalize", "randomize")


@dataclass(frozen=True)
class Finding:
    severity: str  # "error" | "warning"
    field: str
    message: str


def lint(policy: Policy) -> list[Finding]:
    """Report rules whose effect is weaker than their declaration suggests."""
    out: list[Finding] = []
    if not policy.has_fields_array:
        out.append(Finding("error", "", "policy has no 'fields' array: output keeps only id"))
    seen: set[str] = set()
    for r in policy.rules:
        if not r.name:
            out.append(Finding("warning", "", "rule without a name is ignored"))
            continue
        if r.name in seen:
            out.append(Finding("warning", r.name, "duplicate rule: the first one wins"))
            continue
        seen.add(r.name)
        if "'" in r.name and '"' in r.name:
            out.append(Finding("error", r.name, "a name with both quote kinds cannot be addressed in a record"))
        if not r.is_pii:
            continue
        if r.name == "id":
            out.append(Finding("error", r.name, "id is never protected"))
        op, t = r.operation, r.type
        if op not in KNOWN_OPERATIONS:
            out.append(Finding("error", r.name, f"unknown operation {op!r}: "
                               + ("default mask is used" if t == "string" else "value passes unchanged")))
        elif op == "mask" and t != "string":
            out.append(Finding("error", r.name, f"mask on declared type {t!r} leaves the value unchanged"))
        elif op == "randomize" and t not in ("string", "integer", "int", "double", "float"):
            out.append(Finding("error", r.name, f"randomize on declared type {t!r} leaves the value unchanged"))
        elif op == "generalize" and not r.ranges:
            out.append(Finding("error", r.name, "generalize without ranges leaves the value as text"))
        elif op == "hash":
            out.append(Finding("warning", r.name, "unsalted hash can be reversed by enumeration for short values"))
    return out


def check(policy: Policy, strict: bool = False) -> Policy:
    """Raise in strict mode when the policy has lint errors."""
    if strict:
        errors = [f for f in lint(policy) if f.severity == "error"]
        if errors:
            raise ValueError("policy rejected: " + "; ".join(f"{f.field}: {f.message}" for f in errors))
    return policy


def rules_frame(spark, policy: Policy):
    """The rules as a DataFrame (one row per rule, document order)."""
    rows = [
        (i, r.name, r.type, r.is_pii, r.operation, r.mask_format, list(r.ranges), r.size, r.required)
        for i, r in enumerate(policy.rules)
    ]
    schema = ("position INT, name STRING, type STRING, is_pii BOOLEAN, operation STRING, "
              "mask_format STRING, ranges ARRAY<INT>, size INT, required BOOLEAN")
    return spark.createDataFrame(rows, schema)
