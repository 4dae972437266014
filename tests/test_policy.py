import json

import pytest

from policies import MEMBER_POLICY, PARCEL_POLICY
from veilspark.policy import Policy, Rule, check, java_double_text, lint, load_policy, rules_frame


def test_accessors_of_a_policy():
    p = Policy.from_dict(PARCEL_POLICY)
    assert len(p.rules) == 8
    assert p.field_names() == ["sender", "contact", "tag", "weight", "door", "code", "worth"]
    assert p.rule("tag").operation == "hash"
    assert p.rule("weight").type == "integer"
    assert p.rule("weight").ranges == (0, 2, 5, 20)
    assert p.rule("sender").mask_format == "X**X"
    assert p.rule("id").is_pii is False
    assert [r.name for r in p.pii_rules()] == ["sender", "contact", "tag", "weight", "door", "code", "worth"]


def test_defaults_and_lenient_reading():
    p = Policy.from_dict({"fields": [
        {"name": "a"},
        {"name": "b", "isPII": "true"},
        {"name": "c", "isPII": 1, "ranges": [1, "x", 2.5, 3000000000, 7]},
        {"name": "d", "isPII": " true ", "maskFormat": None},
        {"isPII": True},
        "not-an-object",
        {"name": 7.5, "type": 12},
    ]})
    a, b, c, d = p.rule("a"), p.rule("b"), p.rule("c"), p.rule("d")
    assert (a.type, a.operation, a.is_pii) == ("string", "mask", False)
    assert b.is_pii and c.is_pii and d.is_pii
    assert c.ranges == (1, 7)
    assert d.mask_format == "null"
    assert p.rule("7.5").type == "12"
    assert p.field_names() == ["a", "b", "c", "d", "7.5"]


def test_missing_fields_array_means_no_rules():
    p = Policy.from_dict({"id": "m-9", "alias": "Ib"})
    assert p.rules == () and not p.has_fields_array
    assert any(f.severity == "error" for f in lint(p))
    with pytest.raises(ValueError):
        check(p, strict=True)


def test_first_rule_wins_and_lint():
    p = Policy.from_dict({"fields": [
        {"name": "x", "isPII": True, "piiOperation": "hash"},
        {"name": "x", "isPII": True, "piiOperation": "redact"},
        {"name": "n", "type": "integer", "isPII": True, "piiOperation": "mask"},
        {"name": "id", "isPII": True},
        {"name": "g", "type": "integer", "isPII": True, "piiOperation": "generalize"},
        {"name": "u", "isPII": True, "piiOperation": "MASK"},
        {"name": "q'\"", "isPII": False},
    ]})
    assert p.rule("x").operation == "hash"
    msgs = {(f.field, f.severity) for f in lint(p)}
    assert ("x", "warning") in msgs and ("n", "error") in msgs and ("id", "error") in msgs
    assert ("g", "error") in msgs and ("u", "error") in msgs and ("q'\"", "error") in msgs


def test_digest_changes_with_content():
    a = Policy.from_dict(MEMBER_POLICY)
    b = Policy.from_dict({**MEMBER_POLICY, "version": "4"})
    assert a.digest != b.digest and a.digest == Policy.from_dict(MEMBER_POLICY).digest


def test_load_through_spark_and_rules_frame(spark, tmp_dir):
    path = f"{tmp_dir}/policy.json"
    with open(path, "w") as fh:
        json.dump(MEMBER_POLICY, fh, indent=2)
    p = load_policy(path, spark)
    assert p == load_policy(path)
    rows = rules_frame(spark, p).where("is_pii").select("name").collect()
    assert [r.name for r in rows] == ["alias", "card", "phrase", "remark", "visits", "fines"]
    with pytest.raises(FileNotFoundError):
        load_policy(f"{tmp_dir}/missing.json", spark)


def test_java_double_text():
    assert [java_double_text(x) for x in (1e7, 12345678.9, 7.5, 1e-4, -2.5e10, 100.0)] == \
        ["1.0E7", "1.23456789E7", "7.5", "1.0E-4", "-2.5E10", "100.0"]


def test_rule_roundtrip():
    r = Rule("a", "integer", True, "generalize", None, (1, 2))
    assert Policy.from_rules([r]).rule("a") == r
