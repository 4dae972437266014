"""Expected outputs of the protection rules through the JSON record path (edge cases: FIXTURES.md)."""

import base64
import hashlib
import json

import pytest

from policies import M1, M2, MEMBER_POLICY, P1, PARCEL_POLICY
from veilspark.operators.protect import apply_policy_json, keep_all_json, protect_json, split_rejected
from veilspark.policy import Policy


def run(spark, policy, docs):
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    return [json.loads(r.value) if r.value is not None else None
            for r in protect_json(df, Policy.from_dict(policy)).collect()]


def test_parcel_record(spark):
    (out,) = run(spark, PARCEL_POLICY, [P1])
    assert out["id"] == "pcl-31"
    assert out["sender"] == "M**s" + "*" * 7  # kept at places 1 and 4; starred beyond the format
    assert out["contact"] == "d" + "*" * 14 + "t"
    assert out["tag"] == base64.b64encode(hashlib.sha256(b"QX-99").digest()).decode()
    assert out["weight"] == "5-20"
    assert out["door"] == "[REDACTED]"
    assert out["code"] == "K7****ZZ"
    assert isinstance(out["worth"], int) and 200 <= out["worth"] <= 299
    assert list(out) == ["id", "sender", "contact", "tag", "weight", "door", "code", "worth"]


def test_member_records(spark):
    m1, m2 = run(spark, MEMBER_POLICY, [M1, M2])
    assert (m1["alias"], m2["alias"]) == ("Qu*****", "Ib")
    assert (m1["branch"], m2["branch"]) == ("North Pier", "Harbour")  # a mask on a field that is not sensitive
    assert (m1["card"], m2["card"]) == ("***44****", "***11****")
    assert m1["phrase"] == m2["phrase"] == "[REDACTED]"
    assert (m1["remark"], m2["remark"]) == ("p" + "*" * 18 + "s", "**")
    assert (m1["visits"], m2["visits"]) == ("<3", "3-7")  # text that is no number counts as 0
    assert 32.4 <= m1["fines"] < 48.6 and 1.6 <= m2["fines"] < 2.4
    assert (m1["since"], m1["open"], m2["open"]) == ("2021-05-04T08:00:00Z", True, False)
    assert m1["shelf"] == "B12" and "shelf" not in m2 and "locker" not in m1
    assert "hold" not in m2


def rule(op, type_="string", **kw):
    return {"fields": [{"name": "f", "type": type_, "isPII": True, "piiOperation": op, **kw}]}


def field_out(spark, policy, raw_values):
    docs = ['{"id":"r%d","f":%s}' % (i, v) for i, v in enumerate(raw_values)]
    return [o.get("f", "ABSENT") for o in run(spark, policy, docs)]


@pytest.mark.parametrize("policy,values,expected", [
    (rule("mask"), ['""', '"a"', '"ab"', '"abc"', "42"], ["", "*", "**", "a*c", "**"]),
    (rule("mask", maskFormat="XX******X"), ['"ab"'], ["ab"]),
    (rule("mask", "integer"), ["42"], [42]),
    (rule("hash"), ['""', "75000"], ["", "GZk9yPCkUxZB/cf3zzN4VHnj3TtThDA5ceJH6wdAS5g="]),
    (rule("redact"), ['""', "null"], ["[REDACTED]", None]),
    (rule("redact", "integer"), ["5"], [None]),
    (rule("generalize", "integer", ranges=[0, 18, 30]),
     ["-1", "0", "18", "29.9", "30", '"x"', '" 18"', "true", "4294967316"],
     ["<0", "0-18", "18-30", "18-30", "30+", "0-18", "0-18", "0-18", "18-30"]),
    (rule("generalize", "integer", ranges=[18]), ["17", "18"], ["<18", "18+"]),
    (rule("generalize", "integer"), ["42", "7.50", "true"], ["42", "7.5", "true"]),
    (rule("randomize", "boolean"), ["true"], [True]),
    (rule("MASK", maskFormat="XX"), ['"abcd"'], ["a**d"]),
    (rule("tokenize", "integer"), ["42"], [42]),
])
def test_edge_cases(spark, policy, values, expected):
    assert field_out(spark, policy, values) == expected


def test_pass_through_normalization(spark):
    pol = {"fields": [{"name": "f", "isPII": False}]}
    out = field_out(spark, pol, ['{"k":[1, 2]}', "123456789012345678901234567890", "5.00", "12345678.9", "null"])
    assert out == ['{"k":[1,2]}', "123456789012345678901234567890", 5.0, 12345678.9, None]
    df = spark.createDataFrame([('{"id":"a","f":12345678.9}',)], "value string")
    assert '"f":1.23456789E7' in apply_policy_json(df, Policy.from_dict(pol)).first().value


def test_randomize_ranges(spark):
    ints = field_out(spark, rule("randomize", "integer"), ["0", "5"] * 50)
    assert all(-1 <= v <= 0 for v in ints[0::2]) and all(4 <= v <= 5 for v in ints[1::2])
    dbl = field_out(spark, rule("randomize", "double"), ["0.0"] * 50)
    assert all(-0.1 <= v < 0.1 for v in dbl)
    txt = field_out(spark, rule("randomize"), ['"hello world"', '""'])
    assert len(txt[0]) == 11 and txt[0].isalnum() and txt[1] == ""


def test_ids_and_rejects(spark):
    df = spark.createDataFrame([(v,) for v in [
        '{"id":null}', '{"id":7.50}', '{"x":1}', "nul", "[1]", "", '{"id":"a"}tail', '{"id":"a","id":"b"}',
        '{"id":{"q":1}}', '{"id":true}', '{"id":12}', None]], "value string")
    good, bad = split_rejected(df, Policy.from_dict({"fields": []}))
    assert sorted(json.loads(r.value)["id"] for r in good.collect()) == sorted(
        ["null", "7.5", "a", "b", "", "true", "12"])
    reasons = sorted((r.value, r.reason) for r in bad.collect() if r.value is not None)
    assert reasons == sorted([('{"x":1}', "missing_id"), ("nul", "parse_error"), ("[1]", "missing_id"),
                              ("", "parse_error")])


def test_empty_policy_keeps_only_id(spark):
    (out,) = run(spark, {"name": "not a policy"}, [M2])
    assert out == {"id": "m-9"}


def test_null_and_absent_are_kept_apart(spark):
    (out,) = run(spark, PARCEL_POLICY, ['{"id":"a","sender":null,"weight":null}'])
    assert out == {"id": "a", "sender": None, "weight": None}


def test_containers_keep_key_order(spark):
    pol = {"fields": [{"name": "f", "isPII": False}, {"name": "h", "isPII": True, "piiOperation": "hash"}]}
    out = field_out(spark, pol, ['{"z":1, "b":[1, 2.50, {"y":true,"a":null}]}'])
    assert out == ['{"z":1,"b":[1,2.5,{"y":true,"a":null}]}']
    df = spark.createDataFrame([('{"id":"a","h":{"z":1,"b":2}}',)], "value string")
    want = base64.b64encode(hashlib.sha256(b'{"z":1,"b":2}').digest()).decode()
    assert json.loads(apply_policy_json(df, Policy.from_dict(pol)).first().value)["h"] == want


def test_large_records_are_protected(spark):
    """A 21-million-character string, 500 levels and 1,000 digits are protected like any other value."""
    rows = ['{"id":"s","t":"' + "a" * 21_000_000 + '"}', '{"id":"d","t":' + "[" * 498 + "]" * 498 + "}", '{"id":"n","t":' + "7" * 1000 + "}"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    good, bad = split_rejected(df, Policy.from_dict({"fields": [{"name": "t", "isPII": True}]}))
    out = {r["id"]: r["t"] for r in (json.loads(x.value) for x in good.collect())}
    assert bad.count() == 0
    assert out["s"] == "a" + "*" * 20_999_998 + "a" and out["d"] == "[" + "*" * 994 + "]" and out["n"] == "7" + "*" * 998 + "7"


def test_too_deep_records_are_counted(spark):
    """The limits that are left have reasons of their own."""
    rows = ['{"id":"d","t":' + "[" * 600 + "]" * 600 + "}", '{"id":"x","t":[1', '{"id":"y"}', '{"id":"n","t":' + "7" * 1100 + "}"]
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    good, bad = split_rejected(df, Policy.from_dict({"fields": [{"name": "t"}]}))
    assert sorted(r.reason for r in bad.collect()) == ["long_number", "parse_error", "too_deep"] and good.count() == 1


def test_numbers_as_written(spark):
    """Digits alone are integers of any length; a fraction or exponent makes a double, whatever its size."""
    digits = "1234567890" * 5
    rows = ['{"id":1,"f":' + digits + "}", '{"id":2,"f":10000000000000000000.0}', '{"id":3,"f":1e45}', '{"id":4,"f":-12345678901234567890}',
            '{"id":5,"f":7.50}', '{"id":' + digits + ',"f":1}']
    pol = {"fields": [{"name": "f"}]}
    out = {x["id"]: x["f"] for x in run(spark, pol, rows)}
    assert out == {"1": digits, "2": 1e19, "3": 1e45, "4": "-12345678901234567890", "5": 7.5, digits: 1}


def test_last_of_repeated_keys_wins(spark):
    rows = ['{"id":"a","x":{"a":1},"x":{"b":2}}', '{"id":"b","x":1,"x":[2]}', '{"id":"c","x":99999999999999999999,"x":88888888888888888888}']
    df = spark.createDataFrame([(r,) for r in rows], "value string")
    want = {"a": '{"b":2}', "b": "[2]", "c": "88888888888888888888"}
    pol = Policy.from_dict({"fields": [{"name": "x"}]})
    for out in (apply_policy_json(df, pol), keep_all_json(df)):
        assert {x["id"]: x["x"] for x in (json.loads(r.value) for r in out.collect())} == want


def test_keep_columns_with_dots(spark):
    df = spark.createDataFrame([("k.1", '{"id":"a","f":"abcd"}')], "`part.key` string, `raw value` string")
    pol = Policy.from_dict({"fields": [{"name": "f", "isPII": True}]})
    r = apply_policy_json(df, pol, "raw value", keep=["part.key"]).first()
    assert r["part.key"] == "k.1" and json.loads(r["value"]) == {"id": "a", "f": "a**d"}
