"""Drift, type profile and validation against brute-force Python on small inputs."""

import json
from collections import Counter

from veilspark.operators import drift, validate
from veilspark.policy import Policy

DOCS = [
    '{"id":1,"a":"x","b":2,"c":{"k":1},"z":null}',
    '{"id":2,"a":3000000000,"b":2.5,"extra":true}',
    '{"id":3,"a":"y","a":"z","q":[1,2]}',
    '{"b":7}',
    'not json',
    '{"id":4,"big":123456789012345678901234567890,"d":5.00}',
]
POLICY = Policy.from_dict({"fields": [
    {"name": "a", "type": "string"}, {"name": "b", "type": "integer"},
    {"name": "z", "type": "string", "required": True}, {"name": "d", "type": "DOUBLE"},
    {"name": "big", "type": "string"}, {"name": "extra", "type": "boolean"}, {"name": "c", "type": "weird"},
]})


def frame(spark):
    return spark.createDataFrame([(d,) for d in DOCS], "value string")


def py_type(v):
    if isinstance(v, bool):
        return "BOOLEAN"
    if isinstance(v, int):
        return "INT" if -2**31 <= v < 2**31 else ("BIGINT" if -2**63 <= v < 2**63 else "STRING")
    if isinstance(v, float):
        return "DOUBLE"
    return "STRING"


def parsed_docs():
    out = []
    for d in DOCS:
        try:
            out.append(json.loads(d))
        except ValueError:
            pass
    return out


def test_drift_report(spark):
    got = {r.field: r.n_records for r in drift.drift_report(frame(spark), POLICY).collect()}
    want = Counter(k for doc in parsed_docs() for k in doc if k not in POLICY.declared_names())
    assert got == dict(want)


def test_type_profile(spark):
    got = {(r.field, r.sql_type): r.n_values for r in drift.type_profile(frame(spark)).collect()}
    want = Counter((k, py_type(v)) for doc in parsed_docs() for k, v in doc.items() if k != "id")
    assert got == dict(want)


def test_validation(spark):
    res = {r.id: r["__validationResults"] for r in validate.validate_fields(frame(spark), POLICY).collect()}
    assert res["1"] == {"a": True, "b": True, "z": False, "d": True, "big": True, "extra": True, "c": True}
    assert res["2"]["a"] is False and res["2"]["b"] is False and res["2"]["extra"] is True
    assert res["3"]["a"] is True
    assert res["4"]["big"] is True and res["4"]["d"] is True
    assert set(res) == {"1", "2", "3", "4"}
    summary = {r.field: (r.n_valid, r.n_invalid) for r in
               validate.validation_summary(validate.validate_fields(frame(spark), POLICY)).collect()}
    assert summary["a"] == (3, 1) and summary["z"] == (3, 1)


def test_table_profile(spark):
    df = spark.createDataFrame([(1, "a", None)], "i int, s string, t timestamp")
    got = {(r.field, r.sql_type, r.n_values) for r in drift.table_type_profile(df).collect()}
    assert got == {("i", "INT", 1), ("s", "STRING", 1), ("t", "TIMESTAMP(3)", 0)}


def test_sizes_hold_text_only_where_asked(spark):
    docs = ['{"id":1,"s":"abcd","n":12345,"i":"xyz"}', '{"id":2,"s":"abcde"}', '{"id":3,"s":""}', '{"id":4,"s":null}',
            '{"id":5,"s":"\U0001d54f\U0001d54f\U0001d54f\U0001d54f"}', '{"id":6,"s":[1,2,3,4,5]}', '{"id":7}']
    df = spark.createDataFrame([(d,) for d in docs], "value string")
    policy = Policy.from_dict({"fields": [{"name": "s", "type": "string", "size": 4}, {"name": "n", "type": "integer", "size": 2},
                                          {"name": "i", "type": "integer", "size": 9}, {"name": "id", "type": "string", "size": 0}]})
    plain = {r.id: r["__validationResults"] for r in validate.validate_fields(df, policy).collect()}
    held = {r.id: r["__validationResults"] for r in validate.validate_fields(df, policy, sizes=True).collect()}
    assert all(plain[i]["s"] for i in plain)
    assert {i for i in held if not held[i]["s"]} == {"2"}
    assert held["1"] == {"s": True, "n": True, "i": False, "id": True}
