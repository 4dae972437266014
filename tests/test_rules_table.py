"""Policies as data against compiled policies, and reasons for rejections."""

import datetime as dt
import random

from pyspark.sql import functions as F

from veilspark.operators import values as V
from veilspark.operators.protect import apply_policy, protect_json
from veilspark.operators.rules_table import RULE, asof_join, by_rule, protect_asof_table
from veilspark.policy import Policy

DAY = dt.datetime(2024, 1, 1)


def brute(events, versions):
    out = []
    for i, tenant, t in events:
        known = [v for v in versions if v[0] == tenant and v[1] is not None and t is not None and v[1] <= t]
        out.append((i, max(known, key=lambda v: (v[1], v[2]))[2] if known else None))
    return sorted(out, key=repr)


def test_asof_join_matches_brute_force(spark):
    rng = random.Random(4)
    when = lambda: DAY + dt.timedelta(hours=rng.randrange(0, 24 * 12))
    tenant = lambda: rng.choice(["hot"] * 6 + ["a", "b", None, "none"])
    versions = [(t, when(), i) for i in range(80) if (t := tenant()) != "none"] + [("a", None, 900)]
    versions += [(t, w, i + 100) for t, w, i in versions[:20]]  # the same time twice
    events = [(i, tenant(), when()) for i in range(400)] + [(401, "a", None), (402, None, None)]
    e = spark.createDataFrame(events, "i int, tenant string, ts timestamp_ntz")
    v = spark.createDataFrame(versions, "tenant string, valid_from timestamp_ntz, label int")
    for width, salts in ((86_400, 8), (7_200, 1), (10 ** 9, 3)):
        got = asof_join(e, v, ["tenant"], "ts", "valid_from", ["label"], width, salts)
        assert sorted(((r.i, r.version.label if r.version else None) for r in got.collect()), key=repr) == brute(events, versions)
    assert asof_join(e.limit(0), v, ["tenant"], "ts", "valid_from").collect() == []
    assert all(r.version is None for r in asof_join(e, v.limit(0), ["tenant"], "ts", "valid_from").collect())


def test_plan_does_not_grow_with_the_versions(spark):
    e = spark.createDataFrame([(1, "a", DAY, "x")], "i int, tenant string, ts timestamp_ntz, f string")
    plans = []
    for n in (2, 300):
        v = spark.createDataFrame([("a", DAY, i) for i in range(n)], "tenant string, valid_from timestamp_ntz, label int")
        v = v.withColumn("rules", F.create_map(F.lit("f"), F.lit(None).cast(RULE)))
        plans.append(len(protect_asof_table(e, v, ["tenant"], "ts", ["f"], tie=["label"])._jdf.queryExecution().analyzed().toString()))
    assert abs(plans[0] - plans[1]) < 200


RULES = [{"type": "string", "isPII": True, "piiOperation": op, "maskFormat": fmt} for op in ("mask", "hash", "redact", "strange") for fmt in (None, "", "X*xX", "****")]
RULES += [{"type": "integer", "isPII": True, "piiOperation": op} for op in ("mask", "redact", "strange")]
RULES += [{"type": "integer", "isPII": True, "piiOperation": "generalize", "ranges": r} for r in ([], [18], [30, 0, 18], [0, 0, 5])] + [{"type": "string"}]
VALUES = ["", "a", "ab", "abc", "a🙂é漢字z", "17", "18", "30", "-5", None]


def test_rule_columns_write_what_compiled_rules_write(spark):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(VALUES)], "id int, f string")
    for rule in RULES:
        r = Policy.from_dict({"fields": [{"name": "f", **rule}]}).rule("f")
        want = {x.id: x.f for x in apply_policy(df, Policy.from_dict({"fields": [{"name": "f", **rule}]})).collect()}
        ranges = F.array(*[F.lit(x) for x in r.ranges or []]).cast("array<int>")
        column = F.struct(F.lit(r.is_pii), F.lit(r.operation), F.lit(r.type), F.lit(r.mask_format).cast("string"), ranges).cast(RULE)
        fv = V.typed_value(F.col("f"), "f", df.schema["f"].dataType, F.lit(0).cast("bigint"))
        got = {x.id: x.f for x in df.withColumn("r", column).select("id", by_rule(fv, F.col("r")).alias("f")).collect()}
        assert got == want, rule


def test_reasons_come_from_the_records_own_shape(spark):
    deep, flat = "[" * 600 + "]" * 600, "[" + "[]," * 600 + "1]"
    records = {
        '{"id":"1","a":%s}' % deep: "too_deep", '{"id":"2","a":%s' % flat: "parse_error", '{"id":"3","a":%s}' % flat: None,
        '{"id":"4","a":"%s"}' % ("[{" * 700): None, '{"id":"5","a":"%s' % ("7" * 1200): "parse_error", '{"id":"6","a":%s}' % ("7" * 1200): "long_number",
        '{"id":"7","a":"\\"%s"' % deep: "parse_error", '{"id":"8","a":"%s"}' % ("7" * 1200): None, '{"a":%s}' % flat: "missing_id", "": "parse_error",
    }
    df = spark.createDataFrame([(x,) for x in records], "value string")
    got = {r.raw: r.reason for r in protect_json(df, Policy.from_dict({"fields": [{"name": "id"}]}), with_raw=True).collect()}
    assert got == records


def test_a_record_beyond_the_size_limit_has_its_own_reason(spark, monkeypatch):
    monkeypatch.setattr(V, "MAX_BYTES", 50)
    df = spark.createDataFrame([('{"id":"1","a":"%s"' % ("x" * 90),), ('{"id":"2","a":"%s"}' % ("x" * 90),)], "value string")
    got = [r.reason for r in protect_json(df, Policy.from_dict({"fields": [{"name": "id"}]})).collect()]
    assert sorted(got, key=str) == [None, "too_large"]


def test_rules_table_writes_what_the_compiled_policy_writes(spark, monkeypatch):
    from policies import M1, M2, MEMBER_POLICY

    from veilspark.operators import rules_table
    from veilspark.operators.protect import apply_policy_json
    from veilspark.policy import rules_frame

    fields = MEMBER_POLICY["fields"] + [{"name": "o"}, {"name": "s", "isPII": True, "type": "string"}, {"name": "o", "isPII": True}, {"name": "n", "isPII": True, "type": "integer", "piiOperation": "redact"}, {"name": "id", "isPII": True}]
    fields = [f for f in fields if f.get("piiOperation") != "randomize"]
    policy = Policy.from_dict({**MEMBER_POLICY, "fields": fields})
    records = [M1, M2, M2, '{"id":1}', '{"id":"x","o":{"z":1,"a":[2, "\\""]},"s":"h\\u00e9llo","n":null}', '{"id":null,"s":5,"s":"last","o":{"b":1}}', "broken", '{"no":1}',
               '{"id":"big","o":123456789012345678901234567890,"other":1,"n":1.50}', '{"id":{"k":1},"s":""}']
    df = spark.createDataFrame([(r,) for r in records], "value string")
    want = sorted(r.value for r in apply_policy_json(df, policy).collect())
    rules = rules_frame(spark, policy)
    assert sorted(r.value for r in rules_table.protect_json_by_table(df, rules).collect()) == want
    monkeypatch.setattr(rules_table, "MAX_BROADCAST_RULES", 0)
    assert sorted(r.value for r in rules_table.protect_json_by_table(df, rules).collect()) == want
    assert rules_table.protect_json_by_table(df.limit(0), rules).collect() == []
