"""Keyed hashes under a table of keys: rotation, tenants, verification, and plans that hold no secret."""

import base64
import datetime as dt
import hashlib
import hmac
import json

import pytest

from veilspark.operators import keys as K
from veilspark.policy import Policy

JAN, FEB, MAR = (dt.datetime(2024, m, 1, tzinfo=dt.timezone.utc) for m in (1, 2, 3))
SECRETS = {"k1": b"first", "k2": bytes(range(256)), "k3": b"x" * 64}
POLICY = Policy.from_dict({"fields": [{"name": "mail", "type": "string", "isPII": True, "piiOperation": "hash"},
                                      {"name": "n", "type": "integer", "isPII": False}]})


def digest(key_id, text):
    return f"{key_id}:" + base64.b64encode(hmac.new(SECRETS[key_id], text.encode(), hashlib.sha256).digest()).decode()


@pytest.fixture(scope="module")
def key_path(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('keys')}/table"
    K.add_key(spark, path, "k1", SECRETS["k1"], JAN)
    K.add_key(spark, path, "k2", SECRETS["k2"], FEB, MAR)
    K.add_key(spark, path, "k3", SECRETS["k3"], MAR + dt.timedelta(days=10))
    return path


ROWS = [(1, "a@b.example", JAN), (2, "a@b.example", FEB), (3, "ü" * 300, MAR + dt.timedelta(days=10)),
        (4, "a@b.example", JAN - dt.timedelta(seconds=1)),  # before the first key
        (5, "a@b.example", MAR),                            # the key has ended
        (6, "", FEB), (7, None, FEB), (8, "a@b.example", None), (9, "a@b.example", FEB - dt.timedelta(seconds=1))]
USED = {1: "k1", 2: "k2", 3: "k3", 6: "k2", 7: "k2", 9: "k1"}


def records(spark):
    rows = [(i, json.dumps({"id": i, "n": 1} | ({"mail": m} if m is not None else {})), t) for i, m, t in ROWS]
    return spark.createDataFrame([*rows, (10, "{", FEB)], "i int, value string, ts timestamp")


@pytest.mark.parametrize("most", [K.MAX_BROADCAST_KEYS, 0])
def test_records_are_hashed_under_the_key_of_their_time(spark, key_path, monkeypatch, most):
    monkeypatch.setattr(K, "MAX_BROADCAST_KEYS", most)
    got = {r.i: r for r in K.protect_json_keyed(records(spark), POLICY, spark.read.parquet(key_path), "ts", keep=["i"]).collect()}
    assert len(got) == 10 and got[10].reason == "parse_error" and got[10].value is None
    for i, mail, _ in ROWS:
        if i not in USED:
            assert (got[i].value, got[i].reason) == (None, K.REASON_NO_KEY)
            continue
        want = {} if mail is None else {"mail": digest(USED[i], mail) if mail else ""}
        assert got[i].reason is None and json.loads(got[i].value) == {"id": str(i), "n": 1} | want


@pytest.mark.parametrize("most", [K.MAX_BROADCAST_KEYS, 0])
def test_old_and_new_hashes_are_verified(spark, key_path, monkeypatch, most):
    monkeypatch.setattr(K, "MAX_BROADCAST_KEYS", most)
    t = spark.createDataFrame(ROWS, "id int, mail string, ts timestamp")
    out = K.apply_policy_keyed(t, POLICY, spark.read.parquet(key_path), "ts", keep=["ts"])
    assert out.columns == ["ts", "id", "mail"]
    hashed = {r.id: r.mail for r in out.collect()}
    assert hashed == {i: (digest(USED[i], m) if m else m) if i in USED else (None if m else m) for i, m, _ in ROWS}
    claims = [(f"{a}-{b}", hashed[a], m) for a in (1, 2, 3, 6, 7) for b, m, _ in ROWS[:3]]
    claims += [("gone", "k9:abc", "a@b.example"), ("bare", "abc", "a@b.example"), ("null", hashed[1], None), ("empty", "", "")]
    got = {r.c: r.verified for r in K.verify(spark.createDataFrame(claims, "c string, h string, t string"), "h", "t", spark.read.parquet(key_path)).collect()}
    same = {i: m for i, m, _ in ROWS}
    for a in (1, 2, 3):
        for b in (1, 2, 3):
            assert got[f"{a}-{b}"] is (same[a] == same[b])
    assert got["6-1"] is False and got["7-1"] is None  # a hash of nothing; no hash
    assert (got["gone"], got["bare"], got["null"], got["empty"]) == (False, False, None, True)


@pytest.mark.parametrize("most", [K.MAX_BROADCAST_KEYS, 0])
def test_tenants_have_keys_of_their_own(spark, monkeypatch, most):
    monkeypatch.setattr(K, "MAX_BROADCAST_KEYS", most)
    keys = spark.createDataFrame([("a", "k1", SECRETS["k1"], JAN), (None, "k2", SECRETS["k2"], JAN), ("b", "none", b"", JAN), ("a", None, b"s", FEB)],
                                 "tenant string, key_id string, secret binary, valid_from timestamp")
    t = spark.createDataFrame([(1, "a", "x", MAR), (2, None, "x", MAR), (3, "b", "x", MAR), (4, "c", "x", MAR)], "id int, tenant string, mail string, ts timestamp")
    got = {r.id: r.mail for r in K.apply_policy_keyed(t, POLICY, keys, "ts", by=["tenant"]).collect()}
    assert got == {1: digest("k1", "x"), 2: digest("k2", "x"), 3: None, 4: None}
    assert K.apply_policy_keyed(t, POLICY, keys.limit(0), "ts", by=["tenant"]).where("mail is not null").count() == 0
    assert K.apply_policy_keyed(t.limit(0), POLICY, keys, "ts", by=["tenant"]).count() == 0


def test_no_plan_holds_a_key(spark, key_path):
    out = K.protect_json_keyed(records(spark), POLICY, spark.read.parquet(key_path), "ts")
    plan = out._jdf.queryExecution().toString() + out._jdf.queryExecution().explainString(
        spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("extended"))
    first = SECRETS["k1"].ljust(64, b"\0")
    for pad in (0, 0x36, 0x5C):
        assert bytes(b ^ pad for b in first[:5]).hex().upper() not in plan.upper()
    assert "inner_pad" in plan


def test_bad_keys_are_refused(spark, tmp_dir):
    for key_id, secret in (("", b"s"), ("a:b", b"s"), ("a", b"")):
        with pytest.raises(ValueError):
            K.add_key(spark, tmp_dir, key_id, secret, JAN)
