"""Typed-column path: the same operations on DataFrame columns."""

import base64
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from veilspark.functions.masking import format_runs
from veilspark.functions.registry import operation_names, register_operation
from veilspark.operators.protect import apply_policy
from veilspark.policy import Policy


def pol(*fields):
    return Policy.from_dict({"fields": list(fields)})


def test_allow_list_and_order(spark):
    df = spark.createDataFrame([(1, "Ann", 30, "x")], "id int, name string, age int, extra string")
    out = apply_policy(df, pol({"name": "age"}, {"name": "name", "isPII": True}))
    assert out.columns == ["id", "age", "name"]
    assert out.first().asDict() == {"id": 1, "age": 30, "name": "A*n"}


def test_runtime_types_on_columns(spark):
    df = spark.createDataFrame([(1, 42, 4294967316, 29.9, True, "abc", None)],
                               "id int, i int, l bigint, d double, b boolean, s string, n string")
    p = pol(
        {"name": "i", "isPII": True, "piiOperation": "mask"},  # declared string: text of 42
        {"name": "l", "isPII": True, "piiOperation": "generalize", "ranges": [0, 18, 30]},
        {"name": "d", "isPII": True, "piiOperation": "generalize", "ranges": [0, 18, 30]},
        {"name": "b", "isPII": True, "piiOperation": "hash"},
        {"name": "s", "isPII": True, "piiOperation": "redact"},
        {"name": "n", "isPII": True, "piiOperation": "redact"},
    )
    r = apply_policy(df, p).first()
    assert (r.i, r.l, r.d, r.s, r.n) == ("**", "18-30", "18-30", "[REDACTED]", None)
    assert r.b == base64.b64encode(hashlib.sha256(b"true").digest()).decode()


def test_decimal_and_float_text(spark):
    """Distinct decimals hash apart, and a float is hashed by its own digits."""
    from decimal import Decimal

    df = spark.createDataFrame([(1, Decimal(12345678901234567890), 0.1), (2, Decimal(12345678901234567891), 0.1)], "id int, d decimal(20,0), f float")
    p = pol({"name": "d", "isPII": True, "piiOperation": "hash"}, {"name": "f", "isPII": True, "piiOperation": "hash"})
    a, b = sorted(apply_policy(df, p).collect(), key=lambda r: r.id)
    assert a.d != b.d and a.d == base64.b64encode(hashlib.sha256(b"12345678901234567890").digest()).decode()
    assert a.f == base64.b64encode(hashlib.sha256(b"0.1").digest()).decode()


def test_text_with_a_final_newline_is_no_number(spark):
    df = spark.createDataFrame([(1, "42\n"), (2, "42")], "id int, s string")
    p = pol({"name": "s", "isPII": True, "piiOperation": "generalize", "ranges": [10, 50]})
    assert [r.s for r in apply_policy(df, p).orderBy("id").collect()] == ["<10", "10-50"]


def test_randomized_fields_are_independent(spark):
    """Fields of a row share no draws: equal texts, equal relative draws and unchanged values stay rare."""
    df = spark.range(600).selectExpr("id", "'abcdefgh' a", "'abcdefgh' b", "10000 i", "20000 j", "50.0D x", "100.0D y")
    p = pol(*[{"name": n, "isPII": True, "piiOperation": "randomize", "type": t}
              for n, t in (("a", "string"), ("b", "string"), ("i", "integer"), ("j", "integer"), ("x", "double"), ("y", "double"))])
    for out in (apply_policy(df, p), apply_policy(df, p, seed_col=F.col("id"))):
        r = out.collect()
        assert sum(x.a == x.b or x.a == "abcdefgh" for x in r) == 0
        assert sum(abs(x.i / 10000 - x.j / 20000) < 1e-3 for x in r) < 30 and sum(x.i == 10000 for x in r) < 10
        assert sum(abs(x.x / 50 - x.y / 100) < 1e-6 for x in r) == 0
        assert min(x.x for x in r) < 42 and max(x.x for x in r) > 58


def test_hash_key_changes_output(spark):
    df = spark.createDataFrame([(1, "abc")], "id int, s string")
    p = pol({"name": "s", "isPII": True, "piiOperation": "hash"})
    assert apply_policy(df, p).first().s != apply_policy(df, p, hash_key="k").first().s


def test_randomize_text_keeps_other_columns_and_replays_with_seed(spark):
    df = spark.range(200).select(F.col("id"), F.concat(F.lit("name-"), F.col("id").cast("string")).alias("s"),
                                 F.col("id").cast("int").alias("n"))
    p = pol({"name": "s", "isPII": True, "piiOperation": "randomize"},
            {"name": "n", "isPII": True, "piiOperation": "randomize", "type": "int"})
    a = apply_policy(df, p, seed_col=F.col("id")).orderBy("id").collect()
    b = apply_policy(df, p, seed_col=F.col("id")).orderBy("id").collect()
    assert a == b
    assert all(len(r.s) == len(f"name-{r.id}") and r.s.isalnum() for r in a)
    v = [max(1, int(abs(i) * 0.2)) for i in range(200)]
    assert all(i - v[i] <= r.n <= i + v[i] - 1 for i, r in enumerate(a))


def test_format_runs():
    assert format_runs("XX**-X") == [(True, 1, 2), (False, 3, 3), (True, 6, 1)]


def test_registry_extension(spark):
    register_operation("upper", lambda v, r: v.out(F.upper(v.text)))
    assert "upper" in operation_names()
    df = spark.createDataFrame([(1, "abc")], "id int, s string")
    assert apply_policy(df, pol({"name": "s", "isPII": True, "piiOperation": "upper"})).first().s == "ABC"


@pytest.mark.parametrize("fmt", ["X", "XXXX****", "*X*X*X", "x-x-x-x-x-x-x-x-x-x-x-x-x-x-x-x-x-x-x-x", "@@@@"])
def test_mask_format_against_brute_force(spark, fmt):
    names = [r[0] for r in duckdb.sql(f"SELECT c_name FROM '{SF_SMALL}/customer.parquet'").fetchall()]
    df = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    got = {r.c_custkey: r.c_name for r in
           apply_policy(df, pol({"name": "c_name", "isPII": True, "maskFormat": fmt}), id_col="c_custkey").collect()}

    def brute(v):
        out = "".join(v[i] if fmt[i] in "Xx" else "*" for i in range(min(len(fmt), len(v))))
        return out + "*" * max(0, len(v) - len(fmt))
    keys = [r[0] for r in duckdb.sql(f"SELECT c_custkey FROM '{SF_SMALL}/customer.parquet'").fetchall()]
    assert all(got[k] == brute(n) for k, n in zip(keys, names))


def test_hmac_matches_python(spark):
    import base64
    import hashlib
    import hmac

    df = spark.createDataFrame([(1, "abc"), (2, "é" * 100)], "id int, s string")
    p = pol({"name": "s", "isPII": True, "piiOperation": "hash"})
    for key in ("k", "x" * 100):
        got = {r.id: r.s for r in apply_policy(df, p, hash_key=key).collect()}
        for i, v in ((1, "abc"), (2, "é" * 100)):
            want = base64.b64encode(hmac.new(key.encode(), v.encode(), hashlib.sha256).digest()).decode()
            assert got[i] == want


def test_random_text_is_uniform_and_exact_length(spark):
    from collections import Counter

    from veilspark.functions.randomness import ALPHANUMERIC, random_alnum, row_seed

    df = spark.range(400).select(((F.col("id") * 37) % 1000).cast("int").alias("n")) \
        .select("n", row_seed().alias("seed"))
    rows = df.select("n", random_alnum(F.col("n"), F.col("seed")).alias("a")).collect()
    assert all(len(r.a) == r.n for r in rows)
    counts = Counter("".join(r.a for r in rows))
    assert set(counts) <= set(ALPHANUMERIC) and len(counts) == 62
    total = sum(counts.values())
    expected = total / 62
    chi2 = sum((counts[c] - expected) ** 2 / expected for c in ALPHANUMERIC)
    assert chi2 < 120  # 61 degrees of freedom; the 99.99th percentile is about 110


def test_column_names_with_dots_and_spaces(spark):
    df = spark.createDataFrame([(1, "abcd", "xyz", 7)], "`id` int, `a.b` string, `c d` string, `n.1` int")
    p = pol({"name": "a.b", "isPII": True}, {"name": "c d", "isPII": True, "piiOperation": "randomize"},
            {"name": "n.1", "isPII": True, "piiOperation": "generalize", "type": "integer", "ranges": [0, 10]})
    r = apply_policy(df, p).first()
    assert r["a.b"] == "a**d" and len(r["c d"]) == 3 and r["n.1"] == "0-10"


def test_typed_and_json_paths_agree(spark):
    import json

    from veilspark.operators.protect import apply_policy_json

    p = pol({"name": "c_name", "isPII": True, "maskFormat": "XX*X"},
            {"name": "c_mktsegment", "isPII": True, "piiOperation": "hash"},
            {"name": "c_nationkey", "isPII": True, "piiOperation": "generalize", "type": "integer", "ranges": [5, 15]},
            {"name": "c_acctbal", "isPII": True, "piiOperation": "generalize", "type": "double", "ranges": [0, 3000]})
    c = spark.read.parquet(f"{SF_SMALL}/customer.parquet")
    typed = {r.c_custkey: r.asDict() for r in apply_policy(c, p, id_col="c_custkey").collect()}
    docs = c.select(F.to_json(F.struct(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_nationkey",
                                       "c_acctbal")).alias("value"))
    for r in apply_policy_json(docs, p).collect():
        j = json.loads(r.value)
        t = typed[int(j["id"])]
        assert {k: j[k] for k in ("c_name", "c_mktsegment", "c_nationkey", "c_acctbal")} == \
            {k: t[k] for k in ("c_name", "c_mktsegment", "c_nationkey", "c_acctbal")}


def test_randomize_int_at_the_32_bit_edges(spark):
    imin, imax = -(2**31), 2**31 - 1
    df = spark.createDataFrame([(i, x) for i, x in enumerate([imax, imin, imin + 1] * 50)], "id int, n int")
    p = pol({"name": "n", "isPII": True, "piiOperation": "randomize", "type": "integer"})
    src = {r.id: r.n for r in df.collect()}
    for r in apply_policy(df, p).collect():
        x = src[r.id]
        v = 1 if x == imin else max(1, int(abs(x) * 0.2))
        # the result is x - v + k for some k in [0, 2v), wrapped to 32 bits as the JVM does
        assert (r.n - (x - v)) % 2**32 < 2 * v
