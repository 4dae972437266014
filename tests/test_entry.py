"""The driver contract, and every registered query against its SQL oracle on sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from veilspark.plans import catalog
from veilspark.plans.inputs import TABLES


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["value"] and df.count() > 0


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLES) == set(catalog.QUERIES) <= set(E.queries())
    assert len(catalog.QUERIES) >= 30


def test_bench_prints_one_json_line():
    import json
    import os
    import subprocess
    import sys

    from conftest import ROOT

    env = {**os.environ, "BENCH_SF_DIR": SF_SMALL, "BENCH_QUERIES": "mask_default,redact", "BENCH_REPEAT": "1",
           "BENCH_CPUS": "2", "BENCH_DRIVER_MEMORY": "2g"}
    out = subprocess.run([sys.executable, f"{ROOT}/bench.py"], env=env, capture_output=True, text=True, timeout=600)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert out.returncode == 0 and len(lines) == 1
    b = json.loads(lines[0])
    assert b["unit"] == "sec" and set(b["queries"]) == {"mask_default", "redact"} and b["sf"] == 0.001


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def canon(rows):
    def v(x):
        if x is None:
            return None
        if isinstance(x, float):
            return "NaN" if math.isnan(x) else x
        if hasattr(x, "isoformat"):
            return x.isoformat()[:10] if type(x).__name__ == "date" else x.isoformat()
        return x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = canon(tuple(r[c] for c in cols) for r in sdf.collect())
    res = con.execute(f"SELECT {', '.join(cols)} FROM ({E.oracle_sql()[name]})")
    want = canon(res.fetchall())
    assert got == want
