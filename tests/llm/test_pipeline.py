import os
import shutil
import tempfile

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as E
import corpus_pipeline
from tests.llm.helpers import near_components, rows_of
from tests.llm.test_dedup import brute_exact
from tests.llm.test_mix_shard import brute_targets
from tests.llm.test_text import reference_encoder
from veilspark.llm import quality, queries
from veilspark.llm.common import saved, table

SF = "/root/testdata/sf0.01"


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(E.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mix", "bpe"]


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, name):
    got = E.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLES[name]})").fetchall()
    assert rows_of(got, *cols) == sorted(want, key=repr)


def test_stages_match_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    model = quality.fit(docs, table(spark, SF, "labels"))
    verdict = {r["doc_id"]: r["accepted"] for r in quality.classify(docs, model, ["doc_id"]).collect()}
    text = {r["doc_id"]: r for r in docs.collect()}
    ids = [i for i in text if verdict[i]]

    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), "test-stage")
        out[name] = docs
    assert all(out[n].columns == columns for n, _ in corpus_pipeline.STAGES[:-1])
    assert sorted(r["doc_id"] for r in out["quality"].collect()) == sorted(ids)
    bad = {r["doc_id"] for r in table(spark, SF, "labels").where("quality = 0").collect()}
    good = {r["doc_id"] for r in table(spark, SF, "labels").where("quality = 1").collect()}
    assert len(bad & set(ids)) <= 0.05 * len(bad) and len(good - set(ids)) <= 0.02 * len(good)

    ids = sorted({keep for i, keep, _, _ in brute_exact([(i, text[i]["text"]) for i in ids])})
    assert sorted(r["doc_id"] for r in out["exact_dedup"].collect()) == ids
    near = near_components([(i, text[i]["text"]) for i in ids], 5)
    ids = sorted(i for i in ids if near[i] == i)
    assert sorted(r["doc_id"] for r in out["near_dedup"].collect()) == ids

    sizes: dict = {}
    for i in ids:
        sizes[text[i]["source"]] = sizes.get(text[i]["source"], 0) + len(text[i]["text"].encode().split())
    want, taken = brute_targets(sizes), dict.fromkeys(sizes, 0)
    mixed = out["mix"].collect()
    for r in mixed:
        assert r == text[r["doc_id"]] and r["doc_id"] in set(ids)
        taken[r["source"]] += len(r["text"].encode().split())
    largest = max(len(text[i]["text"].encode().split()) for i in ids)
    assert all(abs(taken[s] - want[s]) <= largest for s in want)

    enc = reference_encoder()
    assert rows_of(out["bpe"], "doc_id", "n_tokens") == sorted(((r["doc_id"], len(enc.encode_ordinary(r["text"]))) for r in mixed), key=repr)


def test_run_is_the_stages_in_turn(spark):
    a = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    for _, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, "/root/testdata/sf0.001"), "test-stage")
    assert rows_of(a, *a.columns) == rows_of(docs, *a.columns)


def test_empty_tables(spark):
    """Every query and the pipeline give an empty result for empty tables."""
    folder = tempfile.mkdtemp(prefix="veilspark-empty-")
    for t in ("documents", "embeddings", "labels", "benchmark"):
        table(spark, "/root/testdata/sf0.001", t).limit(0).write.parquet(f"{folder}/{t}.parquet")
    for name in [*queries.QUERIES, "pipeline"]:
        assert E.queries()[name](spark, folder).collect() == [], name


def test_library_runs_without_the_subpackage():
    """The entry point imports and lists the other queries when the subpackage is gone."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(E.__file__))
    copy = tempfile.mkdtemp(prefix="veilspark-copy-")
    shutil.copytree(f"{root}/veilspark", f"{copy}/veilspark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", copy)
    code = "import __spark_entry__ as E; q = E.queries(); assert len(q) >= 30 and not any(n.startswith('op') or n == 'pipeline' for n in q); E.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
