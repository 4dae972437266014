import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import docs, documents, rows_of
from veilspark.llm import mixing, sharding


def brute_targets(sizes, weights=(1, 2, 3), times=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        target = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > times * sizes[s]]
        if not over:
            return {**target, **capped}
        capped |= {s: times * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, "c": 1000, "d": 1, None: 40}, {"a": 7}, {"a": 1, "b": 10 ** 6}, {"Z": 30, "a": 30, "é": 30, "b": 0}])
def test_targets(spark, sizes):
    got = mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"))
    want = brute_targets(sizes)
    assert {r["source"]: r["target"] for r in got.collect()} == pytest.approx(want)


def test_mix_meets_targets(spark):
    t = documents("/root/testdata/sf0.01")
    rows = [(int(i), x, s if s != "src3" else None) for i, x, s in zip(t.doc_id, t.text, t.source)]
    d = docs(spark, rows)
    got = mixing.mix(d).collect()
    size, taken = defaultdict(int), defaultdict(int)
    text = {r[0]: r for r in rows}
    for r in got:
        assert r["size"] == len(text[r["doc_id"]][1].encode().split()) and 0 <= r["copies"] <= 3
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["size"] * r["copies"]
    want = brute_targets(dict(size))
    largest = max(r["size"] for r in got)
    for s in want:
        assert abs(taken[s] - want[s]) <= largest
    assert all(r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == size[r["source"]] for r in got)
    again = mixing.mix(d.repartition(7))
    assert rows_of(again, "doc_id", "copies") == sorted(((r["doc_id"], r["copies"]) for r in got), key=repr)
    out = mixing.take_mix(d)
    assert out.columns == d.columns and out.count() == sum(r["copies"] for r in got)


def test_thresholds_refine_only_as_far_as_needed(spark):
    """Hashes that differ in their last bits only: the boundary is found in the last digit."""
    rows = [(("s",), 16 * i, 10) for i in range(20)]
    d = spark.createDataFrame([(r[0][0], r[1], r[2]) for r in rows], "source string, hash long, size long")
    budgets = spark.createDataFrame([("s", 64.0)], "source string, budget double")
    cut = mixing.thresholds(d, budgets).collect()[0]["threshold"]
    assert sum(1 for r in rows if r[1] >> 4 < cut) in (6, 7)


def test_mix_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (3, "one two", None), (None, "x y z", "b"), (None, None, None), (4, "w " * 50_000, "b"), (3, "one two", None)]
    got = mixing.mix(docs(spark, rows)).collect()
    assert len(got) == len(rows) and sorted(r["size"] for r in got) == [0, 0, 0, 2, 2, 3, 50_000]
    same = [r["copies"] for r in got if r["doc_id"] == 3]
    assert same[0] == same[1]  # rows equal in id and text are taken together
    assert mixing.mix(docs(spark, [])).collect() == [] and mixing.take_mix(docs(spark, [])).collect() == []
    empty = mixing.mix(docs(spark, [(1, None, "a")])).collect()[0]
    assert (empty["target"], empty["copies"]) == (0.0, 0)


def jump(seed_numbers, shards):
    at, nxt, i = 0, 0, 0
    while nxt < shards:
        at = nxt
        nxt = int((at + 1) / seed_numbers[i])
        i += 1
    return at


def test_shard_laws(spark):
    t = documents("/root/testdata/sf0.01")
    d = docs(spark, list(zip(t.doc_id.tolist(), t.text)))
    got = sharding.shard_rows(d, 24, rows_per_block=10).collect()
    slots = defaultdict(list)
    text = dict(zip(t.doc_id, t.text))
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
        assert r["size"] == len(text[r["doc_id"]].encode()) + 8 and r["text_crc32"] == zlib.crc32(text[r["doc_id"]].encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 24
    moved = sum(r["grown_shard"] == 24 for r in got)
    assert 10 <= moved <= 90  # a twenty-fifth of 1,000


def test_jump_matches_its_definition(spark):
    k = spark.range(200)
    steps = [((F.shiftrightunsigned(F.xxhash64(F.xxhash64("id"), F.lit(i)), 33) + 1) / F.lit(float(1 << 31))).alias(f"r{i}") for i in range(1, 200)]
    for shards in (1, 24, 100):
        rows = k.select(sharding.jump_shard(F.col("id"), shards).alias("s"), *steps).collect()
        assert all(r["s"] == jump(list(r)[1:], shards) for r in rows)


def test_shard_odd_rows(spark):
    rows = [(1, None), (None, None), (None, "a"), (1, None), (2, "é" * 100_000)]
    got = sharding.shard_rows(docs(spark, rows), 24).collect()
    assert len(got) == 5 and sorted(r["size"] for r in got) == [8, 8, 8, 9, 200_008]
    assert len({r["shard"] for r in got if r["doc_id"] == 1}) == 1
    assert [r["text_crc32"] for r in got if r["size"] == 8] == [0, 0, 0]
    assert sharding.shard_rows(docs(spark, []), 24).collect() == []


def test_write_shards(spark, tmp_dir):
    d = docs(spark, [(i, f"t{i}") for i in range(50)])
    sharding.write_shards(d, tmp_dir + "/out", 4)
    back = spark.read.parquet(tmp_dir + "/out")
    assert back.count() == 50 and set(back.columns) == set(d.columns)
    want = {r["doc_id"]: r["s"] for r in d.select("doc_id", sharding.jump_shard(F.col("doc_id"), 4).alias("s")).collect()}
    assert {r["doc_id"]: int(r["shard"]) for r in back.collect()} == want
