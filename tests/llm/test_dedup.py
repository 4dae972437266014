import hashlib
import os
import random
import re
import tempfile

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import docs, documents, near_components, rows_of, shingles
from veilspark.llm import common, components, exact_dedup, near_dedup
from veilspark.session import checkpoint_dir

ODD = [(1, "a  b"), (2, "a b"), (3, None), (4, ""), (5, "a\tb "), (None, "a b"), (None, "n"), (7, "n"), (2, "a b"), (8, "x" * 3_000_00), (9, "x" * 3_000_00)]


def brute_exact(rows):
    norm = [re.sub("[ \t-\r]+", " ", t or "") for _, t in rows]
    out = []
    for (i, _), n in zip(rows, norm):
        ids = [j for (j, _), m in zip(rows, norm) if m == n]
        real = [j for j in ids if j is not None]
        out.append((i, min(real) if real else None, len(ids), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_exact_groups_match_brute_force(spark):
    t = documents()
    rows = list(zip(t.doc_id.tolist(), t.text))
    want = brute_exact(rows)
    for memory in (exact_dedup.MEMORY_BYTES, 3000):  # the small table spills on several levels
        got = exact_dedup.exact_groups(docs(spark, rows), memory)
        assert rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256") == want
        assert all(r["kept"] == (r["doc_id"] == r["keep_id"]) for r in got.collect())


def test_exact_groups_odd_rows(spark):
    got = exact_dedup.exact_groups(docs(spark, ODD))
    assert rows_of(got, "doc_id", "keep_id", "group_size", "text_sha256") == brute_exact(ODD)
    kept = [r for r in got.collect() if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in kept}) == len({r["text_sha256"] for r in got.collect()})  # one row of each group, repeated ids too
    out = exact_dedup.drop_exact_copies(docs(spark, ODD))
    assert out.columns == docs(spark, ODD).columns
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3, 5, 7, 8]


def test_exact_groups_without_ids(spark):
    got = exact_dedup.exact_groups(docs(spark, [(None, "a"), (None, "a"), (None, None)])).collect()
    assert sorted((r["keep_id"], r["group_size"], r["kept"]) for r in got if r["group_size"] == 2) == [(None, 2, False), (None, 2, True)]
    assert exact_dedup.exact_groups(docs(spark, [])).collect() == []
    assert exact_dedup.drop_exact_copies(docs(spark, [])).collect() == []


def test_grace_compares_complete_contents(monkeypatch):
    """Equal hashes with different contents stay apart, at every level, and no spill file is left."""
    folder = tempfile.mkdtemp(prefix="grace-test-")
    monkeypatch.setattr(tempfile, "tempdir", folder)
    key = bytes(32)
    records = [(key, b"t%d" % (i % 50) + b"x" * 50, (0, i, i), 1, 1) for i in range(500)]
    random.Random(1).shuffle(records)
    got = sorted((e[1], e[2], e[3]) for e in exact_dedup.grace_groups(iter(records), memory_bytes=500))
    assert got == sorted((b"t%d" % i + b"x" * 50, (0, i, i), 10) for i in range(50))
    assert os.listdir(folder) == []


def test_components(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(40)]
    hub = [(100, 100 + i) for i in range(1, 60)]
    some = [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    edges = path + hub + some + [(5, 5), (7, 6)]
    from tests.llm.helpers import components as brute
    want = {a: b for a, b in brute(edges, {x for e in edges for x in e}).items() if a != b}
    got = components.stars(spark.createDataFrame(edges, "u long, v long"))
    assert {r["u"]: r["v"] for r in got.collect()} == want
    assert components.stars(spark.createDataFrame([], "u long, v long")).collect() == []


def test_components_of_stars_need_no_step(spark, monkeypatch):
    """Whether edges are stars is seen from the edges, not from a further step that changes nothing."""
    steps = []
    monkeypatch.setattr(components, "_large_star", lambda e, step=components._large_star: steps.append(1) or step(e))
    made = components.stars(spark.createDataFrame([(1, 5), (6, 1), (9, 8), (5, 1)], "u long, v long"))
    assert {tuple(r) for r in made.collect()} == {(5, 1), (6, 1), (9, 8)} and not steps
    made = components.stars(spark.createDataFrame([(5, 9), (5, 7), (5, 3)], "u long, v long"))
    assert {tuple(r) for r in made.collect()} == {(9, 3), (7, 3), (5, 3)} and len(steps) == 1


def test_rounds_leave_no_tables_or_shuffles(spark):
    """What a round wrote for the next one goes when the next one is done; of a saved table only its files stay."""
    folder = checkpoint_dir(spark).removeprefix("file:")
    count = lambda: [sum(f"llm-{x}-" in n for n in os.listdir(folder)) for x in ("open", "pairs", "links", "edges")]
    before = count()
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(base + [f"own{i // 2}x{j}" for j in range(30)] + [f"v{i}"])) for i in range(40)]
    got = near_dedup.near_components(docs(spark, rows), k=2, bands=1, rows=1).collect()
    assert len({r["component_id"] for r in got}) < 40 and len(got) == 40
    assert [b - a for a, b in zip(before, count())] == [0, 0, 0, 1]  # the last components are read by the result
    conf = spark.conf.get(common.SHUFFLE_CLEANUP)
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffles = lambda: {b.toString() for b in [disk.getAllBlocks().apply(i) for i in range(disk.getAllBlocks().size())] if b.toString().startswith("shuffle_")}
    there = shuffles()
    t = common.saved(spark.range(1000).groupBy(F.col("id") % 7).count(), "test")
    assert t.count() == 7 and spark.conf.get(common.SHUFFLE_CLEANUP) == conf
    common.forget(t, None)
    assert not any("llm-test-" in n for n in os.listdir(folder)) and len(shuffles() - there) <= 2  # of the count


def test_near_components_match_brute_force(spark):
    t = documents("/root/testdata/sf0.01").head(600)
    rows = list(zip(t.doc_id.tolist(), t.text))
    for k in (2, 5):
        want = near_components(rows, k)
        got = near_dedup.near_components(docs(spark, rows), k=k)
        assert rows_of(got, "doc_id", "component_id") == sorted(want.items(), key=repr)
        assert {r["doc_id"]: r["n_shingles"] for r in got.collect()} == {i: len(shingles(x, k)) for i, x in rows}


def test_near_components_rounds(spark):
    """Variants of one text, most pairs of which are below the threshold: links run through texts that may be no centre."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(1, 14)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10000)}"
        rows.append((i + 10, " ".join(w)))
    got = near_dedup.near_components(docs(spark, rows), k=2)
    assert rows_of(got, "doc_id", "component_id") == sorted(near_components(rows, 2).items(), key=repr)


def test_near_components_until_no_open_pair(spark):
    """Pairs of similar texts in one large bucket of texts that are not similar to them, and rounds that link nothing before they meet."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(30):
        w = base + [f"own{i}x{j}" for j in range(30)]
        rows.append((100 + i, " ".join(w)))
    for i in range(3):  # the light pairs
        w = base + [f"pair{i}x{j}" for j in range(30)]
        rows += [(10 + i, " ".join(w)), (50 + i, " ".join(w[:-rng.randrange(1, 4)]))]
    want = near_components(rows, 2)
    assert sum(a != b for a, b in want.items()) == 3
    for rows_of_band in (1, 2):
        sigs = [near_dedup.OnePermutation(1, rows_of_band).band_keys(near_dedup.shingle_set(t.encode(), 2, near_dedup._WordHashes()))[0] for _, t in rows]
        got = near_dedup.near_components(docs(spark, rows), k=2, bands=1, rows=rows_of_band)
        same = {i: s for (i, _), s in zip(rows, sigs)}
        sure = {i: (c if same[i] == same[c] else i) for i, c in want.items()}
        assert rows_of(got, "doc_id", "component_id") == sorted(sure.items(), key=repr)


def test_near_components_of_a_bucket_in_parts(spark, monkeypatch):
    """A large bucket dealt to parts of a few members gives what one task gives, links between parts too."""
    rng = random.Random(11)
    base = [f"w{i}" for i in range(70)]
    rows = []
    for i in range(70):
        w = base[:] + [f"own{i // 3}x{j}" for j in range(18)]
        w[rng.randrange(70)] = f"v{i}"
        rows.append((i + 1, " ".join(w)))
    want = sorted(near_components(rows, 2).items(), key=repr)
    assert 1 < len({c for _, c in want}) < len(want)
    sigs = {near_dedup.OnePermutation(1, 1).band_keys(near_dedup.shingle_set(t.encode(), 2, near_dedup._WordHashes()))[0] for _, t in rows}
    assert len(sigs) < 30  # few buckets for 70 texts
    got = [rows_of(near_dedup.near_components(docs(spark, rows), k=2, bands=6, rows=1), "doc_id", "component_id")]
    monkeypatch.setattr(near_dedup, "PART_ROWS", 4)
    got.append(rows_of(near_dedup.near_components(docs(spark, rows), k=2, bands=6, rows=1), "doc_id", "component_id"))
    assert got[0] == got[1] == want
    members = spark.range(3000).selectExpr("id div 1000 as bucket", "id as cid")
    shared = near_dedup._shared(members.where("bucket < 2 or cid = 2000"))
    open_ = shared.withColumn("comp", F.col("cid"))
    for width, n in ((1, 250), (4, 250), (64, 16), (4096, 1)):  # dealt by hash, about four members to a part, or as many as there are centres
        now = near_dedup._with_centres(open_, width)
        parts = now.groupBy("bucket", "parts", "part").count().collect()
        assert {(r["bucket"], r["parts"]) for r in parts} == {(0, n), (1, n)} and sum(r["count"] for r in parts) == 2000
        assert max(r["count"] for r in parts) <= 20 * max(1, 50 // n, width // 10)
        assert now.where("centre").select(near_dedup._every_part()).count() <= 2 * 2000
    assert {(r["bucket"], r["size"]) for r in shared.collect()} == {(0, 1000), (1, 1000)}


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(1)
    for size in (1, 30, 300, 5000):
        for share in (0.0, 0.5, 0.8, 0.95, 1.0):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
            b = np.unique(np.r_[a[:int(size * share)], rng.integers(0, 1 << 63, int(size * (1 - share)) + 1, dtype=np.uint64)])
            cells = sum(bin(int(x)).count("1") for x in (near_dedup.sketch(a) ^ near_dedup.sketch(b)).view(np.uint64))
            assert cells <= len(np.setxor1d(a, b))


def test_near_components_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, None), (2, ""), (3, " \t "), (4, "Hello"), (5, "hello"), (6, "hello there"), (7, long), (8, long + " end"), (None, long + " end end"), (4, "Hello")]
    got = near_dedup.near_components(docs(spark, rows), k=2).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {
        (1, 1, True), (2, 2, True), (3, 3, True), (4, 4, True), (5, 4, False), (6, 6, True), (7, 7, True), (8, 7, False), (None, 7, False)}
    assert len(got) == len(rows)
    out = near_dedup.drop_near_copies(docs(spark, rows), k=2)
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "3", "4", "4", "6", "7", "None"]
    assert near_dedup.near_components(docs(spark, [])).collect() == []
    only_null = near_dedup.near_components(docs(spark, [(None, "a b c"), (None, "a b c")]), k=2).collect()
    assert [(r["component_id"], r["kept"]) for r in only_null] == [(None, True)] * 2


def test_signatures_estimate_similarity():
    oph = near_dedup.OnePermutation()
    rng = np.random.default_rng(0)
    for size in (3, 40, 2000):
        a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        keep = max(1, int(size * 0.9))
        b = np.unique(np.r_[a[:keep], rng.integers(0, 1 << 63, size - keep, dtype=np.uint64)])
        a = np.unique(a)
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((oph.signature(a) == oph.signature(b)).mean() - true) < 0.17
