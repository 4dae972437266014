import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash

from tests.llm.helpers import docs, documents, rows_of
from veilspark.llm import boosting, lattice, permutation_index, quality, toxicity
from veilspark.llm.common import table

SF = "/root/testdata/sf0.01"
VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def test_trees_and_calibration():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(3000) < 0.05)).astype(float)
    trees = boosting.BoostedTrees().fit(x[:2000], y[:2000])
    m = trees.margin(x[2000:])
    assert ((m > 0) == y[2000:]).mean() > 0.88
    iso = boosting.Isotonic().fit(m, y[2000:])
    s = iso.apply(np.sort(m))
    assert (np.diff(s) >= 0).all() and 0 < s.min() and s.max() < 1
    assert boosting.Isotonic().fit(np.array([1.0, 1.0]), np.array([0.0, 1.0])).apply(np.array([1.0]))[0] == pytest.approx(0.5)
    none = boosting.BoostedTrees().fit(np.zeros((0, 2)), np.zeros(0))
    assert none.margin(np.zeros((3, 2))).shape == (3,)


def segmentations(text, pieces):
    if not text:
        yield []
    for p in pieces:
        if text.startswith(p):
            for rest in segmentations(text[len(p):], pieces):
                yield [p, *rest]


def test_lattice_sums_all_segmentations():
    rng = random.Random(2)
    pieces = ["▁", "a", "b", "▁a", "ab", "ba", "aab", "bb"] + [f"<0x{i:02X}>" for i in range(256)]
    logp = np.log(np.array([rng.random() for _ in pieces]) / len(pieces))
    at = {p: i for i, p in enumerate(pieces)}
    lat = lattice.Lattice(pieces, logp)
    for n in range(6):
        for w in map("".join, product("ab", repeat=n)):
            ways = [(seg, math.exp(sum(logp[at[p]] for p in seg))) for seg in segmentations("▁" + w, pieces[:8])]
            assert lat.forward(w) == pytest.approx(math.log(sum(p for _, p in ways)))
            want = np.zeros(len(pieces))
            for seg, p in ways:
                for x in seg:
                    want[at[x]] += 3 * p / sum(p for _, p in ways)
            for expect in (lat.expect, lat._expect_long):
                got = [0.0] * len(pieces)
                expect(w, 3, got)
                assert got == pytest.approx(want)
    spelled = sum(logp[at[f"<0x{b:02X}>"]] for b in "é".encode())
    assert lat.forward("é") == pytest.approx(logp[0] + spelled)
    assert math.isfinite(lat.forward("ab" * 5000))


def test_lattice_counts_of_improbable_words():
    """Words whose probability leaves the range of floating-point numbers at the first step's weights."""
    pieces = lattice.read_vocabulary(VOCABULARY)
    logp = -np.log(np.arange(len(pieces)) + 2.7)
    lat = lattice.Lattice(pieces, logp - np.log(np.exp(logp).sum()))
    single = set(pieces)
    listed3 = next(c for c in map(chr, range(0x4E00, 0x9FFF)) if c in single)
    unlisted3 = next(c for c in map(chr, range(0x9FFF, 0x4E00, -1)) if c not in single)
    unlisted4 = next(c for c in map(chr, range(0x20000, 0x2A000)) if c not in single)
    for c in (listed3, unlisted3, unlisted4, listed3 + unlisted4, "a" + unlisted4, unlisted4 * 17 + "a" * 40):
        for n in (1, 10, 15, 16, 17, 18, 20, 21, 22, 23, 24, 30, 40, 60, 79):
            w = (c * n)[:max(n, 57 if len(c) > 2 else 0)]
            got, want = [0.0] * len(pieces), [0.0] * len(pieces)
            lat.expect(w, 7, got)
            lat._expect_long(w, 7, want)
            assert all(map(math.isfinite, got)) and got == pytest.approx(want, rel=1e-6)


def test_lattice_needs_no_logarithms_for_plain_words(monkeypatch):
    pieces = lattice.read_vocabulary(VOCABULARY)
    logp = -np.log(np.arange(len(pieces)) + 2.7)
    lat = lattice.Lattice(pieces, logp - np.log(np.exp(logp).sum()))
    unlisted4 = next(c for c in map(chr, range(0x20000, 0x2A000)) if c not in set(pieces))
    plain, long = ["", "the", "é", "a" + unlisted4, "segmentation" * 6], [unlisted4 * 60, "ab" * 300]
    want = [lattice._forward(lat.edges(w), len(w) + 1)[-1] for w in plain + long]
    assert [lat.forward(w) for w in plain + long] == pytest.approx(want, rel=1e-12)
    monkeypatch.setattr(lattice, "_forward", None)
    assert [lat.forward(w) for w in plain] == pytest.approx(want[:len(plain)], rel=1e-12)


def test_words_of_a_batch_match_the_split_of_bytes():
    rng = random.Random(5)
    texts = ["".join(rng.choices("aAzZéÉ\x00\x1c\x1f\x85\xa0 \t\n\x0b\x0c\r  ", k=rng.randrange(30))).encode() for _ in range(300)]
    texts += [b"", b" ", b"\xff\xc3 A\xff"]
    for some in (texts, texts[:0], [b"", b"\t"]):
        words, begin = lattice._words(pa.array([b"before", *some], pa.binary())[1:])
        want = [t.lower().split() for t in some]
        got = words.cast(pa.binary()).to_pylist()
        assert [got[i:j] for i, j in zip(begin[:-1], begin[1:])] == want
        assert lattice._hashes(words).tolist() == [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in got]
    table = pa.table({"chunk": [7] * 303, "body": pa.chunked_array([pa.array(texts[:100], pa.binary()), pa.array(texts[100:], pa.binary())])})
    distinct = {w for t in texts for w in t.lower().split()}
    assert sorted(lattice._chunk_words(table)["h"].to_pylist()) == sorted(xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in distinct)


def test_lm_scores_of_empty_texts(spark):
    rows = lattice.score_documents(docs(spark, [(1, None), (2, ""), (3, " \n")]), VOCABULARY).collect()
    assert sorted((r["doc_id"], r["n_tokens"], r["n_known"]) for r in rows) == [(1, 1, 1), (2, 1, 1), (3, 1, 1)]


def test_lm_scores(spark):
    t = documents(SF)
    rows = list(zip(t.doc_id.tolist(), t.text)) + [(None, "the zzzzqq"), (5000, None), (5001, ""), (5002, "x" * 20_000), (0, t.text[0])]
    got = lattice.score_documents(docs(spark, rows), VOCABULARY, chunk_bytes=1 << 18)
    counts = Counter()
    tokens = [(i, (x or "").encode().lower().split() + [None]) for i, x in rows]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    for i, w in tokens:
        if not held(i):
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    want = sorted(((i, held(i), len(w), sum(counts[x] > 0 for x in w), n) for i, w in tokens), key=repr)
    assert rows_of(got, "doc_id", "held_out", "n_tokens", "n_known", "train_tokens") == want
    base = {(i, len(w)): sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w) for i, w in tokens}
    for r in got.collect():
        assert r["base_score"] == pytest.approx(base[(r["doc_id"], r["n_tokens"])])
        assert -1e6 < r["score"] < 0
    assert lattice.score_documents(docs(spark, []), VOCABULARY).collect() == []


def test_lm_training_raises_the_likelihood(spark):
    t = documents(SF)
    d = docs(spark, list(zip(t.doc_id.tolist(), t.text)))
    sums = []
    for steps in (0, 1, 2):
        rows = lattice.score_documents(d, VOCABULARY, steps=steps).where("held_out").collect()
        sums.append(sum(r["score"] for r in rows))
    assert sums[0] < sums[1] < sums[2]


def test_piece_probabilities_sum_to_one(spark):
    counts = spark.createDataFrame([(bytearray(b"the"), 5), (bytearray(b"of"), 2), (bytearray(b"held"), 0)], "word binary, n long")
    logp = lattice.train(counts, lattice.read_vocabulary(VOCABULARY), 3)
    assert np.exp(logp).sum() == pytest.approx(1.0)


def test_toxicity_held_out(spark):
    d, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.fit(d, labels)
    r = toxicity.score(d, model).join(labels, "doc_id").where("held_out").toPandas()
    hit = ((r.predicted == 1) & (r.toxic == 1)).sum()
    assert hit / r.toxic.sum() > 0.85 and hit / r.predicted.sum() > 0.95
    assert r.score.between(0, 1).all()


def test_toxicity_never_learns_from_held_out_rows(spark):
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(toxicity.id_bucket("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(d, labels), toxicity.fit(d, turned)
    assert a.terms == b.terms and toxicity.score(d, a).subtract(toxicity.score(d, b)).count() == 0


def plain_lexicon(rows, size):
    """Terms by their shrunk log odds, counted in plain Python over ``(label, text)``."""
    seen = {0: Counter(), 1: Counter()}
    for y, text in rows:
        t = {w.lower() for w in re.findall("[A-Za-z\x80-\xff]+", text.encode().decode("latin-1"))}
        seen[y].update(t | {w[:k] + "*" for w in t for k in (4, 5, 6) if len(w) >= k})
    n = Counter(y for y, _ in rows)
    low = {}
    for t, a in seen[1].items():
        b = seen[0][t]
        odds = math.log((a + 0.5) / (n[1] + 1)) - math.log((b + 0.5) / (n[0] + 1))
        low[t] = odds - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) if a >= 3 else 0.0
    return [t for t in sorted(low, key=lambda t: (-round(low[t], 9), t)) if low[t] > 1][:size]


def plain_features(text, terms):
    """The features written out over the text's bytes as single characters, with expressions only."""
    t = text.encode().decode("latin-1")
    alike = dict(zip("013457@$!|", "oieastasil"))
    listed = lambda w: w in terms or any(w[:k] + "*" in terms for k in (4, 5, 6))
    raw, words = re.findall(r"[^ \t-\r]+", t), [w.lower() for w in re.findall("[A-Za-z\x80-\xff]+", t)]
    n, size = max(1, len(raw)), max(1, len(t))
    second = {w.decode("latin-1") for w in toxicity.SECOND_PERSON}
    hits = [i for i, w in enumerate(words) if listed(w)]
    near = [i for i in hits if second & set(words[max(0, i - 5):i + 6])]
    hidden = 0
    for w in raw:
        core = w.strip("".join(c for c in map(chr, range(33, 127)) if not c.isalnum()))
        if re.search("[^A-Za-z\x80-\xff]", core):
            hidden += listed("".join(alike.get(c, c.lower() if c.isascii() else c) for c in core if c in alike or not re.match(r"[!-/:-@\[-`{-~]", c)))
    count = lambda kinds: len(re.findall(kinds, t))
    letters = count("[A-Za-z]") or 1
    shouted = sum(1 for w in raw if re.search("[A-Z]", w) and not re.search("[a-z]", w))
    return [len(hits) / n, math.log1p(len(hits)), hidden / n, len(near) / n, sum(w in second for w in words) / n, count("[A-Z]") / letters, shouted / n,
            count("!") / size, count(r"\?") / size, count(r"[!-/:-@\[-`{-~]") / size, count("[0-9]") / size, max(0, len(words) - len(raw)) / n,
            math.log1p(n), letters / n]


def test_toxicity_matches_brute_force(spark):
    """Lexicon from the fitting parts, features and scores against a plain recomputation; the trees and the calibration are given."""
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.fit(d, labels)
    parts = {r["__id"]: r["part"] for r in d.selectExpr("cast(doc_id as long) as __id", "cast(pmod(xxhash64(cast(doc_id as long), 1), 3) as int) as part").collect()}
    texts = {r["doc_id"]: r["text"] or "" for r in d.select("doc_id", "text").collect()}
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    learned = [i for i in toxic if i in texts and toxic[i] in (0, 1) and zlib.crc32(str(i).encode()) % 5 != 0]
    terms = plain_lexicon([(toxic[i], texts[i]) for i in learned if parts[i] != 0], toxicity.LEXICON_TERMS)
    assert len(terms) > 50 and sorted(t.decode("latin-1") for t in model.terms) == sorted(terms)
    odd = {-1: "", -2: "you IDIOT! i.d.i.o.t 1d10t?? Größe übel", -3: "A B-C $$$ d4mn\tx\x0by", -4: "!!! ... 123 @@"}
    for x, want in ((toxicity.features(t.encode(), toxicity.Lexicon(model.terms)), plain_features(t, set(terms))) for t in odd.values()):
        assert x == pytest.approx(want)
    some = [i for i in sorted(texts) if i % 7 == 0]
    x = np.array([plain_features(texts[i], set(terms)) for i in some])
    got = {r["doc_id"]: r["score"] for r in toxicity.score(d, model).collect()}
    assert [got[i] for i in some] == pytest.approx(list(model.score(x)), abs=1e-9)


def test_toxicity_calibration_part_is_not_in_the_lexicon(spark):
    """A word that marks the toxic rows of the calibrating third only is no term; with labels of one kind there it is."""
    part = {r["i"]: r["p"] for r in spark.range(400).selectExpr("id as i", "cast(pmod(xxhash64(id, 1), 3) as int) as p").collect()}
    text = {i: "quiet words " + ("grumble " if i % 2 else "") + ("zonk" if i % 2 and part[i] == 0 else "") for i in part}
    d = docs(spark, list(text.items()))
    labels = spark.createDataFrame([(i, 1, i % 2) for i in part], "doc_id long, quality int, toxic int")
    terms = toxicity.fit(d, labels).terms
    assert b"grumble" in terms and b"zonk" not in terms
    only = spark.createDataFrame([(i, 1, i % 2) for i in part if part[i] == 0], "doc_id long, quality int, toxic int")
    assert b"zonk" in toxicity.fit(d, only).terms


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rows = [(1, "you idiot"), (2, "fine"), (None, None), (4, ""), (4, ""), (5, "word " * 50_000)]
    got = toxicity.score(docs(spark, rows), toxicity.fit(docs(spark, rows), labels)).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    empty = toxicity.fit(docs(spark, []), labels)
    assert toxicity.score(docs(spark, []), empty).collect() == []
    assert len({r["score"] for r in toxicity.score(docs(spark, rows), empty).collect()}) == 1


def test_toxicity_features():
    lex = toxicity.Lexicon([b"idiot", b"lowei*"])
    f = dict(zip(toxicity.FEATURES, toxicity.features("You IDIOT! loweien 1d10t i.d.i.o.t".encode(), lex)))
    assert f["term density"] == pytest.approx(2 / 5) and f["hidden term density"] == pytest.approx(2 / 5), f
    assert f["terms near second person"] > 0 and f["exclamation rate"] > 0
    assert len(toxicity.features(b"", lex)) == len(toxicity.FEATURES)


def test_capital_words_count_in_every_text():
    """A shouted sentence within a longer text in small letters."""
    text = ("the quiet part of a text goes on and on " * 10 + "GO AWAY NOW " + "and goes on " * 10).encode()
    n = len(text.split())
    assert dict(zip(toxicity.FEATURES, toxicity.features(text, toxicity.Lexicon([]))))["capital word rate"] == pytest.approx(3 / n)
    assert dict(zip(quality.FEATURES, quality.features(text)))["capital word share"] == pytest.approx(3 / n)


def test_quality_held_out(spark):
    d, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    r = quality.classify(d, quality.fit(d, labels), ["doc_id"]).join(labels, "doc_id").toPandas()
    r = r[[zlib.crc32(str(i).encode()) % 5 == 0 for i in r.doc_id]]
    assert (r.accepted == (r.quality == 1)).mean() > 0.97


def test_site_posteriors_match_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for h in range(12):
        share = rng.random()
        for p in range(3):
            rows += [(f"h{h}" if h else None, f"p{p}" if p else None, min(max(rng.gauss(share, 0.1), 0.0), 1.0)) for _ in range(rng.randrange(1, 40))]
    sites, share = quality.site_posteriors(spark.createDataFrame(rows, "__host string, __path string, p double"))
    t = pd.DataFrame(rows, columns=["h", "p", "v"]).fillna("-")
    assert share == pytest.approx((t.v.sum() + 1) / (len(t) + 2))

    def moments(g, by):
        """Spread, noise, weight of the means of ``by`` around that of ``g``."""
        n, m = g.groupby(by).v.count(), g.v.mean()
        return (n * (g.groupby(by).v.mean() - m) ** 2).sum(), (len(n) - 1) * m * (1 - m), n.sum() - (n ** 2).sum() / n.sum()

    def prior(var, spread, noise, weight):
        return min(max(var * weight / (spread - noise) - 1, 1), 1e6) if spread > noise else 1e6
    m = t.v.mean()
    mh = prior(m * (1 - m), *moments(t, "h"))
    inside = [(g, moments(g, "p")) for _, g in t.groupby("h") if g.p.nunique() > 1]
    var = sum(len(g) * g.v.mean() * (1 - g.v.mean()) for g, _ in inside) / sum(len(g) for g, _ in inside)
    mp = prior(var, *(sum(x[i] for _, x in inside) for i in range(3)))
    got = {(r["__host"] or "-", r["__path"] or "-"): r for r in sites.collect()}
    host = {h: (g.v.sum() + mh * share) / (len(g) + mh) for h, g in t.groupby("h")}
    assert len(got) == t.groupby(["h", "p"]).ngroups
    for (h, p), g in t.groupby(["h", "p"]):
        r = got[(h, p)]
        assert (r["n"], r["s"], r["host_posterior"], r["strength"]) == pytest.approx((len(g), g.v.sum(), host[h], mp))


def test_path_prior_is_that_of_paths_within_a_host(spark):
    """Hosts far apart, their paths close to them (a Beta of strength 30 around the host's share): the estimate finds the latter."""
    rng = np.random.default_rng(6)
    rows = []
    for h in range(150):
        share = rng.beta(1.0, 1.0) * 0.9 + 0.05
        for p in range(12):
            q = rng.beta(30 * share, 30 * (1 - share))
            rows += [(f"h{h}", f"p{p}", float(v)) for v in rng.random(12) < q]
    sites, _ = quality.site_posteriors(spark.createDataFrame(pd.DataFrame(rows, columns=["__host", "__path", "p"])))
    assert 18 < sites.first()["strength"] < 50
    # a host of one path says nothing about paths; no documents at all, nothing
    alone, _ = quality.site_posteriors(spark.createDataFrame([("a", "p", 1.0), ("b", "p", 0.0), ("b", "p", 0.5)], "__host string, __path string, p double"))
    assert {r["strength"] for r in alone.collect()} == {quality.STRENGTH[1]}


def test_sparse_sites_shrink(spark):
    """One bad document alone on a site leaves its neighbour near the global share; many bad ones do not."""
    rows = [("small", "p", 0.1), ("small", "p", 0.9)] + [("bad", "p", 0.05)] * 300 + [(f"g{i}", "p", 0.95) for i in range(300) for _ in range(5)]
    sites, share = quality.site_posteriors(spark.createDataFrame(rows, "__host string, __path string, p double"))
    post = {r["__host"]: r["host_posterior"] for r in sites.collect()}
    assert post["bad"] < 0.1 and post["g0"] > share - 0.05 and 0.4 < post["small"] < share


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    rows = [(1, "fine text", None), (2, "| | |", "a"), (None, None, None), (4, "", "b"), (4, "", "b"), (5, "word " * 50_000, "a")]
    d = docs(spark, rows)
    model = quality.fit(d, labels)
    got = quality.classify(d, model, d.columns)
    assert got.count() == 6 and set(d.columns) - {"score"} < set(got.columns)
    kept = quality.keep_accepted(d, model)
    assert kept.columns == d.columns and kept.schema == d.schema
    assert quality.classify(docs(spark, []), model, ["doc_id"]).collect() == []
    assert quality.fit(docs(spark, []), labels) is not None


def brute_nearest(ids, x, q, k=10):
    d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
    d[ids == q] = np.inf
    o = np.lexsort((ids, d))[:k]
    return [(int(i), v) for i, v in zip(ids[o], d[o]) if np.isfinite(v)]


def test_nearest_recall(spark):
    v = table(spark, "/root/testdata/sf0.1", "embeddings")
    e = v.toPandas()
    ids, x = e.vec_id.values, np.vstack(e.embedding.values).astype(float)
    got = permutation_index.nearest(v, v.where("vec_id % 100 = 0"), block_rows=512, least=100, query_rows=7).toPandas()
    hits = total = 0
    for q, g in got.groupby("query_id"):
        g = g.sort_values("rank")
        want = brute_nearest(ids, x, q)
        assert list(g["rank"]) == list(range(1, 11)) and list(zip(g.score, g.vec_id)) == sorted(zip(g.score, g.vec_id))
        hits += len({i for i, _ in want} & set(g.vec_id))
        total += len(want)
    assert got.query_id.nunique() == (ids % 100 == 0).sum() and hits / total >= 0.9


def test_nearest_is_exact_where_all_are_compared(spark):
    v = table(spark, SF, "embeddings")
    e = v.toPandas()
    ids, x = e.vec_id.values, np.vstack(e.embedding.values).astype(float)
    got = permutation_index.nearest(v, v.where("vec_id % 100 = 0"), block_rows=100)
    want = [(int(q), r, i, d) for q in ids[ids % 100 == 0] for r, (i, d) in enumerate(brute_nearest(ids, x, q), 1)]
    rows = rows_of(got, "query_id", "rank", "vec_id", "score")
    assert [r[:3] for r in rows] == [r[:3] for r in sorted(want, key=repr)]
    assert [r[3] for r in rows] == pytest.approx([r[3] for r in sorted(want, key=repr)], abs=1e-15)


def test_nearest_odd_rows(spark):
    bad = [(1, None, 0), (2, [0.0, 0.0], 0), (3, [1.0, None], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0), (None, [1.0, 1.0], 0), (6, [], 0)]
    good = [(100 + i, [1.0, 2.0], 0) for i in range(15)] + [(200, [3.0, 1.0], 0), (200, [3.0, 1.0], 0)]
    schema = "vec_id long, embedding array<float>, v int"
    d = spark.createDataFrame(bad + good, schema)
    got = permutation_index.nearest(d, d.where("vec_id % 100 = 0"), block_rows=4).collect()
    ties = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 100]
    assert ties == list(range(101, 111))  # equal vectors: the smaller ids
    assert {r["query_id"] for r in got} == {100, 200}
    assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == 200] == list(range(100, 110))
    few = spark.createDataFrame(good[:3], schema)
    assert len(permutation_index.nearest(few, few.where("vec_id = 100")).collect()) == 2
    assert permutation_index.nearest(spark.createDataFrame([], schema), spark.createDataFrame([], schema)).collect() == []
    none = spark.createDataFrame(bad, schema)
    assert permutation_index.nearest(none, none).collect() == []
