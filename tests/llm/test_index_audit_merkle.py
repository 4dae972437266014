"""Positional index, filter audit and Merkle proofs against plain-Python versions."""

import hashlib
import random
import re
import zlib
from collections import defaultdict
from itertools import combinations, permutations

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import CLASH, docs, documents, rows_of
from veilspark.llm import filter_audit, merkle, positional_index
from veilspark.llm.common import id_bucket
from veilspark.llm.queries import op11_contamination

LOWER = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- positional index ---------------------------------------------------------
def item_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_contamination(rows, items, window=10):
    wins = defaultdict(set)
    for i, t in items:
        w = item_words(t)
        for s in range(max(1, len(w) - window + 1) if w else 0):
            wins[tuple(w[s:s + window])].add(i)
    out = []
    for i, t, *_ in rows:
        w, hit, found = item_words(t), set(), set()
        for n in {len(x) for x in wins}:
            for s in range(len(w) - n + 1):
                if (x := tuple(w[s:s + n])) in wins:
                    hit |= set(range(s, s + n))
                    found |= wins[x]
        found = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), len(found), found))
    return sorted(out, key=repr)


ITEMS = [(1, "One two three four five six seven eight nine ten eleven twelve"), (2, "short item"), (3, "lone"), (4, None), (5, " .,- "),
         (6, "a a a a a a a a a a a"), (7, "short item"), (None, "no name here at all"), (10, "ÉTÉ über straße"), (11, "absent words zzzq")]
TEXTS = [
    (1, "x one TWO three, four five-six seven eight nine ten y"), (2, "one two three four five six seven eight nine eleven"),
    (3, "a " * 30), (4, None), (5, ""), (6, "Short item and short\nitem; LONE"), (7, "no name here at all"), (8, "ÉTÉ über straße"), (9, "été über straße"),
    (10, "two three four five six seven eight nine ten eleven twelve " * 40), (10, "short item"), (10, "short item"), (None, "lone"), (None, "lone wolf"), (None, None),
    (11, "lone " * 50_000), (12, "x" * 200_000), (13, "absent words"), (14, "a" + "\x00" + "a short\x7fitem"),
]


def items_frame(spark, items):
    return spark.createDataFrame([(*i, *CLASH[:2]) for i in items], "item_id long, text string, item string, words string")


def test_contamination_matches_brute_force(spark):
    got = positional_index.contamination(docs(spark, TEXTS), items_frame(spark, ITEMS))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items") == brute_contamination(TEXTS, ITEMS)


@pytest.mark.parametrize("seed", [1, 2])
def test_contamination_of_dense_texts(spark, seed):
    """Few words, so that windows repeat, overlap and share their terms."""
    rng = random.Random(seed)
    say = lambda n: " ".join(rng.choice("abc") for _ in range(n))
    items = [(i, say(rng.choice([1, 2, 3, 5, 9, 14]))) for i in range(12)]
    rows = [(i, say(rng.randrange(0, 60))) for i in range(40)]
    got = positional_index.contamination(docs(spark, rows), items_frame(spark, items), window=6)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items") == brute_contamination(rows, items, 6)


def test_many_items_are_met_by_salted_joins(spark, monkeypatch):
    monkeypatch.setattr(positional_index, "BROADCAST_ROWS", 0)
    got = positional_index.contamination(docs(spark, TEXTS), items_frame(spark, ITEMS))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items") == brute_contamination(TEXTS, ITEMS)


def test_no_items_or_no_documents(spark):
    none = items_frame(spark, ITEMS).limit(0)
    got = positional_index.contamination(docs(spark, TEXTS), none)
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items") == brute_contamination(TEXTS, [])
    assert positional_index.contamination(docs(spark, TEXTS).limit(0), items_frame(spark, ITEMS)).collect() == []


def test_query_is_native(spark):
    plan = op11_contamination(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_whole_index_finds_phrases_and_words_nearby(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 50)))) for i in range(30)]
    index = positional_index.build_index(docs(spark, rows))
    assert index.postings.count() == sum(len(t.split()) for _, t in rows)
    wanted = [(0, ["a"]), (1, ["a", "b"]), (2, ["c", "c", "d"]), (3, ["a", "zz"]), (4, ["h", "g", "f"])]
    phrases = spark.createDataFrame(wanted, "phrase long, words array<string>")
    exact, near = [], []
    for p, w in wanted:
        for i, t in rows:
            x = t.split()
            exact += [(p, i, s) for s in range(len(x) - len(w) + 1) if x[s:s + len(w)] == w]
    assert rows_of(positional_index.phrase_matches(index, phrases), "phrase", "d1", "start") == sorted(exact, key=repr)
    rarest = {r["word"]: (r["n"], r["term"]) for r in index.terms.collect()}
    for p, w in wanted:
        if all(x in rarest for x in w):
            first = min(set(w), key=lambda x: (rarest[x][0], w.index(x)))
            for i, t in rows:
                x = t.split()
                near += [(p, i, s) for s, y in enumerate(x) if y == first and all(o in x[max(0, s - 3):s + 4] for o in w)]
    assert rows_of(positional_index.proximity_matches(index, phrases, 3), "phrase", "d1", "pos") == sorted(near, key=repr)


# -- filter audit -------------------------------------------------------------
def brute_masks(rows):
    out = []
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = ["A"] * (len(w) < 100) + ["B"] * (100 * len(set(w)) < 80 * len(w)) + ["C"] * (100 * len(re.findall("[A-Z]", t)) > 10 * len(t))
        fails += ["D"] * bool(re.search(r"[#$%&*|]", t))
        fails += ["E"] * (i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows))
        out.append((i, lang or "", set(fails)))
    return out


def brute_audit(rows, good, toxic):
    masks, out = brute_masks(rows), []
    for part in {p for _, p, _ in masks}:
        own = [(i, m) for i, p, m in masks if p == part]
        shapley, part_rows = defaultdict(int), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(i, m) for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                shapley[f] += len(gone)
                part_rows.append((f, (part, "".join(order), step, len(left), len(gone), sum(f in m for _, m in own) - len(gone), sum(m == {f} for _, m in own),
                                      sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone))))
        out += [(*r, shapley[f]) for f, r in part_rows]
    return sorted(out, key=repr)


COLUMNS = [c.split(" ")[0] for c in filter_audit.RESULT.split(", ")]


def audited(spark, rows, labels):
    frame = spark.createDataFrame([(i, t, lang, *CLASH) for i, t, lang in rows], "doc_id long, text string, lang string, mask string, n string, good string, id string, part string, digest string")
    marks = spark.createDataFrame([(*x, "y", "z") for x in labels], "doc_id long, quality int, toxic int, part string, good string")
    return rows_of(filter_audit.audit(frame, marks), *COLUMNS)


def test_audit_matches_brute_force(spark):
    rng = random.Random(5)
    base = [" ".join(rng.choice(["w%d", "W%d", "AB", "%d"]).replace("%d", str(rng.randrange(200))) for _ in range(rng.choice([0, 3, 90, 120, 300]))) + rng.choice(["", " #", " é*"]) for _ in range(25)]
    rows = [(i, rng.choice(base), rng.choice(["en", "de", None, ""])) for i in range(150)]
    rows += [(None, base[0], "en"), (None, base[0], "en"), (None, None, None), (7, rows[7][1], rows[7][2]), (7, rows[7][1], "en"), (7, "other text", "en"), (500, None, "fr"), (501, "", "fr"),
             (502, "Lang " * 40_000, "es"), (-3, base[1], "de"), (900, " \t\n", "de")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, 0), (None, 1, 1), (9999, 1, 1)]
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    assert audited(spark, rows, labels) == brute_audit(rows, good, toxic)


def test_audit_of_real_rows_and_empty_tables(spark):
    t = documents("/root/testdata/sf0.001")
    rows = list(zip(map(int, t.doc_id), t.text, t.lang))
    assert audited(spark, rows, [(-1, 0, 0)]) == brute_audit(rows, set(), set())
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(empty, marks).collect() == []


@pytest.mark.parametrize("filters", [1, 3, 5])
def test_gray_walk_states(filters):
    rng = random.Random(filters)
    found = {m: (rng.randrange(50), rng.randrange(9)) for m in rng.sample(range(1 << filters), (1 << filters) * 3 // 4)}
    for k in range(filters + 1):
        for subset in combinations(range(filters), k):
            bits = sum(1 << i for i in subset)
            want = tuple(sum(v[i] for m, v in found.items() if not m & bits) for i in (0, 1))
            assert filter_audit.gray_walk(found, filters)[bits] == want


# -- Merkle manifest ----------------------------------------------------------
def brute_merkle(rows, fanout):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(map(field, (r[0], r[2], r[3], r[4], text))))

    def climb(level, paths):
        """Digest of the top; adds to ``paths[i]`` the siblings of every level's node above or at ``i``."""
        under = [[i] for i in range(len(level))]
        while len(level) > 1:
            ups, unders = [], []
            for s in range(0, len(level), fanout):
                run = level[s:s + fanout]
                for k in range(len(run)):
                    for i in under[s + k]:
                        paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
                ups.append(sha("".join(run)))
                unders.append(sum(under[s:s + fanout], []))
            level, under = ups, unders
        return level[0]

    parts = defaultdict(list)
    for r in rows:
        parts[r[3]].append(r)
    subs, held = [], []
    for lang in sorted(parts, key=lambda x: (x is not None, (x or "").encode())):
        own = sorted(parts[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[1])))
        paths = [[] for _ in own]
        subs.append(climb([leaf(r, r[1]) for r in own], paths))
        held.append((own, paths))
    tops = [[] for _ in subs]
    root = climb(subs, tops)
    out = []
    for (own, paths), sub, top in zip(held, subs, tops):
        for r, path in zip(own, paths):
            path = path + top
            text = r[1]
            if zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            h = leaf(r, text)
            for a, b in path:
                h = sha(a + h + b)
            out.append((r[0], leaf(r, r[1]), sub, root, sha("".join(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def proved(spark, rows):
    frame = spark.createDataFrame([(*r, *CLASH) for r in rows], "doc_id long, text string, source string, lang string, n_chars long, leaf string, at string, n string, tree string, hash string, told string")
    lowered = F.translate("text", positional_index.CAPITALS, positional_index.SMALL)
    return rows_of(merkle.check_leaves(frame.repartition(5), {"text": lowered}, id_bucket("doc_id", 3) == 0), *PROOF)


ODD = [(None, None, None, None, None), (5, "Text É", "s", None, 3), (5, "Text É", "s", None, 3), (5, "Other", None, "é", -4), (-9, "", "", "", 0), (6, "X" * 300_000, "s", "zz", 2 ** 40), (None, "A", "s", "en", 1)]


@pytest.mark.parametrize("rows", [ODD, ODD[:1], ODD[1:3], [(i, f"T{i}", "s", "en", i) for i in range(9)], [(i, "T", None, f"l{i}", i) for i in range(20)]])
def test_proofs_of_small_tables(spark, rows):
    assert proved(spark, rows) == brute_merkle(rows, 8)


def test_proofs_along_long_pointers(spark, monkeypatch):
    """Nodes of two make deep trees, so that pointers of eight and more levels are met by block."""
    monkeypatch.setattr(merkle, "FANOUT", 2)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    monkeypatch.setattr(merkle, "PART_ROWS", 40)
    rows = [(i, f"Text {i}", "s", "en", i) for i in range(600)] + [(i, f"Text {i}", "s", None, i) for i in range(70)] + [(7, "Lone", "s", "de", 1)]
    rows += [(i, "T", "s", f"x{i}", i) for i in range(6)]
    assert proved(spark, rows) == brute_merkle(rows, 2)


def test_proofs_of_an_empty_table(spark):
    assert proved(spark, []) == []
