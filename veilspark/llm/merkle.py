"""Merkle manifest of a table, with inclusion proofs by pointer jumping.

Rows are leaves; per part (language) they are numbered in id order and every
``FANOUT`` consecutive nodes become one, up to the part's subroot; the subroots
likewise become the root.

Proofs: a node points at its parent and holds one segment, the siblings that
are hashed with it.  A self-join along the pointers joins a node's segment to
that of the node it points at and moves its pointer to where that one's points, so the
distance to the ancestor doubles and the segments grow, until every pointer has reached the root.
The leaves of one run point at the same parent, so they jump together, as one row.

Digests are lowercase hex; ``H(x, y, ..)`` is sha256 of the inputs written one after the other.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import saved

FANOUT = 8
LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
PART_ROWS = 200_000  # rows sorted together when leaves are numbered
BLOCK = 4_096        # nodes that share every ancestor from the fourth level above on: FANOUT ** 4
ALL_SHARE = 4        # that distance
TOP = ""             # the tree of the subroots; names of parts start with 0 or 1

SEGMENT = "array<struct<l:string,r:string>>"


def _field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    """H of a row's values: ``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    return F.sha2(F.concat(*[_field(v) for v in values]).cast("binary"), 256)


def part_key(part: Column) -> Column:
    """A name for a part that sorts as the parts do: null first, then bytewise."""
    text = part.cast("string")
    return F.when(text.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` plus ``at``, the place (from 0) in its group by ``order``, and ``n``, the group's size.

    Rows are dealt by ranges of (group, order) and written in that order with
    their place in the range; a group's offsets per range (a row for each) are
    added.  So a group of any size is spread over many tasks.  ``order`` should part all rows."""
    spark = rows.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-rows.count() // PART_ROWS))
    t = saved(rows.repartitionByRange(ranges, *group, *order).sortWithinPartitions(*group, *order)
              .withColumn("__row", F.monotonically_increasing_id()), "merkle-order")
    t = t.withColumn("__range", F.shiftright("__row", 33))
    blocks = t.groupBy(*group, "__range").agg(F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    whole = W.partitionBy(*group)
    before = F.sum("__n").over(whole.orderBy("__range").rowsBetween(W.unboundedPreceding, -1))
    blocks = saved(blocks.select(*group, "__range", "__first", F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(whole).alias("n")), "merkle-offsets")
    return t.join(blocks, [*group, "__range"]).select(
        *rows.columns, (F.col("__before") + F.col("__row") - F.col("__first")).alias("at"), "n")


def _runs(nodes: DataFrame, *carry: str) -> DataFrame:
    """Consecutive nodes of a tree together: ``tree, up, n, kids``."""
    kid = F.struct("at", "hash", *carry)
    return nodes.groupBy("tree", F.expr(f"at div {FANOUT}").alias("up")).agg(
        F.first("n").alias("n"), F.sort_array(F.collect_list(kid)).alias("kids"))


def _parents(runs: DataFrame) -> DataFrame:
    return runs.select("tree", F.col("up").alias("at"), F.ceil(F.col("n") / FANOUT).alias("n"),
                       F.sha2(F.array_join(F.col("kids.hash"), "").cast("binary"), 256).alias("hash"))


def _siblings(runs: DataFrame, *cols) -> DataFrame:
    """A row per node of the runs, with ``l`` and ``r``: the digests before and after it."""
    each = runs.select("*", F.posexplode("kids").alias("__i", "kid"))
    hashes = F.col("kids.hash")
    return each.select(*cols, F.array_join(F.slice(hashes, F.lit(1), F.col("__i")), "").alias("l"),
                       F.array_join(F.slice(hashes, F.col("__i") + 2, F.lit(FANOUT)), "").alias("r"))


@dataclass
class Manifest:
    """``leaf_runs``: ``tree, up, n, kids``; ``nodes``: every other node with its
    pointer (``pt, pl, pa``), segment and, at a part's top, the subroot;
    ``root``: the digest, None for an empty table; ``depth``: the longest way from a leaf to the root."""

    leaf_runs: DataFrame
    nodes: DataFrame
    root: str | None
    root_key: tuple
    depth: int


def _pointer(tree: Column, level: Column, at: Column, own: tuple[Column, Column, Column], root: tuple) -> list[Column]:
    """A pointer; one that has reached the root becomes a key of the node's own that no node has."""
    there = (tree == root[0]) & (level == root[1]) & (at == root[2])
    return _moved(there, tree, level, at, own)


def _moved(there: Column, tree: Column, level: Column, at: Column, own) -> list[Column]:
    return [F.when(there, own[0]).otherwise(tree).alias("pt"), F.when(there, -1 - own[1]).otherwise(level).cast("int").alias("pl"),
            F.when(there, own[2]).otherwise(at).alias("pa")]


def build(docs: DataFrame, columns: tuple[str, ...] = LEAF_COLUMNS, part: str = "lang", key: str = "doc_id",
          replaced: dict[str, Column] | None = None, where: Column | None = None) -> Manifest:
    """The manifest of ``docs`` over ``columns``.

    ``replaced`` gives other values of some columns in the rows that meet ``where``: the digest
    of such a tampered row is kept beside the leaf, for a later check.  Texts are read once and
    not shuffled, only digests are.  Leaves of one key (null keys come first) are ordered by digest; rows equal in
    all columns have equal leaves, so their order is immaterial."""
    values = [F.col(f"`{c}`") for c in columns]
    told = F.lit(None).cast("string")
    if replaced:
        told = F.when(where if where is not None else F.lit(True), leaf_digest([replaced.get(c, F.col(f"`{c}`")) for c in columns]))
    leaves = saved(docs.select(part_key(F.col(f"`{part}`")).alias("tree"), F.col(f"`{key}`").alias("doc_id"), leaf_digest(values).alias("hash"),
                               told.alias("told"), F.monotonically_increasing_id().alias("__tie")), "merkle-leaves")
    nodes = numbered(leaves, ["tree"], ["doc_id", "hash", "__tie"])
    runs = leaf_runs = saved(_runs(nodes, "doc_id", "told"), "merkle-runs")
    most = leaf_runs.agg(F.max("n")).first()[0]
    if most is None:
        return Manifest(leaf_runs, docs.sparkSession.createDataFrame([], "kt string, kl int, ka long"), None, (), 0)

    level, inner, tops = 0, [], []  # runs of inner nodes by their level; subroots by theirs
    lone = F.col("n") == 1
    tops.append(leaf_runs.where(lone).select("tree", F.lit(0).alias("level"), F.col("kids")[0]["hash"].alias("hash")))
    while most > 1:
        level, most = level + 1, -(-most // FANOUT)
        up = _parents(runs.where(~lone))
        tops.append(up.where(lone).select("tree", F.lit(level).alias("level"), "hash"))
        runs = _runs(up.where(~lone))
        if most > 1:
            runs = saved(runs, "merkle-runs")
            inner.append((level, runs))
    parts = tops[0]
    for t in tops[1:]:
        parts = parts.unionByName(t)
    subroots = numbered(saved(parts, "merkle-subroots"), [], ["tree"])
    count, deep = subroots.agg(F.max("n"), F.max("level")).first()

    # the tree of subroots; its first nodes keep the names they have in their own trees
    named = subroots.select(F.lit(TOP).alias("tree"), "at", "n", "hash", F.struct("tree", F.col("level").cast("int").alias("level"), F.lit(0).cast("long").alias("at")).alias("key"))
    top_runs, high = [], 0
    while count > 1:
        runs = saved(_runs(named, "key"), "merkle-top")
        top_runs.append(runs)
        high, count = high + 1, -(-count // FANOUT)
        named = _parents(runs).withColumn("key", F.struct(F.lit(TOP).alias("tree"), F.lit(high).alias("level"), F.col("at")))
    r = named.select("hash", "key").first()
    root = (r["key"]["tree"], r["key"]["level"], r["key"]["at"])

    def linked(runs: DataFrame, own: tuple[Column, Column, Column], level: int, sub: Column) -> DataFrame:
        own = tuple(c.cast(t) for c, t in zip(own, ("string", "int", "long")))
        parent = (F.col("tree"), F.lit(level + 1), F.col("up"))
        n = _siblings(runs, own[0].alias("kt"), own[1].alias("kl"), own[2].alias("ka"), *_pointer(*parent, own, root), sub.alias("sub"))
        return n.withColumn("seg", F.array(F.struct("l", "r"))).drop("l", "r")

    key = F.col("kid.key")
    tables = [linked(t, (F.col("tree"), F.lit(lv), F.col("kid.at")), lv, F.lit(None).cast("string")) for lv, t in inner]
    tables += [linked(t, (key["tree"], key["level"], key["at"]), lv, F.col("kid.hash") if lv == 0 else F.lit(None).cast("string"))
               for lv, t in enumerate(top_runs)]
    if tables:
        links = tables[0]
        for t in tables[1:]:
            links = links.unionByName(t)
        links = saved(links, "merkle-nodes")
    else:  # every leaf's parent, or the one leaf itself, is the root
        links = docs.sparkSession.createDataFrame([], f"kt string, kl int, ka long, pt string, pl int, pa long, sub string, seg {SEGMENT}")
    # the only leaf of a part is its own subroot: a way as long as that from a run's parent
    return Manifest(leaf_runs, links, r["hash"], root, max(deep, 1) + high)


def jump(rows: DataFrame, nodes: DataFrame, distance: int, block: int) -> DataFrame:
    """``rows`` after one step along their pointers, which are ``distance`` levels long: pointers as far again, segments joined.

    Beyond the distance at which ``block`` neighbours surely share their ancestor, that ancestor's row goes once to every block
    and the rows meet it by block: however many rows point at one node, no key holds more than a block of them."""
    there = nodes.select(F.col("kt").alias("pt"), F.col("kl").alias("pl"), F.col("ka").alias("pa"), F.col("pt").alias("nt"), F.col("pl").alias("nl"),
                         F.col("pa").alias("na"), F.col("seg").alias("more"), F.col("sub").alias("later"))
    if distance > ALL_SHARE:
        here = ["kt", "kl", "__block"]
        rows = rows.withColumn("__block", F.expr(f"ka div {block}"))
        asked = rows.where("pl >= 0").select(*here, "pt", "pl", "pa").distinct()
        there = asked.join(there, ["pt", "pl", "pa"]).drop("pt", "pl", "pa")
        met = rows.join(there, here, "left").drop("__block")
    else:
        met = rows.join(there, ["pt", "pl", "pa"], "left")
    own = (F.col("kt"), F.col("kl"), F.col("ka"))
    found = F.col("nl").isNotNull()
    moved = _moved(F.col("nl") < 0, F.col("nt"), F.col("nl"), F.col("na"), own)
    pointer = [F.when(found, p).otherwise(F.col(name)).alias(name) for name, p in zip(("pt", "pl", "pa"), moved)]
    rest = [c for c in rows.columns if c not in ("pt", "pl", "pa", "seg", "sub", "__block")]
    return met.select(*rest, *pointer, F.concat("seg", F.coalesce("more", F.array().cast(SEGMENT))).alias("seg"), F.coalesce("sub", "later").alias("sub"))


def proofs(m: Manifest) -> DataFrame:
    """A row per leaf: ``doc_id, leaf, told`` (the tampered digest, null without), ``subroot, root`` and ``path``: the
    segments (digests ``l`` before and ``r`` after) from the leaf's own run up to the root."""
    runs = m.leaf_runs
    lone = F.col("n") == 1
    own = (F.col("tree"), F.lit(0), F.col("up"))
    parent = (F.col("tree"), F.when(lone, F.lit(0)).otherwise(F.lit(1)), F.col("up"))
    empty = F.array().cast(SEGMENT)
    if m.root is None:
        rows = runs.select("kids", "n", empty.alias("seg"), F.lit(None).cast("string").alias("sub"))
    else:
        rows = runs.select("kids", "n", F.col("tree").alias("kt"), F.lit(0).alias("kl"), F.col("up").alias("ka"),
                           *_pointer(*parent, own, m.root_key), empty.alias("seg"), F.lit(None).cast("string").alias("sub"))
        nodes, distance = m.nodes, 1
        while distance < m.depth:  # the runs' pointers are one level from their leaves, then 2, 4, ..
            rows = jump(rows, nodes, distance, BLOCK // FANOUT)
            if 2 * distance < m.depth:
                nodes = saved(jump(nodes, nodes, distance, BLOCK), "merkle-jump")
            distance *= 2
    leaf = _siblings(rows, "kid", "seg", "sub", "n").withColumn("own", F.when(~lone, F.struct("l", "r")))
    path = F.concat(F.when(lone, empty).otherwise(F.array("own")), F.col("seg"))
    root = F.lit(m.root).cast("string")
    return leaf.select(F.col("kid.doc_id").alias("doc_id"), F.col("kid.hash").alias("leaf"), F.col("kid.told").alias("told"),
                       F.coalesce("sub", root).alias("subroot"), root.alias("root"), path.alias("path"))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof path lead to."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["l"], h, s["r"]).cast("binary"), 256))


def check_leaves(docs: DataFrame, replaced: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """Per row of ``docs``: ``doc_id, leaf, subroot, root, proof_sha256`` (H of the siblings, level by level), ``folded_root``
    (from the tampered leaf where there is one, with the original siblings) and ``verified``.

    Null values are written as ``-``; a null language is a part of its own, the first.  Repeated rows have a leaf each.
    An empty table has no rows and no root; of a single row, leaf, subroot and root are the same and the proof is H of nothing.
    Extra columns are ignored."""
    p = proofs(build(docs, replaced=replaced, where=where))
    p = p.withColumn("folded_root", folded(F.coalesce("told", "leaf"), F.col("path")))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["l"], s["r"])), "")
    return p.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings.cast("binary"), 256).alias("proof_sha256"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))
