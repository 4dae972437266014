"""MinHash near-duplicate detection: one-permutation hashing with optimal
densification, banded buckets, star-shaped candidate edges.

* One hash per shingle gives both its bin and its value; a document's
  signature is the smallest value of each bin.  An empty bin copies a bin that
  a hash sequence of the bin's own number names, the first that is not empty,
  so bins stay independent draws.
* Bands of signature rows are bucket keys.  In a bucket every member is paired
  with a centre only, never all with all: pairs are linear in bucket size.
* Pairs are confirmed on the full shingle sets.  The centre is the member that
  shares most buckets with others, so nearly all links of a group are in
  its star.  A centre that is not similar to some members says nothing about
  those members among themselves, so rounds go on, each with more of the untried members of
  the buckets that still hold different components as centres, until no bucket holds a pair of
  different components that was not compared.
* After the first round a pair is only confirmed where two exact bounds let it reach the
  threshold: the ratio of the sizes, and the parities of the shingles per cell of a
  sketch, which differ in at most as many cells as the sets differ in shingles.
* A bucket's members meet its centres in parts, to each of which the centres are copied, so a
  bucket that many texts share is the work of many tasks.
* Documents with equal sets form one class before any of this; what crosses
  the network per copy is a key.

At similarity 0.8, a pair shares none of the 40 bands of 5 rows with
probability ``(1 - 0.8 ** 5) ** 40``, about one in eight million.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import forget, kept, map_arrow, saved, text_or_empty
from veilspark.llm.components import stars

BANDS, ROWS = 40, 5
GROWTH = 4  # times as many centres a bucket in each round as in the one before
SALTS = 63  # parts at most in which a bucket's members meet their number
PART_ROWS = 256  # members of a bucket's part, about, when they meet its centres; more where the centres are more
SKETCH_WORDS = 8  # 64-bit words of parities
CACHE_WORDS = 300_000  # word hashes that a task remembers

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)  # fixed values: a 64-bit mixing function
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: bytes, k: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``k``-word shingles of UTF-8 text
    with A-Z lower-cased; with fewer words the whole sequence is one shingle."""
    words = text.lower().split()  # of bytes: exactly the ASCII letters and white space
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    size = min(n, k)
    out = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        out = _mix(out * _GOLD + h[i:n - size + 1 + i])
    return np.unique(out)


class OnePermutation:
    """Signatures of ``bands * rows`` bins and their band keys."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, tries: int = 1024):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        cells = np.arange(self.bins * tries, dtype=np.uint64).reshape(self.bins, tries)
        self.probe = (_mix(cells + np.uint64(12345)) % np.uint64(self.bins)).astype(np.int64)
        self.band_seed = _mix(np.arange(1, bands + 1, dtype=np.uint64) * _GOLD)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        h = _mix(shingles ^ _GOLD)
        bins = ((h >> np.uint64(32)) * np.uint64(self.bins)) >> np.uint64(32)
        packed = np.sort((bins << np.uint64(48)) | (_mix(h) >> np.uint64(16)))
        bins = (packed >> np.uint64(48)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
        sig = np.zeros(self.bins, np.uint64)
        full = np.zeros(self.bins, bool)
        sig[bins[first]] = packed[first]
        full[bins[first]] = True
        empty = np.flatnonzero(~full)
        for lo, hi in ((0, 32), (32, self.probe.shape[1])):
            if not len(empty):
                break
            hit = full[self.probe[empty, lo:hi]]
            found = hit.any(1)
            at = hit.argmax(1)
            sig[empty[found]] = sig[self.probe[empty[found], lo + at[found]]]
            empty = empty[~found]
        if len(empty):  # a few bins after very many tries: the next full bin
            occupied = np.flatnonzero(full)
            sig[empty] = sig[occupied[np.searchsorted(occupied, empty) % len(occupied)]]
        return sig

    def band_keys(self, shingles: np.ndarray) -> np.ndarray:
        sig = self.signature(shingles).reshape(self.bands, self.rows)
        key = self.band_seed.copy()
        for r in range(self.rows):
            key = _mix(key * _GOLD + sig[:, r])
        return key.view(np.int64)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the numbers of shingles in ``64 * SKETCH_WORDS`` cells, as 64-bit words."""
    cells = (shingles % np.uint64(64 * SKETCH_WORDS)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * SKETCH_WORDS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


_SIGNATURES = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("set_key", T.BinaryType()),
    T.StructField("nameless", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
    T.StructField("sketch", T.ArrayType(T.LongType()))])
_SETS = T.StructType([T.StructField("cid", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else b""


def _nameless(shingles: np.ndarray) -> int:
    """Name of a class none of whose documents has an id."""
    return int.from_bytes(_set_key(shingles)[:8], "little", signed=True)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0] + [len(a) for a in arrays])
    flat = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat.view(np.int64), pa.int64()))


def _signatures(k: int, bands: int, rows: int):
    def run(batches):
        hashes, oph = _WordHashes(), OnePermutation(bands, rows)
        for b in batches:
            n, key, nameless, keys, sketches = [], [], [], [], []
            for t in b.column("body"):
                s = shingle_set(t.as_py(), k, hashes)
                n.append(len(s))
                key.append(_set_key(s))
                nameless.append(_nameless(s))
                keys.append(oph.band_keys(s) if len(s) else np.empty(0, np.int64))
                sketches.append(sketch(s))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(nameless, pa.int64()), _lists(keys), _lists(sketches)],
                ["id", "n", "set_key", "nameless", "keys", "sketch"])
    return run


def _sets(k: int):
    def run(batches):
        hashes = _WordHashes()
        for b in batches:
            sets, ids, size = [], [], 0
            for i, (cid, t) in enumerate(zip(b.column("id").to_pylist(), b.column("body"))):
                sets.append(shingle_set(t.as_py(), k, hashes))
                ids.append(_nameless(sets[-1]) if cid is None else cid)
                size += len(sets[-1])
                if size > 1 << 20 or i + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _lists(sets)], ["cid", "shingles"])
                    sets, ids, size = [], [], 0
    return run


def _shared(members: DataFrame) -> DataFrame:
    """``bucket, cid, weight, size`` of the buckets with several members.  The weight of a
    member is the sum of its buckets' sizes: the more texts are like it, the larger.  A bucket's
    members are counted, and meet their count, in up to ``SALTS`` parts, of which a word of bits says which
    there are."""
    dealt = members.withColumn("salt", F.pmod(F.xxhash64("cid", F.lit(3)), F.lit(SALTS)).cast("int"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("salt"))
    sizes = dealt.groupBy("bucket").agg(F.count("*").alias("size"), F.bit_or(bit).alias("salts")).where("size > 1")
    there = F.filter(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda i: F.getbit("salts", i) == 1)
    m = kept(dealt.join(sizes.select("bucket", "size", F.explode(there).alias("salt")), ["bucket", "salt"]).drop("salt"))
    weight = m.groupBy("cid").agg(F.sum("size").alias("weight"))
    return m.join(weight, "cid").select("bucket", "cid", "weight", "size")


def _parts(width: int) -> Column:
    """How many parts a bucket has in a round of ``width`` centres.  Parts grow with the centres,
    so that a bucket's centres are copied into about as many rows as it has members at most."""
    return F.ceil(F.col("size") / max(PART_ROWS, width)).cast("int")


def _part() -> Column:
    """The part of its bucket that a member is in."""
    return F.pmod(F.xxhash64("cid", F.lit(2)), F.col("parts")).cast("int")


def _every_part() -> Column:
    """A copy of a row of a bucket for each of its parts."""
    return F.explode(F.sequence(F.lit(0), F.col("parts") - 1))


def _with_centres(members: DataFrame, width: int) -> DataFrame:
    """The rows of ``members(bucket, cid, weight, size, comp)`` whose bucket holds several
    components, with their ``part`` of its ``parts``, and whether they are its ``centre``: the heaviest member, and about ``width - 1``
    others.  The order is the same in all buckets, so the buckets of a group agree on its
    centres and k documents give about k pairs for each; and the heaviest is the text
    that most others are like, so one star links most of them."""
    best = F.max(F.struct("weight", F.xxhash64("cid").alias("h"), "cid")).alias("best")
    members = members.withColumn("parts", _parts(width))
    b = (members.groupBy("bucket").agg(best, F.min("comp").alias("a"), F.max("comp").alias("b"), F.count("*").alias("rows"), F.max("parts").alias("parts"))
         .where("a <> b").select("bucket", F.col("best.cid").alias("best"), "rows", _every_part().alias("part")))
    place = F.pmod(F.xxhash64("cid", F.lit(1)), F.lit(1 << 30)) / float(1 << 30)
    centre = (F.col("cid") == F.col("best")) | (place * F.col("rows") < width - 1)
    return members.withColumn("part", _part()).join(b, ["bucket", "part"]).withColumn("centre", centre).drop("best", "rows")


def _may_reach(percent: int) -> Column:
    """Whether two sets of ``n, n_centre`` shingles can have ``100 * common >= percent * union``, by exact
    bounds: ``common`` is at most the smaller size, and sketches differ in at most
    ``n + n_centre - 2 * common`` cells."""
    cells = sum((F.bit_count(F.col("sketch")[i].bitwiseXOR(F.col("sketch_centre")[i])) for i in range(SKETCH_WORDS)), F.lit(0))
    sizes = F.least("n", "n_centre") * 100 >= F.greatest("n", "n_centre") * percent
    return sizes & (cells * (100 + percent) <= (F.col("n") + F.col("n_centre")) * (100 - percent))


def _confirmed(pairs: DataFrame, sizes: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets have ``100 * common >= percent * union``.  Without ``sizes`` they fit by size."""
    def side(name, df, cols):
        return df.select(F.col("cid").alias(name), *[F.col(c).alias(c + "_" + name) for c in cols])

    fit = pairs
    if sizes is not None:  # sets of too different sizes can't reach it
        fit = (pairs.join(side("u", sizes, ["n"]), "u").join(side("v", sizes, ["n"]), "v")
               .where(F.least("n_u", "n_v") * 100 >= F.greatest("n_u", "n_v") * percent).select("u", "v"))
    common = F.size(F.array_intersect("shingles_u", "shingles_v"))
    j = fit.join(side("u", sets, ["shingles"]), "u").join(side("v", sets, ["shingles"]), "v").withColumn("common", common)
    union = F.size("shingles_u") + F.size("shingles_v") - F.col("common")
    return j.where(F.col("common") * 100 >= union * percent).select("u", "v")


def near_components(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Documents whose sets of ``k``-word shingles have ``100 * common >= percent
    * union`` are linked; ``component_id`` is the smallest id reachable over
    links, ``kept`` is ``doc_id = component_id``.  A null or blank text has no
    shingles and links with nothing: its component is its own id.  Rows that
    repeat an id count as one document.  A row with a null id can connect
    others; its ``component_id`` is the smallest id of its component (null
    if none has an id), and it is kept only if none has.  Extra columns are ignored.
    """
    body = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().cast("binary").alias("body"))
    sig = kept(map_arrow(body, _signatures(k, bands, rows), _SIGNATURES))
    some = sig.where("n > 0").withColumn("cid", F.coalesce("id", "nameless"))
    # classes of equal sets, named by their smallest id
    classes = kept(some.groupBy("set_key").agg(F.min("id").alias("low"), F.max("n").alias("n"), F.max("nameless").alias("nameless"),
                                                   F.first("sketch").alias("sketch"))
                    .select("set_key", F.coalesce("low", "nameless").alias("cid"), "low", "n", "sketch"))
    named = some.join(classes.select("cid", "set_key"), ["cid", "set_key"], "left_semi").select("cid", F.explode("keys").alias("bucket"))
    # only buckets with several members matter from here on
    members = saved(_shared(named), "buckets")
    sets = _candidate_sets(body, members, k)
    star, compared, now, found, width = None, None, None, [], 1
    while True:
        last, now = now, saved(_with_centres(_with_components(members, "cid", "comp", star), width), "open")
        forget(last)
        if now.isEmpty():
            break
        bounded = "sketch" in now.columns
        centres = now.where("centre").select("bucket", _every_part().alias("part"), F.col("cid").alias("v"), F.col("comp").alias("comp_v"),
                                             *[F.col(c).alias(c + "_centre") for c in ("n", "sketch") if c in now.columns])
        met = now.join(centres, ["bucket", "part"]).where("comp <> comp_v")
        if bounded:
            met = met.where(_may_reach(percent))
        pairs = met.select(F.greatest("cid", "v").alias("u"), F.least("cid", "v").alias("v")).distinct()
        if compared is not None:
            pairs = pairs.join(compared, ["u", "v"], "left_anti")
        pairs = saved(pairs, "pairs")
        if not pairs.isEmpty():
            links = saved(_confirmed(pairs, None if bounded else classes.select("cid", "n"), sets, percent), "links")
            if not links.isEmpty():
                # a link between two components makes them one
                old, star = star, stars(links if star is None else links.unionByName(star))
                forget(old)
            forget(links)
            compared = pairs if compared is None else compared.unionByName(pairs)
        found.append(pairs)
        # a centre has now been compared with every other component of its bucket; components only
        # grow, so a bucket that holds one is done
        members = now.where("not centre").drop("centre", "comp", "part", "parts")
        if not bounded:
            members = members.join(classes.select("cid", "n", "sketch"), "cid")
        width *= GROWTH
    forget(now, *found)
    c = _with_components(classes.select("set_key", "cid", "low"), "cid", "comp", star)
    c = kept(c.join(c.groupBy("comp").agg(F.min("low").alias("component")), "comp").select("set_key", "component"))
    comp = F.coalesce("component", "id")
    return sig.select("id", "n", "set_key").join(c, "set_key", "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), comp.alias("component_id"),
        F.coalesce(F.col("id") == comp, comp.isNull()).alias("kept"))


def _with_components(df: DataFrame, node: str, name: str, star: DataFrame | None) -> DataFrame:
    if star is None:
        return df.withColumn(name, F.col(node))
    roots = star.select(F.col("u").alias(node), F.col("v").alias("__root"))
    return df.join(roots, node, "left").withColumn(name, F.coalesce("__root", node)).drop("__root")


def _candidate_sets(body: DataFrame, members: DataFrame, k: int) -> DataFrame:
    """The full shingle sets of the classes that share a bucket."""
    ids = members.select("cid").distinct()
    with_id = map_arrow(body.join(ids.withColumnRenamed("cid", "id").hint("merge"), "id", "left_semi"), _sets(k), _SETS)
    without = map_arrow(body.where("id is null"), _sets(k), _SETS).join(ids, "cid", "left_semi").dropDuplicates(["cid"])
    # dealt by id once: every round's joins then move pairs, not sets
    parts = int(body.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return kept(with_id.unionByName(without).repartition(parts, "cid"))


def drop_near_copies(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The rows of ``docs`` that :func:`near_components` keeps, one per
    component, with all columns; ids are taken to be unique, rows without an id stay."""
    dropped = near_components(docs, k, percent, bands, rows).where("not kept and doc_id is not null")
    return docs.join(dropped.select("doc_id"), "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
