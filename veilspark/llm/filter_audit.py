"""Interaction audit of quality filters by a Gray-code walk over their subsets.

Every document becomes a mask, one bit per filter that it fails; per part only
the counts of the masks (the cells, at most 32 for five filters) are kept.  A walk
through all subsets of filters toggles one filter at a time: it maintains, per
cell, how many of the active filters the cell fails, and the running survivors, the
documents of cells that fail none.  The 32 states are stored; what a filter removes at
a step of any order is the difference of two of them.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.llm.common import SPACES, text_or_empty

LETTERS = "ABCDE"  # bit i of a mask stands for letter i
COPY = "E"         # the filter that needs the whole table
MEASURES = ("n", "good", "toxic")

RESULT = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions of the filters that a text decides by itself, by letter."""
    words = F.array_remove(F.split(text, SPACES), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]++", ""))
    return {"A": n < 100, "B": F.size(F.array_distinct(words)) * 100 < n * 80, "C": capitals * 100 > F.length(text) * 10,
            "D": text.rlike("[#$%&*|]")}


def mask_of(filters: dict[str, Column]) -> Column:
    return sum((F.when(c, 1 << LETTERS.index(k)).otherwise(0) for k, c in filters.items()), F.lit(0)).cast("int")


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: documents by language and failure mask, and how many of them are labelled good and toxic.

    Copies fail E: rows whose text a smaller id has as well, anywhere in the table (texts are compared by SHA-256).  All rows of
    a text share the other bits, so rows are counted per (text, part) before any text's rows meet: a text that a third of all rows
    have is a few rows per task by then.  Rows of the smallest id are held apart from the others, so that
    after the smallest id of a text over all parts is known, the counts are put together without a look at the rows.
    A null id is neither smaller than another nor has smaller ones.  A null text is empty, a null language is the part ``''``.
    A document is good or toxic if any of its label rows says so; null ids have no labels."""
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), mask_of(text_filters(text)).alias("mask"))
    ids = rows.groupBy("doc_id", "part", "digest", "mask").agg(F.count(F.lit(1)).alias("n"))  # repeated rows
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("is_good"), F.max((F.col("toxic") == 1).cast("int")).alias("is_toxic"))
    # null ids are spread by their text, as no label can meet them
    ids = ids.withColumn("apart", F.when(F.col("doc_id").isNull(), F.hex("digest")).otherwise("")).withColumn("id", F.coalesce("doc_id", F.lit(0)))
    marks = marks.select(F.lit("").alias("apart"), F.col("doc_id").alias("id"), "is_good", "is_toxic")
    one = F.struct("doc_id", "n", (F.col("n") * F.coalesce("is_good", F.lit(0))).alias("good"), (F.col("n") * F.coalesce("is_toxic", F.lit(0))).alias("toxic"))
    marked = ids.join(marks, ["apart", "id"], "left").select("part", "digest", "mask", one.alias("one"))
    total = [F.sum(f"one.{m}").alias(m) for m in MEASURES]
    # of ids that are not null, the smallest with its counts; counts of null ids, which are never copies
    least = F.min(F.when(F.col("one.doc_id").isNotNull(), F.col("one"))).alias("least")
    unnamed = [F.sum(F.when(F.col("one.doc_id").isNull(), F.col(f"one.{m}")).otherwise(0)).alias(f"free_{m}") for m in MEASURES]
    per_text = marked.groupBy("digest", "part", "mask").agg(*total, least, *unnamed)
    # a row per language and text from here on
    first = per_text.groupBy("digest").agg(F.min("least.doc_id").alias("first_id"))
    known = per_text.join(first, "digest")
    here = F.col("least.doc_id") == F.col("first_id")
    fresh = [(F.when(here, F.col(f"least.{m}")).otherwise(0) + F.col(f"free_{m}")).alias(f"fresh_{m}") for m in MEASURES]
    known = known.select("part", "mask", *MEASURES, *fresh)
    sums = known.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES], *[F.sum(f"fresh_{m}").alias(f"fresh_{m}") for m in MEASURES])
    copy = 1 << LETTERS.index(COPY)
    both = F.array(F.struct(F.col("mask").alias("mask"), *[F.col(f"fresh_{m}").alias(m) for m in MEASURES]),
                   F.struct((F.col("mask") + copy).alias("mask"), *[(F.col(m) - F.col(f"fresh_{m}")).alias(m) for m in MEASURES]))
    return sums.select("part", F.explode(both).alias("c")).select("part", "c.*")


def gray_walk(found: dict[int, tuple], filters: int) -> list[tuple]:
    """Survivors (sums of the cells' values) for every subset of ``filters`` filters, by its bits.

    ``found``: mask -> values.  Each step toggles the one filter in which consecutive
    Gray codes differ; only cells that fail it change their counter of active failures, and
    those that come to or leave 0 change the survivors."""
    active = dict.fromkeys(found, 0)
    width = len(next(iter(found.values()), ()))
    now = [sum(v[i] for v in found.values()) for i in range(width)]
    states: list[tuple] = [()] * (1 << filters)
    states[0], code = tuple(now), 0
    for step in range(1, 1 << filters):
        bit = step & -step
        code ^= bit
        on = 1 if code & bit else -1
        for mask, values in found.items():
            if mask & bit:
                was = active[mask]
                active[mask] = was + on
                if was == 0 or active[mask] == 0:
                    for i, v in enumerate(values):
                        now[i] -= on * v
        states[code] = tuple(now)
    return states


def audit_rows(part: str, found: dict[int, tuple], letters: str = LETTERS) -> list[tuple]:
    """The rows of one part: every order of the filters, every step."""
    bits = {c: 1 << i for i, c in enumerate(letters)}
    states = gray_walk(found, len(letters))
    fails = {c: sum(v[0] for m, v in found.items() if m & b) for c, b in bits.items()}
    alone = {c: found.get(b, (0,))[0] for c, b in bits.items()}
    rows, shapley = [], dict.fromkeys(letters, 0)
    for order in permutations(letters):
        done = 0
        for step, c in enumerate(order, 1):
            before, after = states[done], states[done | bits[c]]
            done |= bits[c]
            gone = before[0] - after[0]
            shapley[c] += gone
            rows.append((part, "".join(order), step, after[0], gone, fails[c] - gone, alone[c], before[1] - after[1], before[2] - after[2], c))
    return [(*r[:-1], shapley[r[-1]]) for r in rows]


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order and step (see ``RESULT``), zeros included; counts are of documents within the part.

    One task per part gets its at most 32 cells.  An empty table has no part and so no rows."""
    columns = [c.split(" ")[0] for c in RESULT.split(", ")]

    def walk(t: pd.DataFrame) -> pd.DataFrame:
        found = {int(r.mask): (int(r.n), int(r.good), int(r.toxic)) for r in t.itertuples()}
        return pd.DataFrame(audit_rows(t["part"].iloc[0], found), columns=columns)

    return cells(docs, labels).groupBy("part").applyInPandas(walk, RESULT)
