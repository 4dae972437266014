"""Mixing sources to target weights by hash-threshold histograms.

Every source has a token budget.  Whole rounds over a source are taken as
repeats; the rest of the budget is met by taking the documents whose hash is
below a threshold.  The threshold is found digit by digit: a histogram of
tokens by source and hash digit shows in which bucket the budget ends, and
only that boundary bucket is looked at with the next digit.  Nothing is
sorted, and smaller budgets take subsets of what larger ones take.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from veilspark.llm.common import kept, saved, text_or_empty, word_count

DIGIT_BITS = 12  # 4,096 buckets per histogram
DIGITS = 5       # 60 hash bits: enough for any table
MAX_REPEATS = 3


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``(source, source_size, target)`` from one row per source.

    Sources in code point order, null last, weigh 1, 2, 3, repeating, and
    share the sum of all sizes.  A target stops at ``max_repeats`` times its
    source's size and the excess is reshared by weight until none is above:
    with sources in the order of ``cap / weight``, the first k are capped and
    the others get ``weight * level_k``, for the smallest k whose level keeps
    source k + 1 within its cap.  One row per source, so the two windows over
    all sources hold no documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())  # a struct (none, name) orders null last as well
    ws = F.array(*[F.lit(w) for w in weights])
    s = sizes.select("source", "source_size",
                     F.get(ws, F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))).cast("double").alias("w"))
    s = s.withColumn("cap", F.col("source_size") * float(max_repeats))
    by_ratio = W.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.select("*", F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("cap_before"),
                 F.coalesce(F.sum("w").over(before), F.lit(0.0)).alias("w_before"),
                 F.sum("source_size").over(everything).cast("double").alias("total"),
                 F.sum("w").over(everything).alias("w_all"))
    level = (F.col("total") - F.col("cap_before")) / (F.col("w_all") - F.col("w_before"))
    s = s.withColumn("level", F.when(F.col("cap") >= level * F.col("w"), level))
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("w"), F.col("cap")))
    return s.select("source", "source_size", target.alias("target"))


def _digit(level: int) -> Column:
    shift = 64 - DIGIT_BITS * (level + 1)
    return F.shiftrightunsigned("hash", shift).bitwiseAND((1 << DIGIT_BITS) - 1)


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``(source, threshold)`` for ``rows(source, hash, size)`` and ``budgets(source,
    budget)``: taking a source's rows with ``hash < threshold`` (of the hash's
    top ``DIGITS * DIGIT_BITS`` bits) meets the budget as nearly as whole
    hash values can.  ``source`` is not null here.

    Per level one histogram; of the boundary bucket only, the next digit.  It
    ends when no boundary bucket holds more than one hash value.
    """
    live = budgets.select("source", F.lit(0).cast("long").alias("prefix"), F.col("budget").cast("double").alias("budget"))
    inside = rows.select("source", "hash", "size")
    done = None
    by_digit = W.partitionBy("source").orderBy("digit")
    for level in range(DIGITS):
        hist = inside.groupBy("source", _digit(level).alias("digit")).agg(
            F.sum("size").alias("size"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        h = (hist.withColumn("upto", F.sum("size").over(by_digit))
             .join(live, "source")
             .where((F.col("upto") > F.col("budget")) & (F.col("upto") - F.col("size") <= F.col("budget"))))
        # the first bucket that the budget ends in; later ones have a larger start
        found = h.select("source", "digit", "size", "lo", "hi", "prefix",
                         (F.col("budget") - (F.col("upto") - F.col("size"))).alias("rest"))
        path = F.col("prefix") * (1 << DIGIT_BITS) + F.col("digit")
        last = F.lit(level == DIGITS - 1) | (F.col("lo") == F.col("hi"))
        cut = saved(found.select("source", "size", "rest", path.alias("prefix"), last.alias("last")), "mix-boundary")
        pad = 1 << (DIGIT_BITS * (DIGITS - 1 - level))
        # a bucket that can't be parted is taken if that ends nearer to the budget
        ended = cut.where("last").select(
            "source", ((F.col("prefix") + (F.col("rest") * 2 >= F.col("size")).cast("long")) * pad).alias("threshold"))
        done = ended if done is None else done.unionByName(ended)
        live = cut.where("not last").select("source", "prefix", F.col("rest").alias("budget"))
        if live.isEmpty():
            break
        top = F.shiftrightunsigned("hash", 64 - DIGIT_BITS * (level + 1))
        inside = (inside.join(live.select("source", "prefix"), "source")
                  .where(top == F.col("prefix")).select("source", "hash", "size"))
        inside = saved(inside, "mix-inside")
    return done


def _planned(docs: DataFrame, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """``docs`` plus ``__size, __source_size, __target, __copies``."""
    key = F.struct(F.col("source").isNull().alias("none"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("name"))
    d = docs.withColumns({"__size": word_count(text_or_empty()), "__hash": F.xxhash64("doc_id", "text"), "__source": key})
    plan = kept(d.select(F.col("__source").alias("source"), F.col("__hash").alias("hash"), F.col("__size").alias("size")))
    per_source = plan.groupBy("source").agg(F.sum("size").alias("source_size"))
    t = source_targets(per_source, weights, max_repeats)
    some = F.col("source_size") > 0
    whole = F.when(some, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_repeats))).otherwise(0).cast("int")
    t = saved(t.withColumn("whole", whole), "mix-targets")
    budgets = t.where(some).select("source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("budget")).where("budget >= 0.5")
    cuts = thresholds(plan.where("size > 0"), budgets)
    t = saved(t.join(cuts, "source", "left").select(
        F.col("source").alias("__source"), F.col("source_size").alias("__source_size"), F.col("target").alias("__target"),
        F.col("whole").alias("__whole"), F.coalesce("threshold", F.lit(0)).alias("__threshold")), "mix-cuts")
    below = F.shiftrightunsigned("__hash", 64 - DIGITS * DIGIT_BITS) < F.col("__threshold")
    return d.join(t, "__source").withColumn("__copies", F.col("__whole") + below.cast("int"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = MAX_REPEATS) -> DataFrame:
    """``docs`` plus ``size`` (words), ``source_size``, ``target`` and ``copies``
    (how often the mix takes the document, 0 to ``max_repeats``); result
    columns replace input columns of the same name.

    The hash is of id and text, so reruns agree.  Rows equal in both are
    taken together.  A null or empty text has size 0.  A null source is a
    source of its own.  A source without any word has target 0 and its
    documents are not taken.
    """
    names = ("size", "source_size", "target", "copies")
    d = _planned(docs, weights, max_repeats)
    keep = [c for c in docs.columns if c.lower() not in names]
    return d.select(*[F.col(f"`{c}`") for c in keep], *[F.col(f"__{n}").alias(n) for n in names])


def take_mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = MAX_REPEATS) -> DataFrame:
    """The mixed table: each document of ``docs`` repeated as often as the mix takes it, columns as they were."""
    m = _planned(docs, weights, max_repeats).where("__copies > 0")
    return (m.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
