"""Benchmark decontamination by a positional inverted index, built-in functions only.

The index stores a posting (term, document, position) for every occurrence, in
the training texts, of a term of the vocabulary, and how often each term
occurs.  A phrase is looked up from its rarest terms: the rarest term's postings,
moved back by the term's place in the phrase, are where the phrase may start;
they are intersected with the second rarest term's list, moved back likewise, and what is left with the lists of all
other terms.  Proximity search starts from the rarest term as well and wants every other term near.

Postings are written without a shuffle.  An intersection meets lists by (term,
document, position), so the list of a term that every text holds is spread over
all tasks; the lists of frequent terms are only asked at the places that rarer
terms have left.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.llm.common import kept, saved, text_or_empty

WINDOW = 10  # words of an item that make a hit

# fixed values: characters between words, and capitals that are lower-cased
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

BROADCAST_ROWS = 500_000  # rows of two or three numbers that are sent to every executor; a larger side is met by a shuffle
SALTS = 32                # parts that each term's postings are dealt to then

DOC = ["d1", "d2"]  # a document: its id and a hash of its text, so that repeated ids with other texts stay apart


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased."""
    ascii_only = F.octet_length(text) == F.length(text)
    low = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, SMALL))
    return F.array_remove(F.split(low, BETWEEN), "")


def doc_key(key: str) -> list[Column]:
    """``d1, d2``; of a null id both are hashes of the text.  Rows equal in id and text share a key: they have the same results."""
    text = text_or_empty()
    return [F.coalesce(F.col(f"`{key}`").cast("long"), F.xxhash64(F.lit(1), text)).alias("d1"),
            F.xxhash64(F.col(f"`{key}`").isNull(), text).alias("d2")]


@dataclass
class PositionalIndex:
    """``terms``: word, term (its number) and n (occurrences); ``postings``: term, d1, d2, pos."""

    terms: DataFrame
    postings: DataFrame


def build_index(docs: DataFrame, vocabulary: DataFrame | None = None, key: str = "doc_id") -> PositionalIndex:
    """The index of all texts of ``docs`` for the words of ``vocabulary(word)``, or for every word."""
    tokens = docs.select(*doc_key(key), F.posexplode(words_of(text_or_empty())).alias("pos", "word"))
    if vocabulary is None:
        vocabulary = tokens.select("word")
    numbers = saved(vocabulary.select("word").where("word is not null").distinct().withColumn("term", F.monotonically_increasing_id()), "index-terms")
    postings = saved(tokens.join(numbers, "word").select("term", "d1", "d2", "pos"), "index-postings")
    counts = postings.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return PositionalIndex(saved(numbers.join(counts, "term"), "index-counts"), postings)


def _ranked(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """``phrase, terms``: the terms of every phrase as (n, off, term), rarest first; phrases with a word that the corpus lacks are left out."""
    each = phrases.select("phrase", F.size("words").alias("len"), F.posexplode("words").alias("off", "word"))
    per = each.join(index.terms, "word").groupBy("phrase", "len").agg(F.sort_array(F.collect_list(F.struct("n", "off", "term"))).alias("terms"))
    return per.where(F.size("terms") == F.col("len")).drop("len")


def _of_terms(postings: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
    """``postings`` joined with ``side`` by term.  A ``side`` of counted, bounded size goes to the postings; a
    larger one is copied per part of a term's postings, as one term may hold a third of them."""
    if side.count() <= BROADCAST_ROWS:
        return postings.join(F.broadcast(side), "term", how)
    salted = side.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    own = F.pmod(F.hash(*DOC, "pos"), F.lit(SALTS))
    return postings.withColumn("__salt", own).join(salted, ["term", "__salt"], how).drop("__salt")


def _at(terms: str, i: int, *names: str) -> list[Column]:
    return [F.col(terms)[i][n].alias(n) for n in names]


def phrase_matches(index: PositionalIndex, phrases: DataFrame) -> DataFrame:
    """``phrase, d1, d2, start``: every place at which all words of ``phrases(phrase,
    words)`` stand in a row, once.  ``phrase`` names are distinct, ``words`` not empty."""
    plan = saved(_ranked(index, phrases), "index-plan")
    on = ["term", *DOC, "pos"]

    first = plan.select("phrase", *_at("terms", 0, "term", "off"))
    places = kept(_of_terms(index.postings, first).select("phrase", *DOC, (F.col("pos") - F.col("off")).alias("start")).where("start >= 0").distinct())
    # the second rarest term, of phrases that have one
    second = plan.where(F.size("terms") > 1).select("phrase", *_at("terms", 1, "term", "off"))
    asked = places.join(second, "phrase").select("phrase", "start", "term", *DOC, (F.col("start") + F.col("off")).alias("pos"))
    lists = _of_terms(index.postings, second.select("term").distinct(), "left_semi")
    two = kept(asked.join(lists, on, "left_semi").select("phrase", *DOC, "start"))
    # all others at once: a place stays if each of them is met
    rest = plan.where(F.size("terms") > 2).select("phrase", F.explode(F.slice(F.col("terms"), F.lit(3), F.size("terms"))).alias("t"), (F.size("terms") - 2).alias("need"))
    asked = two.join(rest, "phrase").select("phrase", "start", "need", F.col("t.term").alias("term"), *DOC, (F.col("start") + F.col("t.off")).alias("pos"))
    all_met = (asked.join(index.postings, on, "left_semi").groupBy("phrase", *DOC, "start", "need").agg(F.count(F.lit(1)).alias("met"))
               .where("met = need").select("phrase", *DOC, "start"))
    short = plan.select("phrase", F.size("terms").alias("len"))
    one = places.join(short.where("len = 1").select("phrase"), "phrase", "left_semi").select("phrase", *DOC, "start")
    pair = two.join(short.where("len = 2").select("phrase"), "phrase", "left_semi")
    return one.unionByName(pair).unionByName(all_met)


def proximity_matches(index: PositionalIndex, phrases: DataFrame, width: int) -> DataFrame:
    """``phrase, d1, d2, pos``: every occurrence of a phrase's rarest word that has each other word of the phrase
    at most ``width`` words away, in any order.  A word that the phrase repeats needs one occurrence."""
    each = phrases.select("phrase", F.array_distinct("words").alias("words"))
    plan = saved(_ranked(index, each), "index-near-plan")
    size = width + 1
    first = plan.select("phrase", (F.size("terms") - 1).alias("need"), *_at("terms", 0, "term"))
    places = _of_terms(index.postings, first).select("phrase", "need", *DOC, "pos").distinct()
    rest = plan.select("phrase", F.explode(F.slice(F.col("terms"), F.lit(2), F.size("terms"))["term"]).alias("term"))
    # stretches of width + 1 words: a word that is near stands in the same one or a neighbour
    stretch = F.floor(F.col("pos") / size)
    asked = places.join(rest, "phrase").withColumn("stretch", F.explode(F.array(stretch - 1, stretch, stretch + 1)))
    lists = (_of_terms(index.postings, rest.select("term").distinct(), "left_semi").distinct()
             .select("term", *DOC, stretch.alias("stretch"), F.col("pos").alias("there")))
    near = asked.join(lists, ["term", *DOC, "stretch"]).where(F.abs(F.col("pos") - F.col("there")) <= width)
    many = (near.select("phrase", *DOC, "pos", "need", "term").distinct().groupBy("phrase", *DOC, "pos", "need").agg(F.count(F.lit(1)).alias("met"))
            .where("met = need").select("phrase", *DOC, "pos"))
    return places.where("need = 0").select("phrase", *DOC, "pos").unionByName(many)


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, words``: every run of ``window`` words of an item; of a shorter item, the whole of it, of one without words nothing."""
    w = items.select(F.col("item_id").cast("string").alias("item"), words_of(text_or_empty()).alias("all"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - (window - 1), F.lit(1)))
    return (w.where(F.size("all") > 0).withColumn("start", F.explode(starts))
            .select("item", F.slice(F.col("all"), F.col("start"), F.lit(window)).alias("words")).distinct())


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, key: str = "doc_id") -> DataFrame:
    """``key, n_words, n_hit, n_items, items`` for every row of ``docs``: words, words inside any occurrence of an item's window,
    distinct items that have one, and their ids as text, sorted.

    A null text has no words; a document or item without words has no hits.  Windows that several items share are looked up once.  Hits of an item
    without an id count, the item does not.  Repeated rows get a row each; extra columns are ignored."""
    windows = saved(item_windows(items, window), "item-windows")
    vocabulary = windows.select(F.explode("words").alias("word")).distinct()
    index = build_index(docs, vocabulary, key)
    phrases = saved(windows.select("words").distinct().withColumn("phrase", F.monotonically_increasing_id()), "item-phrases")
    owners = windows.join(phrases, "words").select("phrase", "item")
    hits = kept(phrase_matches(index, phrases))
    lengths = phrases.select("phrase", F.size("words").alias("len"))
    covered = (hits.join(lengths, "phrase").select(*DOC, F.explode(F.expr("sequence(start, start + len - 1)")).alias("pos")).distinct()
               .groupBy(*DOC).agg(F.count(F.lit(1)).alias("n_hit")))
    found = (hits.select("phrase", *DOC).distinct().join(owners, "phrase").where("item is not null").select(*DOC, "item").distinct()
             .groupBy(*DOC).agg(F.sort_array(F.collect_list("item")).alias("items")))
    heads = docs.select(F.col(f"`{key}`").alias(key), *doc_key(key), F.size(words_of(text_or_empty())).cast("long").alias("n_words"))
    empty = F.array().cast("array<string>")
    return (heads.join(covered.join(found, DOC, "left"), DOC, "left")
            .select(key, "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", empty).alias("items"))
            .select(key, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items"))
