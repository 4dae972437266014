"""Toxicity scores: boosted trees over dense features, with isotonic calibration.

Features are densities of lexicon terms, plain and obfuscated, their
proximity to second-person words, and the rates of capitals, punctuation and
obfuscation.  The lexicon is learned from labelled training rows: whole words
and word beginnings that toxic texts hold far more often than others.
Fitting uses a bounded sample of labelled rows; scoring reads every whole text.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.boosting import BoostedTrees, Isotonic
from veilspark.llm.common import id_bucket, map_arrow, saved, text_or_empty
from veilspark.llm.textstats import DIGITS, HIGH, LETTERS, LOWER, PLAIN, PUNCTUATION, REVEALED, SEPARATORS, count_of

SAMPLE_ROWS = 20_000  # labelled rows that the classifier is fitted on, at most
LEXICON_TERMS = 400
PREFIXES = (4, 5, 6)  # bytes of the word beginnings that may be terms
NEAR = 5              # words between a term and a second-person word

# fixed values: second-person words of the four languages
SECOND_PERSON = frozenset(w.encode() for w in (
    "you your yours yourself du dich dir dein deine euch ihr tu te toi ton ta vous votre vos tú usted ustedes tus vosotros").split())


def terms_of(text: bytes) -> set[bytes]:
    """Words and marked word beginnings of a text."""
    words = set(text.translate(PLAIN).split())
    out = set(words)
    for n in PREFIXES:
        out.update(w[:n] + b"*" for w in words if len(w) >= n)
    return out


class Lexicon:
    def __init__(self, terms: list[bytes]):
        self.words = frozenset(t for t in terms if not t.endswith(b"*"))
        self.starts = frozenset(t[:-1] for t in terms if t.endswith(b"*"))
        self.known: dict[bytes, bool] = {}

    def holds(self, word: bytes) -> bool:
        v = self.known.get(word)
        if v is None:
            if len(self.known) > 300_000:
                self.known.clear()
            v = self.known[word] = word in self.words or any(word[:n] in self.starts for n in PREFIXES)
        return v


FEATURES = ("term density", "log terms", "hidden term density", "terms near second person", "second person rate", "capital rate",
            "capital word rate", "exclamation rate", "question rate", "punctuation rate", "digit rate", "obfuscated word rate",
            "log words", "mean word length")


def features(text: bytes, lexicon: Lexicon) -> list[float]:
    raw = text.split()
    n = len(raw) or 1
    words = text.translate(PLAIN).split()
    hits = [i for i, w in enumerate(words) if lexicon.holds(w)]
    near = 0
    if hits:
        near = sum(1 for i in hits if not SECOND_PERSON.isdisjoint(words[max(0, i - NEAR):i + NEAR + 1]))
    hidden = 0
    if len(words) != n or count_of(text, DIGITS + PUNCTUATION):
        for w in raw:
            # signs at the ends are punctuation; what is left inside may stand for letters
            if not w.isalpha() and (core := w.strip(PUNCTUATION)) and core.translate(None, LETTERS + HIGH):
                hidden += lexicon.holds(core.translate(REVEALED, SEPARATORS))
    letters, size = count_of(text, LETTERS) or 1, len(text) or 1
    upper = count_of(text, LOWER)
    capital_words = sum(map(bytes.isupper, raw)) if upper else 0
    odd = len(words) - n  # words cut by signs or digits
    return [len(hits) / n, math.log1p(len(hits)), hidden / n, near / n, sum(map(SECOND_PERSON.__contains__, words)) / n,
            upper / letters, capital_words / n, text.count(b"!") / size, text.count(b"?") / size,
            count_of(text, PUNCTUATION) / size, count_of(text, DIGITS) / size, max(0, odd) / n, math.log1p(n), letters / n]


def matrix(texts, lexicon: Lexicon) -> np.ndarray:
    rows = [features(t.as_py(), lexicon) for t in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


def _count_terms(batches):
    counts: Counter = Counter()
    for b in batches:
        for t, y in zip(b.column("body"), b.column("label").to_pylist()):
            for term in terms_of(t.as_py()):
                counts[(term, y)] += 1
    yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in counts], pa.binary()), pa.array([k[1] for k in counts], pa.int32()),
                                      pa.array(list(counts.values()), pa.int64())], ["term", "label", "n"])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rest: int, sample_rows: int) -> DataFrame:
    """``(label, part, body)`` of at most ``sample_rows`` labelled rows outside the
    held-out rest, the first in the order of a hash of the id.  The sample's
    ids are broadcast: that bound is ``sample_rows``."""
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (id_bucket("doc_id", modulus) != rest))
    ids = (usable.groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.max(label).cast("int").alias("label"))
           .orderBy(F.xxhash64("__id"), "__id").limit(sample_rows))
    d = docs.select(F.col("doc_id").cast("long").alias("__id"), text_or_empty().cast("binary").alias("body"))
    part = F.pmod(F.xxhash64("__id", F.lit(1)), F.lit(3)).cast("int")
    return d.join(F.broadcast(ids), "__id").select("label", part.alias("part"), "body")


def learn_lexicon(sample: DataFrame, size: int = LEXICON_TERMS) -> list[bytes]:
    """The ``size`` terms with the largest shrunk log odds of being in a labelled
    text, among those in at least 3 such texts.  The sample is bounded, and so is what its terms shuffle."""
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not n.get(1):
        return []
    counts = (map_arrow(sample.select("body", "label"), _count_terms, "term binary, label int, n long")
              .groupBy("term").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"),
                                   F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("b")))
    # log odds less two standard errors: rare terms need a clearer contrast
    odds = F.log((F.col("a") + 0.5) / (n[1] + 1.0)) - F.log((F.col("b") + 0.5) / (n.get(0, 0) + 1.0))
    low = odds - 1.0 * F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    rows = (counts.where("a >= 3").withColumn("low", low).where("low > 1.0").orderBy(F.desc("low"), "term").limit(size).collect())
    return [bytes(r["term"]) for r in rows]


def _labelled_features(terms: list[bytes]):
    def run(batches):
        lexicon = Lexicon(terms)
        for b in batches:
            x = matrix(b.column("body"), lexicon)
            yield pa.RecordBatch.from_arrays([b.column("label"), b.column("part"), pa.array(list(x), pa.list_(pa.float64()))], ["label", "part", "x"])
    return run


class ToxicityModel:
    """A lexicon, boosted trees, and a calibration fitted on another third of the sample."""

    def __init__(self, terms: list[bytes], x: np.ndarray, y: np.ndarray, part: np.ndarray):
        self.terms = terms
        fit, held = part != 0, part == 0
        if not (0 < y[held].sum() < held.sum()) or not (0 < y[fit].sum() < fit.sum()):
            fit = held = np.ones(len(y), bool)  # too few labels to part them
        self.trees = BoostedTrees().fit(x[fit], y[fit])
        self.calibration = Isotonic().fit(self.trees.margin(x[held]), y[held])

    def score(self, x: np.ndarray) -> np.ndarray:
        return self.calibration.apply(self.trees.margin(x))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5, rest: int = 0,
        sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    sample = saved(labelled_sample(docs, labels, label, modulus, rest, sample_rows), "toxic-sample")
    # the third that calibrates takes no part in the lexicon either, unless there are too few labels to part them
    groups = {(r["label"], r["held"]) for r in sample.select("label", (F.col("part") == 0).alias("held")).distinct().collect()}
    terms = learn_lexicon(sample.where("part <> 0") if len(groups) == 4 else sample)
    rows = map_arrow(sample, _labelled_features(terms), "label int, part int, x array<double>").collect()
    rows.sort(key=lambda r: (r["x"], r["label"], r["part"]))  # the fit does not depend on the order of tasks
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return ToxicityModel(terms, x, np.array([r["label"] for r in rows], float), np.array([r["part"] for r in rows], int))


_SCORED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: ToxicityModel, modulus: int = 5, rest: int = 0) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    A null text counts as empty; an empty text has a score as any other.
    Repeated rows and null ids (held out as empty text would be) give a row
    each.  Only the text enters a score.  Extra columns are ignored.  Without any label
    all scores are the same.
    """
    def run(batches):
        lexicon = Lexicon(model.terms)
        for b in batches:
            s = model.score(matrix(b.column("body"), lexicon))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(s, pa.float64())], ["doc_id", "held_out", "score"])

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (id_bucket("doc_id", modulus) == rest).alias("held_out"),
                    text_or_empty().cast("binary").alias("body"))
    return map_arrow(d, run, _SCORED).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
