"""Quality classification with hierarchical empirical Bayes over sites.

A document classifier (boosted trees over dense features, calibrated, fitted
on a bounded labelled sample) gives each document's evidence.  Grouped sums of
that evidence give every host and every path of a host a Beta posterior:
paths shrink towards their host and hosts towards the global share, the more
the fewer documents they have.  How strongly is estimated from the spread of
the groups' means.  A document's log odds are its own evidence plus what
its path says beyond the global share, without its own part in it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.boosting import BoostedTrees, Isotonic
from veilspark.llm.common import map_arrow, saved, text_or_empty
from veilspark.llm.textstats import DIGITS, LETTERS, LOWER, PUNCTUATION, count_of
from veilspark.llm.toxicity import labelled_sample

SAMPLE_ROWS = 20_000  # labelled rows that the classifier is fitted on, at most
STRENGTH = (1.0, 1e6)  # bounds of a prior's strength, in documents
HOST, PATH = "source", "lang"  # what stands for the host and for the path below it in a documents table

FEATURES = ("log words", "mean word length", "distinct word share", "repeated neighbour share", "commonest word share", "capital rate",
            "capital word share", "punctuation rate", "digit rate", "sign rate", "bar rate", "sentence end rate", "comma rate",
            "line share", "repeated line share", "one-sign word share", "non-ASCII rate")

SIGNS = bytes(c for c in PUNCTUATION if c not in b".,;:!?'\"()-")


def features(text: bytes) -> list[float]:
    raw = text.split()
    n, size = len(raw) or 1, len(text) or 1
    letters = count_of(text, LETTERS) or 1
    counts: dict[bytes, int] = {}
    for w in raw:
        counts[w] = counts.get(w, 0) + 1
    upper = count_of(text, LOWER)
    lines = text.split(b"\n")
    return [math.log1p(n), letters / n, len(counts) / n, sum(map(bytes.__eq__, raw, raw[1:])) / n, max(counts.values(), default=0) / n,
            upper / letters, (sum(map(bytes.isupper, raw)) if upper else 0) / n, count_of(text, PUNCTUATION) / size,
            count_of(text, DIGITS) / size, count_of(text, SIGNS) / size, text.count(b"|") / n, (text.count(b".") + text.count(b"!") + text.count(b"?")) / n,
            text.count(b",") / n, len(lines) / n, 1 - len(set(lines)) / len(lines), sum(1 for w, c in counts.items() if len(w) == 1 for _ in range(c)) / n,
            1 - len(text.decode("utf-8", "replace")) / size]


def matrix(texts) -> np.ndarray:
    rows = [features(t.as_py()) for t in texts]
    return np.array(rows, float).reshape(len(rows), len(FEATURES))


class QualityModel:
    def __init__(self, x: np.ndarray, y: np.ndarray, part: np.ndarray):
        fitted, held = part != 0, part == 0
        if not (0 < y[held].sum() < held.sum()) or not (0 < y[fitted].sum() < fitted.sum()):
            fitted = held = np.ones(len(y), bool)  # too few labels to part them
        self.trees = BoostedTrees().fit(x[fitted], y[fitted])
        self.calibration = Isotonic().fit(self.trees.margin(x[held]), y[held])

    def evidence(self, x: np.ndarray) -> np.ndarray:
        return self.calibration.apply(self.trees.margin(x))


def _labelled_features(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column("label"), b.column("part"), pa.array(list(matrix(b.column("body"))), pa.list_(pa.float64()))],
                                         ["label", "part", "x"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", modulus: int = 5, rest: int = 0,
        sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    sample = labelled_sample(docs, labels, label, modulus, rest, sample_rows)
    rows = map_arrow(sample, _labelled_features, "label int, part int, x array<double>").collect()
    rows.sort(key=lambda r: (r["x"], r["label"], r["part"]))  # the fit does not depend on the order of tasks
    x = np.array([r["x"] for r in rows], float).reshape(len(rows), len(FEATURES))
    return QualityModel(x, np.array([r["label"] for r in rows], float), np.array([r["part"] for r in rows], int))


def with_evidence(docs: DataFrame, model: QualityModel, columns: list[str], name: str = "__evidence") -> DataFrame:
    """``columns`` of ``docs`` and the classifier's probability of good quality."""
    def run(batches):
        for b in batches:
            p = pa.array(model.evidence(matrix(b.column("__body"))), pa.float64())
            kept = [b.column(i) for i, f in enumerate(b.schema.names) if f != "__body"]
            yield pa.RecordBatch.from_arrays([*kept, p], [*columns, name])

    d = docs.select(*[F.col(f"`{c}`") for c in columns], text_or_empty().cast("binary").alias("__body"))
    schema = T.StructType([f for f in d.schema.fields if f.name != "__body"] + [T.StructField(name, T.DoubleType())])
    return map_arrow(d, run, schema)


def _prior(var: float, between: float) -> float:
    """Strength of a Beta prior whose means vary by ``between`` around shares with the sampling variance ``var``."""
    return min(max(var / between - 1, STRENGTH[0]), STRENGTH[1]) if between > 0 else STRENGTH[1]


def _strengths(paths: DataFrame, host: str) -> tuple[float, float]:
    """Prior strengths of hosts around the global share and of paths around their host's, from the spread of means.

    With means ``m_i`` of ``n_i`` documents around a mean ``m``, the variance between them is what is left of the weighted spread after the
    sampling variance ``m (1 - m)`` of each; the strength is ``m (1 - m) / between - 1``.  For paths, ``m`` is the mean of
    their host, and spread, sampling variance and weight are summed over hosts, so that what sets hosts apart is no part of it; a host
    of one path says nothing.  Without any spread a strength is its upper bound."""
    hosts = paths.groupBy(host).agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("k"),
                                    F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"))
    own = F.col("s") / F.col("n") * (1 - F.col("s") / F.col("n"))  # sampling variance inside the host
    r = hosts.agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.count("*").alias("k"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                  F.sum(F.col("s") * F.col("s") / F.col("n")).alias("ss"), F.sum(F.col("ss") - F.col("s") * F.col("s") / F.col("n")).alias("path_spread"),
                  F.sum((F.col("k") - 1) * own).alias("path_noise"), F.sum(F.col("n") - F.col("nn") / F.col("n")).alias("path_scale"),
                  F.sum(F.when(F.col("k") > 1, F.col("n") * own).otherwise(0.0)).alias("path_var"),
                  F.sum(F.when(F.col("k") > 1, F.col("n")).otherwise(0)).alias("path_n")).first()
    if not r["n"]:
        return STRENGTH[1], STRENGTH[1]
    mean = r["s"] / r["n"]
    var = mean * (1 - mean)
    scale = r["n"] - r["nn"] / r["n"]
    m_host = _prior(var, (r["ss"] - r["n"] * mean * mean - (r["k"] - 1) * var) / scale if scale > 0 else 0.0)
    between = (r["path_spread"] - r["path_noise"]) / r["path_scale"] if r["path_scale"] > 0 else 0.0
    return m_host, _prior(r["path_var"] / r["path_n"] if r["path_n"] else 0.0, between)


def site_posteriors(evidence: DataFrame, host: str = "__host", path: str = "__path") -> tuple[DataFrame, float]:
    """``(host, path, n, s, host_posterior, strength)`` and the global share, from
    ``evidence(host, path, p)``.  One row per path of a host, counted with partial sums, so a large host is a few rows."""
    paths = saved(evidence.groupBy(host, path).agg(F.count("*").alias("n"), F.sum("p").alias("s")), "paths")
    hosts = paths.groupBy(host).agg(F.sum("n").alias("host_n"), F.sum("s").alias("host_s"))
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    share = (total["s"] + 1.0) / (total["n"] + 2.0) if total["n"] else 0.5
    m_host, m_path = _strengths(paths, host)
    h = hosts.select(F.col(host).alias("__h"), ((F.col("host_s") + m_host * share) / (F.col("host_n") + m_host)).alias("host_posterior"))
    out = paths.join(h, F.col(host).eqNullSafe(F.col("__h"))).drop("__h").withColumn("strength", F.lit(float(m_path)))
    return saved(out, "sites"), share


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


RESULT = ("document_score", "host_posterior", "path_posterior", "score", "accepted")


def classify(docs: DataFrame, model: QualityModel, columns: list[str], host: str = HOST, path: str = PATH, threshold: float = 0.5) -> DataFrame:
    """``columns`` of ``docs`` (result columns replace those of the same name) plus
    ``document_score``, ``host_posterior``, ``path_posterior``, ``score`` and ``accepted`` (``score >= threshold``).

    A null host is a host, a null path a path of its host.  A null text counts
    as empty.  Repeated rows count each time.
    """
    site = {"__host": F.col(f"`{host}`").cast("string"), "__path": F.col(f"`{path}`").cast("string")}
    seen = with_evidence(docs.select("text", *[v.alias(k) for k, v in site.items()]), model, list(site), "p")
    sites, share = site_posteriors(seen)
    sites = sites.select(F.col("__host").alias("__h"), F.col("__path").alias("__p"), F.col("n").alias("__n"), F.col("s").alias("__s"),
                         F.col("host_posterior").alias("__hp"), F.col("strength").alias("__m"))
    keep = [c for c in columns if c.lower() not in RESULT]
    d = docs.select("text", *[F.col(f"`{c}`") for c in keep if c != "text"], *[v.alias(k) for k, v in site.items()])
    d = with_evidence(d, model, [*keep, *site])
    j = d.join(sites, d["__host"].eqNullSafe(sites["__h"]) & d["__path"].eqNullSafe(sites["__p"]))
    others = (F.col("__s") - F.col("__evidence") + F.col("__m") * F.col("__hp")) / (F.col("__n") - 1 + F.col("__m"))
    odds = _logit(F.col("__evidence")) + _logit(others) - _logit(F.lit(share))
    j = j.withColumn("__score", 1 / (1 + F.exp(-odds)))
    return j.select(*[F.col(f"`{c}`") for c in keep], F.col("__evidence").alias("document_score"), F.col("__hp").alias("host_posterior"),
                    others.alias("path_posterior"), F.col("__score").alias("score"), (F.col("__score") >= threshold).alias("accepted"))


def keep_accepted(docs: DataFrame, model: QualityModel, host: str = HOST, path: str = PATH, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that :func:`classify` accepts, columns as they were."""
    names = [f"__c{i}" for i in range(len(docs.columns))]
    at = {c: n for c, n in zip(docs.columns, names)}
    d = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in at.items()], F.col("text"))
    r = classify(d, model, names, at[host], at[path], threshold).where("accepted")
    return r.select(*[F.col(n).alias(c) for c, n in at.items()])
