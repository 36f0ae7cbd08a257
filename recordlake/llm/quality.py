"""Quality: positive-unlabelled learning by the non-negative unbiased risk.

Trusted positives are labelled rows of good quality; the unlabelled set is web
text of any kind, taken from documents that are not held out.  The class prior is
estimated from the labelled rows as the share of good ones.  With prior p and
logistic losses, the risk is p R(positives, 1) + max(0, R(unlabelled, 0) - p R(positives, 0)):
the part in brackets estimates the risk on bad texts, which cannot be negative, so
where it is, the step goes the other way, as published for this estimator.

Features are of the whole text: shares of byte values, the share of distinct and
of repeated words, word lengths, and shares of the sample's most common words.
Fitted on at most ``SAMPLE_PER_CLASS`` rows of either set.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import documents, held_out, labels, written
from recordlake.llm.textkernel import words
from recordlake.llm.textmodels import SAMPLE_PER_CLASS, digest, features, labelled_sample, one_text_each, scored, sigmoid

THRESHOLD = 0.3
RIDGE = 1e-4
STEPS = 1500
RATE = 0.02


def describe(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The features of each text."""
    n = len(offsets) - 1
    sizes = np.diff(offsets)
    doc = np.repeat(np.arange(n), sizes)
    shares = np.bincount(doc * 256 + data, minlength=n * 256).reshape(n, 256) / np.maximum(1, sizes)[:, None]
    groups = np.c_[shares[:, :128], shares[:, 128:].sum(axis=1)]
    hashes, starts = words(data, offsets)
    counts = np.diff(starts)
    owner = np.repeat(np.arange(n), counts)
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    distinct = np.bincount(o[new], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(new), len(h)))
    most = np.zeros(n)
    np.maximum.at(most, o[new], runs)
    twice = np.zeros(len(hashes), dtype=bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    total = np.maximum(1, counts)
    space = shares[:, [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]].sum(axis=1)
    length = (1 - space) * sizes / total
    extra = np.c_[
        distinct / np.sqrt(total),
        distinct / total,
        most / total,
        np.bincount(owner, weights=twice, minlength=n) / total,
        np.log1p(length),
        np.log1p(sizes),
        counts == 0,
    ]
    return np.c_[np.sqrt(groups), extra]


def fit_weights(positive: np.ndarray, unlabelled: np.ndarray, prior: float) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the non-negative risk (Adam on the whole sample)."""
    xp, xu = np.c_[positive, np.ones(len(positive))], np.c_[unlabelled, np.ones(len(unlabelled))]
    w = np.zeros(xp.shape[1])
    m, v = np.zeros_like(w), np.zeros_like(w)
    ridge = np.append(np.full(xp.shape[1] - 1, RIDGE), 0)
    for step in range(1, STEPS + 1):
        sp, su = xp @ w, xu @ w
        bad = np.logaddexp(0, su).mean() - prior * np.logaddexp(0, sp).mean()
        as_bad = xu.T @ sigmoid(su) / len(xu) - prior * xp.T @ sigmoid(sp) / len(xp)
        g = -as_bad if bad < 0 else as_bad - prior * xp.T @ sigmoid(-sp) / len(xp) + 2 * ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, known: DataFrame, label: str = "quality", per_class: int = SAMPLE_PER_CLASS):
    """The model: (centre, scale, weights, bias), or None without trusted positives or without unlabelled text."""
    mine = known.where(~held_out()).groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("y")).where("y IN (0, 1)")
    prior = mine.agg(F.avg("y")).first()[0]
    trusted = labelled_sample(docs, known.where(F.col(label) == 1), label, per_class)
    order = [F.xxhash64(F.col("doc_id"), F.lit(1)), F.col("doc_id")]
    web_ids = docs.where(~held_out()).select("doc_id").distinct().orderBy(*order).limit(2 * per_class)
    web = one_text_each(docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text")).join(web_ids, "doc_id"))
    both = trusted.select("doc_id", "text", "y").unionByName(web.withColumn("y", F.lit(0)))
    x, rows = features(written(both, "quality-sample"), describe)
    y = np.array([r["y"] for r in rows])
    if prior is None or not len(rows) or y.min() == y.max():
        return None
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, np.inf)
    z = np.clip((x - centre) / scale, -8, 8)
    return centre, scale, *fit_weights(z[y == 1], z[y == 0], min(0.98, max(0.02, float(prior))))


def classify(docs: DataFrame, known: DataFrame, label: str = "quality") -> DataFrame:
    """Every row with ``score`` and ``predicted``; see ``textmodels.scored``.

    A null text is scored as the empty one.  Rows that repeat are scored alike;
    extra columns stay in the struct ``doc``; an empty table gives an empty
    result.  Without trusted positives nothing is known, and every score is 1.
    """
    model = fit(docs, known, label)

    def score(data, offsets):
        if model is None:
            return np.ones(len(offsets) - 1)
        centre, scale, weights, bias = model
        z = np.clip((describe(data, offsets) - centre) / scale, -8, 8)
        return sigmoid(z @ weights + bias)

    return scored(docs, score, THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(classify(documents(spark, sf_dir), labels(spark, sf_dir)))
