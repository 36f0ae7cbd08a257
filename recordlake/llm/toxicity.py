"""Toxicity: a logistic classifier of word presence, regularised by counterfactuals.

Its vocabulary are the words of the labelled sample that tell the classes apart
best, and the identity terms.  In every labelled text that names a group, each
identity term is swapped for another one of its set, and the model pays
``PENALTY`` times the squared change of its score.  What is left for a score to
rest on are words that are toxic whoever they are said of, so that neutral
mentions of a group are not flagged.

Fitted on at most ``SAMPLE_PER_CLASS`` labelled rows of each class that are not
held out.  Word counts of the sample are made on Spark; what reaches the driver
is ``VOCABULARY`` words and as many numbers for each sampled row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm.common import documents, labels, written
from recordlake.llm.textkernel import slices
from recordlake.llm.textmodels import (
    SAMPLE_PER_CLASS,
    digest,
    features,
    labelled_sample,
    letter_words,
    places_in,
    scored,
    sigmoid,
    word_hashes,
)

VOCABULARY = 2048
THRESHOLD = 0.5
PENALTY = 4.0
RIDGE = 1e-3
STEPS = 400

#: Terms that name a group, in sets whose members can stand for each other.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("american", "african", "european", "mexican", "chinese", "indian"),
    ("old", "young", "deaf", "blind", "disabled"),
)


def _class_counts(sample: DataFrame) -> DataFrame:
    """``word`` (hash) with the numbers of sampled texts of each class that hold it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy()
            for first, data, offsets in slices(batch.column("text")):
                hashes, starts = letter_words(data, offsets)
                for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
                    distinct = np.unique(hashes[a:b]).view(np.int64)
                    kinds = np.full(len(distinct), y[first + i], dtype=np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(distinct), pa.array(kinds)], ["word", "y"])

    found = sample.select("text", "y").mapInArrow(rows, "word bigint, y int")
    return found.groupBy("word").agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0"))


def _vocabulary(sample: DataFrame, size: int) -> np.ndarray:
    """The words whose presence differs most between the classes, by a normal score, with all identity terms."""
    totals = sample.agg(F.sum("y").alias("n1"), F.sum(1 - F.col("y")).alias("n0")).first()
    n1, n0 = float(totals["n1"] or 0), float(totals["n0"] or 0)
    terms = word_hashes([t for group in IDENTITY_TERMS for t in group])
    if not n1 or not n0:
        return np.unique(terms)
    share = (F.col("n1") + F.col("n0")) / (n1 + n0)
    gap = F.abs(F.col("n1") / n1 - F.col("n0") / n0)
    merit = gap / F.sqrt(share * (1 - share) + 1e-4)
    best = _class_counts(sample).where("n1 + n0 >= 3").orderBy(merit.desc(), F.col("word")).limit(size).collect()
    chosen = np.array([r["word"] for r in best], dtype=np.int64).view(np.uint64)
    return np.unique(np.concatenate([chosen, terms]))


def _presence(vocabulary: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in the vocabulary) of every vocabulary word that a text holds, once each."""
    hashes, starts = letter_words(data, offsets)
    at = places_in(vocabulary, hashes)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(starts))
    held = np.unique(doc[at >= 0] * len(vocabulary) + at[at >= 0])
    return held // max(1, len(vocabulary)), held % max(1, len(vocabulary))


def counterfactuals(x: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Rows of differences: a text's features with one set of identity terms swapped, minus its own."""
    out = []
    for group in IDENTITY_TERMS:
        at = places_in(vocabulary, word_hashes(list(group)))
        turned = np.roll(at, 1)
        naming = x[:, at].any(axis=1)
        swapped = np.zeros((int(naming.sum()), x.shape[1]))
        swapped[:, turned] = x[naming][:, at]
        swapped[:, at] -= x[naming][:, at]
        out.append(swapped)
    rows = np.concatenate(out)
    return rows[np.abs(rows).sum(axis=1) > 0]


def fit_weights(x: np.ndarray, y: np.ndarray, swaps: np.ndarray, penalty: float = PENALTY) -> tuple[np.ndarray, float]:
    """Logistic regression, both classes weighing the same, with ridge and counterfactual penalties (accelerated descent)."""
    n, dims = x.shape
    weight = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b, vw, vb = np.zeros(dims), 0.0, np.zeros(dims), 0.0
    top = 0.25 * np.linalg.norm(np.sqrt(weight)[:, None] * np.c_[x, np.ones(n)], 2) ** 2 + 2 * RIDGE
    if len(swaps):
        top += 2 * penalty * np.linalg.norm(swaps, 2) ** 2 / len(swaps)
    for k in range(STEPS):
        residual = weight * (sigmoid(x @ vw + vb) - y)
        gw = x.T @ residual + 2 * RIDGE * vw
        if len(swaps):
            gw += 2 * penalty * (swaps.T @ (swaps @ vw)) / len(swaps)
        nw, nb = vw - gw / top, vb - residual.sum() / top
        vw, vb = nw + k / (k + 3) * (nw - w), nb + k / (k + 3) * (nb - b)
        w, b = nw, nb
    return w, b


def fit(docs: DataFrame, known: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS):
    """The model: (vocabulary, weights, bias).  Without rows of both classes every score is 0."""
    sample = written(labelled_sample(docs, known, label, per_class), "toxic-sample")
    vocabulary = _vocabulary(sample, VOCABULARY)

    def make(data, offsets):
        x = np.zeros((len(offsets) - 1, len(vocabulary)))
        x[_presence(vocabulary, data, offsets)] = 1
        return x

    x, rows = features(sample, make)
    y = np.array([r["y"] for r in rows])
    if not len(rows) or y.min() == y.max():
        return vocabulary, np.zeros(len(vocabulary)), -40.0
    return vocabulary, *fit_weights(x, y, counterfactuals(x, vocabulary))


def classify(docs: DataFrame, known: DataFrame, label: str = "toxic") -> DataFrame:
    """Every row with ``score`` and ``predicted``; see ``textmodels.scored``.

    A null or empty text has the score of a text without known words.  Rows that
    repeat are scored alike; extra columns stay in the struct ``doc``; an empty
    table gives an empty result.  Without labels of both classes nothing is toxic.
    """
    vocabulary, weights, bias = fit(docs, known, label)

    def score(data, offsets):
        doc, at = _presence(vocabulary, data, offsets)
        return sigmoid(np.bincount(doc, weights=weights[at], minlength=len(offsets) - 1) + bias)

    return scored(docs, score, THRESHOLD)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(classify(documents(spark, sf_dir), labels(spark, sf_dir)))
