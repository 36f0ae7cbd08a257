"""Language identification: blended-spectrum presence kernels, Nyström landmarks, one-versus-rest kernel ridge regression.

Two texts are as alike as the share of byte n-grams of one to ``LONGEST`` bytes that
both hold, over the n-grams that landmarks hold: |A & B| / sqrt(|A| |B|).  The
landmarks are training texts of every language; a text's kernel values against
them, times the inverse root of the kernel among them, are its Nyström features,
and ridge regression of one language against the rest on those gives the model.
Scoring is two matrix products for each slice of texts: presence by landmark, and
kernel by language.

Fitted on at most ``PER_LANGUAGE`` documents of each language that are not held
out, ``LANDMARKS`` of them landmarks; the n-grams of a landmark are bounded by
their number of bytes.  More than ``LANGUAGES`` languages are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from recordlake.llm.common import documents, held_out, packed, written
from recordlake.llm.textkernel import slices
from recordlake.llm.textmodels import features, has_letter, one_text_each

LONGEST = 3
PER_LANGUAGE = 300
LANDMARKS = 40
#: Languages that a model may have: with landmarks of each, what bounds the model.
LANGUAGES = 500
#: Parts that the documents of one language are ranked in first.
SALTS = 64
RIDGE = 1e-2
UNKNOWN = "und"
#: Texts by n-grams that are held at once; more texts are taken one block after another.
CELLS = 1 << 25
#: First code of the n-grams of each length, so that lengths do not clash.
_FIRST = (0, 0, 1 << 8, (1 << 8) + (1 << 16))
_CODES = (1 << 8) + (1 << 16) + (1 << 24)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def grams(data: np.ndarray, length: int) -> np.ndarray:
    """The code of the n-gram at every start."""
    if len(data) < length:
        return np.zeros(0, dtype=np.int32)
    low = _LOWER[data].astype(np.int32)
    code = low[: len(low) - length + 1].copy()
    for j in range(1, length):
        code = (code << 8) | low[j : len(low) - length + 1 + j]
    return code + _FIRST[length]


def presence(known: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text which of the ``known`` n-grams it holds; ``known`` maps a code to a column, -1 for none."""
    n, width = len(offsets) - 1, int(known.max()) + 1
    held = np.zeros((n, max(1, width)), dtype=np.float32)
    place = np.arange(len(data))
    doc = np.repeat(np.arange(n), np.diff(offsets))
    for length in range(1, LONGEST + 1):
        column = known[grams(data, length)]
        fits = column >= 0
        if length > 1:
            fits &= place[: len(column)] + length <= offsets[1:][doc[: len(column)]]
        held[doc[: len(column)][fits], column[fits]] = 1
    return held


def training(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id``, ``lang``, ``place`` and ``text`` of the documents learned from, chosen by a hash of the id.

    Of rows that repeat an id and language the least text counts.
    """
    learnable = docs.where(~held_out() & F.col("lang").isNotNull() & has_letter(F.col("text")))
    ids = learnable.groupBy("lang", "doc_id").agg(F.min(F.xxhash64("doc_id")).alias("h"))
    # A language may have most documents: the first of each part of it, then the first of those.
    salted = Window.partitionBy("lang", "salt").orderBy("h", "doc_id")
    some = ids.withColumn("salt", F.pmod("h", F.lit(SALTS))).withColumn("place", F.row_number().over(salted))
    some = some.where(F.col("place") <= per_language).drop("place")
    ranked = some.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    chosen = written(ranked.where(F.col("place") <= per_language).select("lang", "doc_id", "place"), "lang-chosen")
    found = chosen.select("lang").distinct().count()
    if found > LANGUAGES:
        raise ValueError(f"{found} languages to learn, at most {LANGUAGES}")
    return one_text_each(learnable.select("lang", "doc_id", "text").join(chosen, ["lang", "doc_id"]))


def fit(docs: DataFrame):
    """The model: (codes of the n-grams, landmark matrix, weights, languages), or None with nothing to learn from."""
    sample = written(training(docs), "lang-sample")

    def landmark_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = []
            for _, data, offsets in slices(batch.column("text")):
                for a, b in zip(offsets[:-1], offsets[1:]):
                    codes.append(np.unique(np.concatenate([grams(data[a:b], k) for k in range(1, LONGEST + 1)])).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("doc_id"), pa.array(codes, pa.binary())], ["lang", "doc_id", "codes"])

    shape = StructType([f for f in sample.schema if f.name in ("lang", "doc_id")]).add("codes", "binary")
    marks = sample.where(F.col("place") <= LANDMARKS).select("lang", "doc_id", "text").mapInArrow(landmark_grams, shape).collect()
    if not marks:
        return None
    sets = sorted(np.frombuffer(m["codes"], dtype=np.int32).tobytes() for m in marks)
    sets = [np.frombuffer(s, dtype=np.int32) for s in sets]
    codes = np.unique(np.concatenate(sets))
    landmarks = np.stack([np.isin(codes, s) for s in sets]).astype(np.float32)
    landmarks /= np.sqrt(np.maximum(1, landmarks.sum(axis=1)))[:, None]

    kernel, rows = features(
        sample.select("doc_id", "lang", "text"), lambda data, offsets: kernels(codes, landmarks, data, offsets)
    )
    languages = sorted({r["lang"] for r in rows})
    target = np.array([[1.0 if r["lang"] == x else 0.0 for x in languages] for r in rows])
    values, vectors = np.linalg.eigh((landmarks @ landmarks.T).astype(np.float64))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    z = np.c_[kernel @ root, np.ones(len(kernel))]
    balance = (1 / target.sum(axis=0))[target.argmax(axis=1)]
    balance = balance / balance.mean()
    solved = np.linalg.solve(z.T @ (balance[:, None] * z) + RIDGE * np.eye(z.shape[1]), z.T @ (balance[:, None] * target))
    weights = np.r_[root @ solved[:-1], solved[-1:]]
    return codes, landmarks, weights, languages


_TABLES: dict[bytes, np.ndarray] = {}


def _table(codes: np.ndarray) -> np.ndarray:
    """The column of each n-gram, by its code; one table is held by a Python worker."""
    key = codes.tobytes()
    if key not in _TABLES:
        table = np.full(_CODES, -1, dtype=np.int32)
        table[codes] = np.arange(len(codes), dtype=np.int32)
        _TABLES.clear()
        _TABLES[key] = table
    return _TABLES[key]


def kernels(codes: np.ndarray, landmarks: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Each text's values against the landmarks, so many texts at a time as ``CELLS`` of presence hold."""
    parts, step = [], max(1, CELLS // max(1, len(codes)))
    for first in range(0, len(offsets) - 1, step):
        ends = offsets[first : first + step + 1]
        held = presence(_table(codes), data[ends[0] : ends[-1]], ends - ends[0])
        parts.append((held @ landmarks.T) / np.sqrt(np.maximum(1, held.sum(axis=1)))[:, None])
    return np.concatenate(parts)


def identify(docs: DataFrame) -> DataFrame:
    """``doc`` (all columns), ``held_out``, ``lang_pred`` and ``score`` of every row.

    A text that is null or has no letter is ``und`` with score 0, and so is every
    text when there is nothing to learn from.  Of equal scores the first language
    by name is taken.  Rows that repeat are predicted alike; extra columns stay in
    the struct; an empty table gives an empty result.
    """
    model = fit(docs)
    rows = docs.select(
        packed(docs).alias("doc"), held_out().alias("held_out"), F.col("text").alias("text"), has_letter(F.col("text")).alias("letters")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            for first, data, offsets in slices(batch.column("text")):
                n = len(offsets) - 1
                told = letters[first : first + n]
                if model is None:
                    told = np.zeros(n, dtype=bool)
                else:
                    codes, landmarks, weights, languages = model
                    kernel = kernels(codes, landmarks, data, offsets)
                    values = kernel @ weights[:-1] + weights[-1]
                    best = values.argmax(axis=1)
                names += [languages[best[i]] if told[i] else UNKNOWN for i in range(n)]
                scores += [float(np.clip(values[i, best[i]], 0, 1)) if told[i] else 0.0 for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc", "held_out", "lang_pred", "score"],
            )

    schema = StructType(
        [
            rows.schema["doc"],
            StructField("held_out", BooleanType()),
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(documents(spark, sf_dir)).select(F.col("doc.doc_id").alias("doc_id"), "held_out", "lang_pred", "score")
