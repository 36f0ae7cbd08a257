"""What the text classifiers share: folds, bounded samples of labelled rows, features of whole texts, batched scores.

Features are computed from whole texts in Arrow batches; a batch is worked on in
slices of about a megabyte, so memory does not depend on how many rows a batch
holds.  A model is small (a few thousand numbers) and travels with the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, IntegerType, StructField, StructType

from recordlake.llm.common import held_out, packed
from recordlake.llm.textkernel import slices, words

#: Labelled rows a model is fitted on, per class; chosen by a hash of the id.
SAMPLE_PER_CLASS = 2000

_WORD_BYTES = np.full(256, 0x20, dtype=np.uint8)
for _first, _last in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _WORD_BYTES[_first:_last] = np.arange(_first, _last)


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``textkernel.words``, with ASCII punctuation taken for space."""
    return words(_WORD_BYTES[data], offsets)


def word_hashes(terms: list[str]) -> np.ndarray:
    """The hash that ``letter_words`` gives each of some single words."""
    joined = [t.encode() for t in terms]
    offsets = np.cumsum([0, *map(len, joined)])
    hashes, _ = letter_words(np.frombuffer(b"".join(joined), dtype=np.uint8), offsets)
    if len(hashes) != len(terms):
        raise ValueError("every term must be one word")
    return hashes


def places_in(vocabulary: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """The place of each hash in the sorted ``vocabulary``, -1 for one it lacks."""
    if not len(vocabulary):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int = SAMPLE_PER_CLASS) -> DataFrame:
    """``doc_id``, ``text`` and ``y`` of at most ``per_class`` rows of each of the classes 0 and 1, none of them held out.

    Of a document labelled twice the largest label counts; labels that are null or neither 0 nor 1 are left out.
    Of rows that repeat an id the least text counts, so the bound holds whatever repeats.
    """
    known = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("y")).where("y IN (0, 1) AND doc_id IS NOT NULL")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("y").alias("y"))
    order = [F.xxhash64(F.col("doc_id")), F.col("doc_id")]
    texts = docs.select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    chosen = [known.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return one_text_each(texts.join(chosen[0].unionByName(chosen[1]), "doc_id"))


def one_text_each(rows: DataFrame) -> DataFrame:
    """``rows`` with one row for each of their other columns' values: that of the least text, folded by task first."""
    return rows.groupBy(*[c for c in rows.columns if c != "text"]).agg(F.min("text").alias("text"))


def features(sample: DataFrame, make: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, list]:
    """The feature matrix of a bounded sample, by id, with the rest of its columns as rows."""
    rest = [c for c in sample.columns if c != "text"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = [make(data, offsets).astype(np.float32) for _, data, offsets in slices(batch.column("text"))]
            if cells:
                packed_rows = pa.array([r.tobytes() for m in cells for r in m], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [packed_rows], [*rest, "features"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.schema if f.name != "text")
    got = sample.mapInArrow(rows, f"{kinds}, features binary").collect()
    got.sort(key=lambda r: tuple(str(r[c]) for c in rest) + (r["features"],))
    if not got:
        return np.zeros((0, 0)), []
    return np.stack([np.frombuffer(r["features"], dtype=np.float32) for r in got]).astype(np.float64), got


def scored(docs: DataFrame, score: Callable[[np.ndarray, np.ndarray], np.ndarray], threshold: float) -> DataFrame:
    """``doc`` (all columns), ``held_out``, ``score`` and ``predicted`` of every row.

    ``score`` gets the joined bytes of several whole texts and their offsets.
    """
    rows = docs.select(packed(docs).alias("doc"), held_out().alias("held_out"), F.col("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [score(data, offsets) for _, data, offsets in slices(batch.column("text"))]
            values = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"),
                    batch.column("held_out"),
                    pa.array(values, pa.float64()),
                    pa.array((values >= threshold).astype(np.int32), pa.int32()),
                ],
                ["doc", "held_out", "score", "predicted"],
            )

    schema = StructType(
        [
            rows.schema["doc"],
            StructField("held_out", BooleanType()),
            StructField("score", DoubleType()),
            StructField("predicted", IntegerType()),
        ]
    )
    return rows.mapInArrow(run, schema)


def digest(df: DataFrame) -> DataFrame:
    """The contract's columns of a scored table."""
    return df.select(F.col("doc.doc_id").alias("doc_id"), "held_out", "score", "predicted")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def has_letter(text: Column) -> Column:
    return F.coalesce(F.rlike(text, F.lit(r"\p{L}")), F.lit(False))
