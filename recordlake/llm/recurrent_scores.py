"""LM scoring: the log-probability of every whole text under a gated recurrent model and under token counts.

1. The counts of all tokens of all training documents are a table, folded by task and by
   hash.  Its ``LOOKUP`` most frequent words travel with the tasks; all others are met by a join.
2. The network of ``gated_model`` knows the ``VOCABULARY`` most frequent words.  It is trained in
   ``ROUNDS`` rounds: the documents of a round are spread over tasks, every task trains a copy of the
   weights on its own, and the copies are averaged by the tokens they saw, in a tree of
   groups of ``FAN``.  Every training document takes part once, with its whole text.
3. Every text is scored whole, its state carried from window to window.  A word beyond the
   vocabulary has the probability of their class times its smoothed share in the counts
   of that class, which needs its count: known from the lookup, or from the join.

Tokens are words, A-Z lower-cased, by 64-bit hash, and one end per document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from recordlake.llm import gated_model
from recordlake.llm.common import documents, held_out, packed, written
from recordlake.llm.textkernel import slices, words

HELD_OUT_FOLDS = 10
SMOOTHING = 0.1
LOOKUP = 1 << 16
VOCABULARY = 1024
ROUNDS = 4
FAN = 32
#: The token that ends a document.
END = np.uint64(0x656E64)
_SLOT_BITS = 20
#: Bytes of text that are scored at once; one longer document is scored by itself.
PIECE = 12 << 20


class Lookup:
    """The most frequent words by hash, in order of frequency: places, counts, and the network's word of each."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, vocabulary: int):
        order = np.argsort(hashes)
        self.hashes, self.place = hashes[order], order
        self.logs = np.log10(counts[order] + SMOOTHING)
        self.vocabulary = vocabulary
        self.words = np.minimum(order, vocabulary)
        # One slot for each leading part of a hash; a slot that several words share is searched.
        slot = (self.hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        self.slots = np.full(1 << _SLOT_BITS, -1, dtype=np.int32)
        self.slots[slot] = np.arange(len(order))
        shared = np.bincount(slot, minlength=1 << _SLOT_BITS) > 1
        self.slots[shared] = -2

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash among the sorted ones, -1 for one that is not held."""
        at = self.slots[(hashes >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)].astype(np.int64)
        shared = np.flatnonzero(at == -2)
        at[shared] = np.minimum(np.searchsorted(self.hashes, hashes[shared]), len(self.hashes) - 1)
        at[at >= 0] = np.where(self.hashes[at[at >= 0]] == hashes[at >= 0], at[at >= 0], -1)
        return at


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens of some whole texts, and the offsets of the texts."""
    parts, sizes = [], []
    for _, data, offsets in slices(texts):
        hashes, first = words(data, offsets)
        counts = np.diff(first)
        ends = np.cumsum(counts + 1) - 1
        held = np.full(len(hashes) + len(counts), END, dtype=np.uint64)
        inside = np.ones(len(held), dtype=bool)
        inside[ends] = False
        held[inside] = hashes
        parts.append(held)
        sizes.append(counts + 1)
    if not parts:
        return np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in pieces of about ``PIECE`` bytes of text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = sizes[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(sizes, before + PIECE, side="right")))
        yield batch.slice(first, last - first)
        first = last


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in (piece for whole in batches for piece in _pieces(whole)):
        held, counts = np.unique(tokens(batch.column("text"))[0], return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(held.view(np.int64)), pa.array(counts, pa.int64())], ["hash", "n"])


def token_counts(docs: DataFrame) -> DataFrame:
    """``hash`` and ``n`` of every token of all training documents."""
    texts = docs.where(~held_out(folds=HELD_OUT_FOLDS)).select("text")
    return texts.mapInArrow(_count_rows, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))


def _network_words(lookup: Lookup, hashes: np.ndarray) -> np.ndarray:
    at = lookup.find(hashes)
    return np.where(at >= 0, lookup.words[at], lookup.vocabulary).astype(np.int32)


def rounds(docs: DataFrame) -> DataFrame:
    """``text``, whole, and ``round`` of every training document."""
    turn = F.pmod(F.xxhash64(F.lit(1), F.xxhash64("doc_id")), F.lit(ROUNDS)).cast("int")
    return docs.where(~held_out(folds=HELD_OUT_FOLDS)).select(F.coalesce("text", F.lit("")).alias("text"), turn.alias("round"))


def _train_rows(weights: gated_model.Weights, lookup: Lookup, start: int, turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer, part = gated_model.Trainer(weights, seed=turn), None
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            part = batch.column("part")[0].as_py() if part is None else part
            hashes, offsets = tokens(batch.column("text"))
            trainer.learn(_network_words(lookup, hashes), offsets, start)
        if trainer.tokens:
            blob = np.frombuffer(gated_model.packed(trainer.w), dtype=np.float32) * np.float32(trainer.tokens)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([float(trainer.tokens)]), pa.array([blob.tobytes()], pa.binary())], ["part", "n", "sums"]
            )

    return run


def _sums(rows: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(len(rows["sums"].iloc[0]) // 4, dtype=np.float32)
    for blob in rows["sums"]:
        total += np.frombuffer(blob, dtype=np.float32)
    return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN], "n": [rows["n"].sum()], "sums": [total.tobytes()]})


def averaged(copies: DataFrame, weights: gated_model.Weights) -> gated_model.Weights:
    """The mean of copies (``part``, ``n``, ``sums``), weighted by their tokens; at most ``FAN`` rows reach the driver."""
    copies = written(copies, "lm-copies")
    while (copies.agg(F.countDistinct("part")).first()[0] or 0) > FAN:
        copies = written(copies.groupBy(F.floor(F.col("part") / FAN)).applyInPandas(_sums, "part int, n double, sums binary"), "lm-copies")
    rows = sorted(copies.collect(), key=lambda r: (r["part"], r["n"]))
    if not rows:
        return weights
    total = sum(np.frombuffer(r["sums"], dtype=np.float32).astype(np.float64) for r in rows)
    return gated_model.unpacked(total / sum(r["n"] for r in rows), weights)


def train(docs: DataFrame, weights: gated_model.Weights, lookup: Lookup, start: int) -> gated_model.Weights:
    """The weights after all rounds."""
    for turn in range(ROUNDS):
        rows = rounds(docs).where(F.col("round") == turn).select("text", F.spark_partition_id().alias("part"))
        copies = rows.mapInArrow(_train_rows(weights, lookup, start, turn), "part int, n double, sums binary")
        weights = averaged(copies, weights)
    return weights


def _score_rows(weights: gated_model.Weights, lookup: Lookup, start: int, shape: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (piece for whole in batches for piece in _pieces(whole)):
            hashes, offsets = tokens(batch.column("text"))
            doc = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            at = lookup.find(hashes)
            known = at >= 0
            network = np.where(known, lookup.words[at], lookup.vocabulary).astype(np.int32)
            log = np.where(known, lookup.logs[at], 0.0)
            beyond = network == lookup.vocabulary
            by_doc = lambda v, where: np.bincount(doc[where], v[where], minlength=batch.num_rows).astype(np.float64)
            ones = np.ones(len(doc))
            # The words the lookup lacks, by document, each once.
            rest = np.flatnonzero(~known)
            order = rest[np.lexsort((hashes[rest], doc[rest]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (hashes[order][1:] != hashes[order][:-1]) | (doc[order][1:] != doc[order][:-1])
            first = np.flatnonzero(new)
            tail = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc[order][first], np.arange(batch.num_rows + 1)), pa.int32()),
                pa.StructArray.from_arrays(
                    [pa.array(hashes[order][first].view(np.int64)), pa.array(np.diff(first, append=len(order)), pa.int32())], ["hash", "tf"]
                ),
            )
            sums = [
                pa.array(np.diff(offsets), pa.int64()),
                pa.array(by_doc(ones, known), pa.float64()).cast(pa.int64()),
                pa.array(by_doc(ones, beyond), pa.float64()).cast(pa.int64()),
                pa.array(by_doc(log, known)),
                pa.array(by_doc(log, known & beyond)),
                pa.array(gated_model.score(weights, network, offsets, start) / math.log(10)),
            ]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("rid", "row", "held_out")), *sums, tail], [f.name for f in shape])

    return run


def score_texts(docs: DataFrame) -> DataFrame:
    """Every row as ``row`` (all columns but the text), with ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    A null or empty text is its end alone.  A row without an id is held out.  Rows that
    repeat all count in training and get equal scores.  With nothing to learn from every
    token has the share that smoothing leaves.  Extra columns of any name stay in the
    struct; an empty table gives an empty result.
    """
    counts = written(token_counts(docs), "lm-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    end_count = counts.where(F.col("hash") == int(END.view(np.int64))).first()
    top = counts.where(F.col("hash") != int(END.view(np.int64))).orderBy(F.col("n").desc(), "hash").limit(LOOKUP - 1).collect()
    held = np.array([int(END), *(r["hash"] for r in top)], dtype=np.int64).view(np.uint64)
    held_counts = np.array([end_count["n"] if end_count else 0, *(r["n"] for r in top)], dtype=np.float64)
    lookup = Lookup(held, held_counts, VOCABULARY)
    network_counts = held_counts[:VOCABULARY]
    rare = float(total - network_counts.sum())
    # Places that no word has, in a small corpus, are words of count 0.
    weights = gated_model.fresh(np.concatenate([network_counts, np.zeros(VOCABULARY - len(network_counts))]), rare)
    weights = train(docs, weights, lookup, start=0)

    kept = docs.drop("text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), packed(kept).alias("row"), held_out(folds=HELD_OUT_FOLDS).alias("held_out"), F.col("text")
    )
    pair = ArrayType(StructType([StructField("hash", LongType()), StructField("tf", IntegerType())]))
    shape = StructType(
        [
            StructField("rid", LongType()),
            rows.schema["row"],
            StructField("held_out", BooleanType()),
            *(StructField(c, LongType()) for c in ("n_tokens", "n_held", "n_beyond")),
            *(StructField(c, DoubleType()) for c in ("held_log", "beyond_log", "network")),
            StructField("tail", pair),
        ]
    )
    scored = written(rows.mapInArrow(_score_rows(weights, lookup, 0, shape), shape), "lm-rows")

    # What the lookup lacks: each document's other words meet their counts.
    tail = scored.select("rid", F.inline("tail")).join(counts, "hash")
    tail = tail.groupBy("rid").agg(F.sum("tf").alias("found"), F.sum(F.col("tf") * F.log10(F.col("n") + SMOOTHING)).alias("found_log"))
    met = scored.drop("tail").join(tail, "rid", "left")
    found = F.coalesce("found", F.lit(0))
    unseen = (F.col("n_tokens") - F.col("n_held") - found) * math.log10(SMOOTHING)
    rest = F.coalesce("found_log", F.lit(0.0)) + unseen
    all_share = math.log10(total + SMOOTHING * (distinct + 1))
    words_known = int((network_counts > 0).sum())
    rare_share = math.log10(rare + SMOOTHING * (distinct - words_known + 1))
    return met.select(
        "row",
        "held_out",
        "n_tokens",
        _known(F.col("n_held"), found, F.col("n_tokens"), bool(end_count)).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("held_log") + rest - F.col("n_tokens") * all_share).alias("base_score"),
        (F.col("network") + F.col("beyond_log") + rest - F.col("n_beyond") * rare_share).alias("score"),
    )


def _known(held: Column, found: Column, tokens: Column, learned: bool) -> Column:
    """Tokens that training documents hold; the end is in the lookup even where no document was learned from."""
    return (held + found).cast("long") if learned else F.when(tokens >= 0, F.lit(0)).cast("long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = score_texts(documents(spark, sf_dir).select("doc_id", "text"))
    columns = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    return told.select(F.col("row.doc_id").alias("doc_id"), *columns)
