"""Benchmark decontamination by pigeonhole edit matching.

An item may occur in a document with up to k edits, k being one for every
``CHARS_PER_EDIT`` of its characters, and none for items under ``SHORT``.  Cut into k + 1 pieces, at least one piece
of such an occurrence is untouched: an exact search for all pieces, by one
automaton, gives every place worth a look, and Myers' bit-parallel edit distance
decides there.  Texts are compared in lower case with runs of white space as one space.

Items are worked on in blocks of at most ``BLOCK_CHARS`` characters, so that what
a task holds is bounded; every document meets every block.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from recordlake.llm.common import documents, packed, written

CHARS_PER_EDIT = 16
BLOCK_CHARS = 4_000_000
#: Items shorter than this are looked for as they are, with no edits, and between word boundaries only.
SHORT = 32


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"\s+", " "))


def budget(item: str) -> int:
    return 0 if len(item) < SHORT else len(item) // CHARS_PER_EDIT


def between_words(text: str, a: int, b: int) -> bool:
    """True if no word goes on across either end of ``text[a:b]``."""
    inside = lambda i: text[i - 1].isalnum() and text[i].isalnum()
    return not ((a > 0 and inside(a)) or (b < len(text) and inside(b)))


def pieces(item: str) -> list[tuple[int, str]]:
    """(start, piece) of the budget-plus-one pieces of an item, of lengths that differ by one at most."""
    n = budget(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | (1 << i)
    return out


def occurs(peq: dict[str, int], m: int, text: str, k: int) -> bool:
    """True if some part of ``text`` is within ``k`` edits of the item of length ``m`` (Myers, bit-parallel)."""
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, distance = full, 0, m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & last:
            distance += 1
        elif mh & last:
            distance -= 1
        if distance <= k:
            return True
        ph = (ph << 1) & full
        mh = (mh << 1) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
    return False


class Matcher:
    """The automaton of all pieces of a block of items, and the items' bit masks."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = items
        self.masks = [masks(t) for _, t in items]
        self.automaton = ahocorasick.Automaton()
        held: dict[str, list[tuple[int, int]]] = {}
        for i, (_, text) in enumerate(items):
            for start, piece in pieces(text):
                held.setdefault(piece, []).append((i, start))
        for piece, places in held.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def find(self, text: str) -> list[int]:
        """The sorted ids of the items that occur in ``text``."""
        found: set[int] = set()
        looked: dict[int, list[int]] = {}
        for end, (size, places) in self.automaton.iter(text):
            for i, start in places:
                if len(self.items[i][1]) < SHORT:
                    if between_words(text, end - size + 1, end + 1):
                        found.add(i)
                elif i not in found:
                    looked.setdefault(i, []).append(end - size + 1 - start)
        for i, starts in looked.items():
            item, m = self.items[i][1], len(self.items[i][1])
            k = budget(item)
            done = None
            for at in sorted(set(starts)):
                a, b = max(0, at - k), min(len(text), at + m + k)
                if done is not None and b <= done:
                    continue
                done = b
                if text.find(item, a, b) >= 0 or occurs(self.masks[i], m, text[a:b], k):
                    found.add(i)
                    break
        return sorted({self.items[i][0] for i in found})


def _items(benchmark: DataFrame) -> DataFrame:
    """``item_id`` and ``item``, the normal text, of the items looked for."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), normal(F.col("text")).alias("item"))
    return rows.where(F.col("item_id").isNotNull() & (F.col("item") != "")).distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every row as ``doc`` (all columns) with ``item_ids``, the sorted ids of the benchmark items found in its text.

    A null or empty text holds no item.  Items without an id and items without text
    are not looked for.  An item of fewer than ``SHORT`` characters must stand in the text as it
    is, and not as part of longer words.
    Items that repeat are each told; rows that repeat get the same answer.  An
    empty benchmark finds nothing, an empty table gives an empty result.
    """
    items = written(_items(benchmark), "benchmark-items")
    chars = items.agg(F.sum(F.length("item"))).first()[0] or 0
    n = max(1, -(-2 * chars // BLOCK_CHARS))
    rows = docs.select(packed(docs).alias("doc"), F.expr("CAST(array() AS array<bigint>)").alias("item_ids"))
    shape = StructType([rows.schema["doc"], StructField("item_ids", ArrayType(LongType()))])
    for block in range(n if chars else 0):
        part = items.where(F.pmod(F.xxhash64("item_id", "item"), F.lit(n)) == block)
        held = sorted((r["item_id"], r["item"]) for r in part.collect())
        if held:
            rows = rows.withColumn("text", normal(F.col("doc.text"))).mapInArrow(_search(held), shape)
    return rows


def _search(held: list[tuple[int, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(held)
        for batch in batches:
            ids = [
                sorted({*before, *matcher.find(text)})
                for before, text in zip(batch.column("item_ids").to_pylist(), (t.as_py() for t in batch.column("text")))
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(ids, pa.list_(pa.int64()))], ["doc", "item_ids"])

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items."""
    found = contaminated(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size("item_ids") > 0).select(F.col("doc.doc_id").alias("doc_id"), "item_ids")
