"""N-gram Jaccard join: a grouped prefix join on word shingles, exact, and the classes its links make.

A document's set are its distinct five-word shingles.  Shingles are ordered from rare to
frequent, by a table of ``BUCKETS`` counts that all documents add to, and then by
hash.  Two sets of similarity 0.75 or more share a shingle among the first
n - ceil(0.75 n) + 1 of either, its prefix.

1. Documents of equal sets are one set; sets of equal prefix and size are one group.
2. Groups that share a prefix shingle are neighbours in its list.  First only
   neighbours in a row are expanded to their member sets and verified, which is linear in the
   size of any list and already joins large groups of near copies.
3. Then, of each list that still holds several classes, pairs of groups of
   different classes are filtered by size and place, expanded and verified.
   No pair within a class is ever made, and none that could still link two classes is left out.

Before whole sets meet, pairs are judged by sketches: a bit for every shingle, at eight bits or more a
shingle.  A bit of one set that the other lacks is a shingle that the other lacks, so a pair whose bits leave too
little in common cannot link; only what passes is shipped and counted whole.

Shingles, groups and prefixes go by 64-bit hashes, sets and texts by 128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordlake.llm.common import discard, documents, packed, written
from recordlake.llm.components import components
from recordlake.llm.textkernel import shingles, slices

WORDS = 5
#: A link needs intersection * 100 >= PERCENT * union.
PERCENT = 75
BUCKETS = 1 << 18
#: Bits that tell which keys a join may need, however many there are; and bits in one row of them.
SLOTS = 1 << 23
_SLOTS_A_ROW = 1 << 15


def _prefix(held: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The first shingles of a set in the order from rare to frequent."""
    order = np.lexsort((held, counts[(held % np.uint64(BUCKETS)).astype(np.int64)]))
    return held[order[: prefix_size(len(held))]]


def _group(prefix: np.ndarray, n: int) -> int:
    """The group of a set: the hash of its prefix and its size."""
    return int.from_bytes(hashlib.md5(prefix.tobytes() + n.to_bytes(8, "little")).digest()[:8], "little", signed=True)


def sketch(held: np.ndarray) -> bytes:
    """A bit for every shingle, by its lowest bits, in a power of two of at least eight bits a shingle."""
    size = 1 << max(6, int(8 * len(held) - 1).bit_length())
    bits = np.zeros(size, dtype=bool)
    bits[(held & np.uint64(size - 1)).astype(np.int64)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _may_link(n_a: int, a: bytes, n_b: int, b: bytes) -> bool:
    """False only for sketches of two sets that cannot link."""
    a, b = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    size = min(len(a), len(b))
    a, b = (np.bitwise_or.reduce(x.reshape(-1, size), axis=0) for x in (a, b))
    lacks_a, lacks_b = int(np.bitwise_count(b & ~a).sum()), int(np.bitwise_count(a & ~b).sum())
    most = min(n_a - lacks_b, n_b - lacks_a)
    return (100 + PERCENT) * most >= PERCENT * (n_a + n_b)


def _row_rows(counts: np.ndarray):
    """Of every text its size, set key, group, prefix and sketch; null where it has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, data, offsets in slices(batch.column("text")):
                sizes, keys, gids, prefixes, sketches = [], [], [], [], []
                for held in shingles(data, offsets, WORDS):
                    sizes.append(len(held))
                    prefix = _prefix(held, counts) if len(held) else None
                    prefixes.append(prefix if prefix is None else prefix.view(np.int64))
                    keys.append(hashlib.md5(held.tobytes()).digest() if len(held) else None)
                    gids.append(_group(prefix, len(held)) if len(held) else None)
                    sketches.append(sketch(held) if len(held) else None)
                kinds = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
                columns = [pa.array(c, k) for c, k in zip((sizes, keys, gids, prefixes, sketches), kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, len(sizes)) for c in ("doc_id", "text_key")), *columns],
                    ["doc_id", "text_key", "n", "set_key", "gid", "prefix", "sketch"],
                )
                at += len(sizes)

    return run


def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs (``a``, ``b``) that their sketches let through."""
    for batch in batches:
        cells = [batch.column(c).to_pylist() for c in ("n_a", "sketch_a", "n_b", "sketch_b")]
        kept = pa.array([_may_link(*cell) for cell in zip(*cells)], pa.bool_())
        yield batch.select(["a", "b"]).filter(kept)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        for _, data, offsets in slices(batch.column("text")):
            for held in shingles(data, offsets, WORDS):
                np.add.at(counts, (held % np.uint64(BUCKETS)).astype(np.int64), 1)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some])], ["bucket", "n"])


def prefix_size(n):
    """How many first shingles of a set of size ``n`` a linked set must share one of."""
    return n - (PERCENT * n + 99) // 100 + 1


def _whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        held = [s.view(np.int64) for _, data, offsets in slices(batch.column("text")) for s in shingles(data, offsets, WORDS)]
        yield pa.RecordBatch.from_arrays([batch.column("set_key"), pa.array(held, pa.list_(pa.int64()))], ["set_key", "held"])


def _close(a: Column, b: Column) -> Column:
    """Sizes that allow a link."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _maybe(rows: DataFrame, key: list[str], needed: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``needed``, before a shuffle ships them; none of the others is lost."""
    slot = F.xxhash64(*key).bitwiseAND(F.lit(SLOTS - 1))
    row, place = F.floor(slot / _SLOTS_A_ROW).alias("_row"), (slot % _SLOTS_A_ROW).alias("_place")
    bits = written(needed.select(row, place).groupBy("_row").agg(F.bitmap_construct_agg("_place").alias("_bits")), "jaccard-bits")
    met = rows.select("*", row, place).join(bits, "_row")
    byte = F.conv(F.hex(F.expr("substring(_bits, int(_place div 8) + 1, 1)")), 16, 10).cast("int")
    return met.where(byte.bitwiseAND(F.expr("shiftleft(1, int(_place % 8))")) != 0).select(*rows.columns)


def _verified(pairs: DataFrame, keyed: DataFrame, chosen: DataFrame) -> DataFrame:
    """The ``pairs`` (``a``, ``b``: set keys) that link: by their sketches first, then by their whole sets."""
    pairs = candidates = written(pairs.distinct(), "jaccard-candidates")
    ends = lambda: pairs.select(F.col("a").alias("set_key")).unionByName(pairs.select(F.col("b").alias("set_key")))
    some = _maybe(chosen, ["set_key"], ends())
    side = lambda s: some.select(F.col("set_key").alias(s), F.col("n").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    told = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "sketch_a", "n_b", "sketch_b")
    pairs = written(told.mapInArrow(_sketch_rows, "a binary, b binary"), "jaccard-pairs")
    needed = ends().distinct()
    rows = written(_maybe(chosen, ["set_key"], needed).join(needed, "set_key").select("set_key", "doc_id", "text_key"), "jaccard-needed")
    same = F.col("k.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("k.text_key") == F.col("c.text_key"))
    texts = _maybe(keyed, ["text_key"], rows).alias("k").join(rows.alias("c"), same).select("c.set_key", "k.text")
    held = written(texts.mapInArrow(_whole_rows, "set_key binary, held array<bigint>"), "jaccard-sets")
    met = pairs.join(held.select(F.col("set_key").alias("a"), F.col("held").alias("x")), "a")
    met = met.join(held.select(F.col("set_key").alias("b"), F.col("held").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    linked = met.where(100 * same >= PERCENT * (F.size("x") + F.size("y") - same))
    links = written(linked.select("a", "b").distinct(), "jaccard-links")
    discard(candidates, pairs, rows, held)
    return links


def classes(rows: DataFrame) -> DataFrame:
    """``rows`` (``doc_id``, ``text``) as ``doc_id``, ``text_key``, ``n``, ``set_key`` and ``class``: a set key, the same for all reachable."""
    keyed = rows.select("doc_id", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("text_key"), "text")
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.select("text").mapInArrow(_count_rows, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r["bucket"]] = r["n"]
    id_type = rows.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {id_type}, text_key binary, n long, set_key binary, gid long, prefix array<bigint>, sketch binary"
    wide = written(keyed.mapInArrow(_row_rows(counts), shape), "jaccard-wide")
    sets = written(wide.select("doc_id", "text_key", "n", "set_key"), "jaccard-rows")
    some = F.min(F.struct("doc_id", "text_key")).alias("one")
    chosen = wide.where("set_key IS NOT NULL").groupBy("set_key").agg(some, F.first("gid").alias("gid"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    chosen = written(chosen.select("set_key", "gid", "n", "sketch", "one.*"), "jaccard-chosen")
    members = chosen.select("gid", "set_key")
    groups = wide.where("gid IS NOT NULL").groupBy("gid").agg(F.first("n").cast("int").alias("n"), F.first("prefix").alias("prefix"))
    # Every shingle with the one before it in the prefix; the first has none.
    linked = F.transform("prefix", lambda t, i: F.struct(t.alias("token"), F.get(F.col("prefix"), i - 1).alias("before")))
    tokens = groups.select("gid", "n", F.posexplode(linked).alias("pos", "at")).select("gid", "n", "pos", "at.*")
    lists = Window.partitionBy("token").orderBy("n", "gid")
    hits = tokens.select(
        "token", "before", "gid", "n", "pos", F.lag(F.struct("gid", "n")).over(lists).alias("prev"), F.lead("gid").over(lists).alias("next")
    ).where("prev IS NOT NULL OR next IS NOT NULL")
    hits = written(hits, "jaccard-hits")
    discard(wide)

    # Neighbours in a row, and members of one group in a row.
    leaders = members.groupBy("gid").agg(F.min("set_key").alias("set_key"))
    leader = lambda gid, name: leaders.select(F.col("gid").alias(gid), F.col("set_key").alias(name))
    near = hits.where(F.col("prev").isNotNull() & _close(F.col("n"), F.col("prev.n")))
    near = near.select(F.col("prev.gid").alias("ga"), F.col("gid").alias("gb")).distinct()
    near = near.join(leader("ga", "a"), "ga").join(leader("gb", "b"), "gb").select("a", "b")
    inside = members.withColumn("before", F.lag("set_key").over(Window.partitionBy("gid").orderBy("set_key")))
    inside = inside.where("before IS NOT NULL").select(F.col("before").alias("a"), F.col("set_key").alias("b"))
    links = _verified(near.unionByName(inside), keyed, chosen)
    first = written(components(links), "jaccard-classes")

    # Pairs of groups, and of members of one group, whose classes differ.
    known = members.join(first.select(F.col("node").alias("set_key"), "component"), "set_key", "left")
    known = written(known.select("gid", "set_key", F.coalesce("component", "set_key").alias("class")), "jaccard-known")
    listed = hits.select("token", "before", "gid", "n", "pos").join(known.select("gid", "class").distinct(), "gid")
    mixed = listed.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("token")
    listed = written(listed.join(mixed, "token"), "jaccard-listed")
    # Laid out by shingle once: the classes of a list and their pairs are then made where the list is.
    here = listed.select("token", "class", "n", "pos").repartition("token").groupBy("token", "class").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("pos").alias("pos"))
    side = lambda df, s: df.select("token", *[F.col(c).alias(f"{c}_{s}") for c in df.columns if c != "token"])
    # Of two linked sets the first shingle that both prefixes hold leaves, in each set from its place on, the overlap
    # that the link needs.  So the test may be made at every shared shingle, and for classes by their extremes.
    room = lambda most, pos, other: (100 + PERCENT) * F.col(pos) <= 100 * F.col(most) - PERCENT * F.col(other)
    fits = (100 * F.col("most_a") >= PERCENT * F.col("least_b")) & (100 * F.col("most_b") >= PERCENT * F.col("least_a"))
    fits &= room("most_a", "pos_a", "least_b") & room("most_b", "pos_b", "least_a")
    other = side(here, "b").withColumnRenamed("token", "token_b")
    kinds = side(here, "a").join(other, (F.col("token") == F.col("token_b")) & (F.col("class_a") < F.col("class_b")) & fits)
    kinds = written(kinds.select("token", "class_a", "class_b"), "jaccard-kinds")
    met = kinds.select("token", F.col("class_a").alias("class")).unionByName(kinds.select("token", F.col("class_b").alias("class")))
    fit = _maybe(listed, ["token", "class"], met)
    apart = kinds.join(side(fit, "a"), ["token", "class_a"]).join(side(fit, "b"), ["token", "class_b"])
    # Two prefixes that also share the shingle before this one meet there, with more room: each run of shared shingles is met once.
    first_of_run = F.coalesce(F.col("before_a") != F.col("before_b"), F.lit(True))
    apart = apart.where(first_of_run & _close(F.col("n_a"), F.col("n_b")) & room("n_a", "pos_a", "n_b") & room("n_b", "pos_b", "n_a"))
    found = apart.select("gid_a", "class_a", "gid_b", "class_b").distinct()
    of = lambda s: known.select(F.col("gid").alias(f"gid_{s}"), F.col("set_key").alias(s), F.col("class").alias(f"class_{s}"))
    apart = found.join(of("a"), ["gid_a", "class_a"]).join(of("b"), ["gid_b", "class_b"]).select("a", "b")
    split = known.groupBy("gid").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo <> hi").select("gid")
    inner = known.join(split, "gid")
    inner = inner.select("gid", F.col("set_key").alias("a"), F.col("class").alias("ca")).join(
        inner.select("gid", F.col("set_key").alias("b"), F.col("class").alias("cb")), "gid"
    )
    more = _verified(apart.unionByName(inner.where("ca < cb").select("a", "b")), keyed, chosen)
    discard(hits, listed, kinds, known, first)
    last = written(components(links.unionByName(more)), "jaccard-classes")
    discard(links, more, chosen)
    told = sets.join(last.select(F.col("node").alias("set_key"), "component"), "set_key", "left")
    return told.select("doc_id", "text_key", "n", "set_key", F.coalesce("component", "set_key").alias("class"))


def _joined(docs: DataFrame) -> DataFrame:
    """What ``join_similar`` gives, with the ``class`` of every row: null for rows without words."""
    told = written(classes(docs.select("doc_id", "text")), "jaccard-told")
    least = told.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("least"))
    met = told.join(least, "class", "left")
    one = F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    return met.select("doc_id", F.col("n").alias("n_shingles"), one.alias("component_id"), "text_key", "class")


def join_similar(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (the least id reachable) and ``text_key`` of every row.

    A null or empty text, or one without words, has size 0, links with nothing and
    is its own component.  A text of fewer than five words is one shingle.  Rows
    that repeat are linked rows; a null id is never the least while there is
    another.  Classes that share their least id, or have none, share a
    ``component_id`` without being linked.  Extra columns are not looked at; an
    empty table gives an empty result.
    """
    return _joined(docs).drop("class")


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: of the least id, and of rows of that id the one of least text hash.

    A null id is the least only of a class that has no other.  Rows without words
    are kept, all of them.
    """
    joined = _joined(docs)
    least = F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "text_key"))
    chosen = joined.where("class IS NOT NULL").groupBy("class").agg(least.alias("one"))
    told = F.unhex(F.md5(F.coalesce(F.col("doc.text"), F.lit("")).cast("binary")))
    rows = docs.select(packed(docs).alias("doc")).select("doc", F.col("doc.doc_id").alias("id"), told.alias("key"))
    first = chosen.select(F.col("one.doc_id").alias("id1"), F.col("one.text_key").alias("key1"))
    kept = rows.join(first, F.col("id").eqNullSafe(F.col("id1")) & (F.col("key") == F.col("key1")), "left_semi")
    kept = kept.dropDuplicates(["id", "key"])
    wordless = written(joined.where("n_shingles = 0").select(F.col("doc_id").alias("id1"), F.col("text_key").alias("key1")).distinct(), "jaccard-wordless")
    bare = rows.join(wordless, F.col("id").eqNullSafe(F.col("id1")) & (F.col("key") == F.col("key1")), "left_semi")
    return kept.unionByName(bare).select("doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_similar(documents(spark, sf_dir)).drop("text_key")
