"""Substring dedup: bytes covered by a 400-byte string that starts anywhere else too are removed.

A sorted table of suffixes brings equal strings side by side.  Not every one of the corpus' suffixes can be
shipped, so those that are sorted start at places chosen by content: of the ``GRAM``-byte grams of a
400-byte string the one of least hash is its anchor.  Equal strings have their anchor at the same place, so
only strings of equal anchors need comparing, and all the starts that share one anchor occurrence are a run.

1. Each run is told by the hash of its anchor and the hash of all bytes that its strings cover.
   Where a run occurs again as a whole, all of its strings are repeated, and nothing but two hashes has
   moved.  That settles exact copies and the inside of shared passages, and folds them to one suffix each.
2. The suffixes of anchors that are met in several ways are ties: their bytes are fetched, on both sides
   of the anchor, and laid out in ranges of their leading bytes by splitters that Spark samples.
3. Each bucket sorts its suffixes by multikey quicksort, and the bytes before them, read leftwards, likewise.
   Neighbours that share 400 - o bytes to the right, and o to the left, hold one string that starts o bytes
   before the anchor: in the order of suffixes the first are in one row, and the second tell them apart.
4. Only a string whose bytes to the right are those of the first or the last suffix of a bucket can go on
   in another bucket.  These are compared across boundaries by hash, with counts folded in each bucket first.
5. Every document meets its repeated starts, and its bytes are cut.

Splitters take in the bytes on both sides, so an anchor that a third of all documents share is spread over
as many buckets as its different surroundings need.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from recordlake.llm.common import discard, documents, packed, written
from recordlake.llm.textkernel import rolling, slices, span_hashes

WIDTH = 400
GRAM = 64
#: Grams in a string.
_REACH = WIDTH - GRAM + 1
#: Most bytes of a string before its anchor.
_BEFORE = WIDTH - GRAM
#: Suffixes in a bucket, which is sorted in memory (about 800 bytes each).
BUCKET = 20_000
#: Segments of a sort that are as small as this are sorted at once.
_SMALL = 24
#: Starts worked on at once: a start and the hash of its gram share 64 bits.
_CHUNK = (1 << 20) - WIDTH


def _key(df: DataFrame) -> Column:
    """A document is its id and its text, so that a row that repeats both shares its answer."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return F.unhex(F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).cast("binary"), F.lit("\n").cast("binary"), text)))


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` values in a row."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def anchors(hashes: np.ndarray) -> np.ndarray:
    """For every start of a string the place of its anchor: the least hash, the first of equal ones."""
    out = []
    for first in range(0, max(0, len(hashes) - _REACH + 1), _CHUNK):
        part = hashes[first : first + _CHUNK + _REACH - 1]
        both = (part >> np.uint64(20) << np.uint64(20)) | np.arange(len(part), dtype=np.uint64)
        least = _sliding_least(both, _REACH)
        out.append((least & np.uint64((1 << 20) - 1)).astype(np.int64) + first)
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(document, first start, last start, place of the anchor, its hash, hash of all bytes covered) of every run of starts."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    if len(data) < WIDTH:
        return none
    hashes = rolling(data, GRAM)
    place = anchors(hashes)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(place)]
    valid = np.arange(len(place)) + WIDTH <= offsets[1:][doc]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    first, last = first[valid[first]], last[valid[first]]
    owner, anchor = doc[first], place[first]
    whole = span_hashes(data, first, last + WIDTH) ^ ((anchor - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return owner, first - offsets[owner], last - offsets[owner], anchor - offsets[owner], hashes[anchor].view(np.int64), whole.view(np.int64)


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column("key")
        for at, data, offsets in slices(batch.column("text")):
            owner, *found = runs(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [keys.take(pa.array(owner + at)), *(pa.array(x, pa.int64()) for x in found)],
                ["key", "first", "last", "place", "anchor", "whole"],
            )


_SUFFIXES = "run long, n int, after binary, before binary, least int, most int"


def _suffix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The suffix at the anchor of every run to be opened, with the bytes before it read leftwards.

    Its strings start ``least`` to ``most`` bytes before the anchor.
    """
    shape = pa.schema([("run", pa.int64()), ("n", pa.int32()), ("after", pa.binary()), ("before", pa.binary()), ("least", pa.int32()), ("most", pa.int32())])
    for batch in batches:
        opened, texts = batch.column("opened"), batch.column("text")
        for i, text in enumerate(texts):
            text = text.as_py()
            out = []
            for r in opened[i].as_py():
                first, last, place = r["first"], r["last"], r["place"]
                after, before = text[place : last + WIDTH], text[first:place][::-1]
                out.append((r["run"], min(r["n"], 2), after, before, place - last, place - first))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), shape)], schema=shape)


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    """A row of ``width`` bytes for each part, with zeros behind it."""
    return np.frombuffer(b"".join(p.ljust(width, b"\0") for p in parts), dtype=np.uint8).reshape(len(parts), width)


def multikey_quicksort(rows: np.ndarray) -> np.ndarray:
    """The order of rows of bytes: split in three by one word of eight bytes, the equal ones by the next."""
    keys = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    order = np.arange(len(rows))
    todo = [(0, len(rows), 0)]
    while todo:
        lo, hi, depth = todo.pop()
        if hi - lo < 2 or depth == keys.shape[1]:
            continue
        part = order[lo:hi]
        if hi - lo <= _SMALL:
            part[:] = sorted(part, key=lambda i: rows[i, 8 * depth :].tobytes())
            continue
        word = keys[part, depth]
        pivot = np.sort(word[:: max(1, len(word) // 9)])[min(4, (len(word) - 1) // 2)]
        low, same, high = part[word < pivot], part[word == pivot], part[word > pivot]
        order[lo:hi] = np.concatenate([low, same, high])
        a, b = lo + len(low), hi - len(high)
        todo += [(lo, a, depth), (a, b, depth + 1), (b, hi, depth)]
    return order


def shared_bytes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """How many leading bytes each row of the order shares with the one before it; -1 for the first."""
    out = np.full(len(order), -1, dtype=np.int64)
    for a in range(1, len(order), 4096):
        b = min(len(order), a + 4096)
        other = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        out[a:b] = np.where(other.any(axis=1), other.argmax(axis=1), rows.shape[1])
    return out


def _classes(order: np.ndarray, shared: np.ndarray, size: int) -> np.ndarray:
    """For each row the number of its class of rows that share ``size`` leading bytes."""
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(shared < size)
    return out


def repeated_strings(after: list[bytes], before: list[bytes], least: np.ndarray, most: np.ndarray, n: np.ndarray):
    """For every suffix whether its string of each offset is repeated among these, and its bytes shared with the edges.

    The string of offset o starts o bytes before the anchor.  A suffix that stands for
    ``n`` of two or more repeats its strings by itself.  With them comes how many bytes to the right
    each suffix shares with the first or the last one of their order, whichever are more.
    """
    right, left = _padded(after, WIDTH), _padded(before, _BEFORE)
    orders = multikey_quicksort(right), multikey_quicksort(left)
    shared = shared_bytes(right, orders[0]), shared_bytes(left, orders[1])
    found = np.zeros((len(after), _BEFORE + 1), dtype=bool)
    for o in range(int(least.min()), int(most.max()) + 1):
        has = np.flatnonzero((least <= o) & (o <= most))
        if not len(has):
            continue
        to_right = _classes(orders[0], shared[0], WIDTH - o)[has]
        to_left = _classes(orders[1], shared[1], o)[has]
        _, member = np.unique(to_right * (len(after) + 1) + to_left, return_inverse=True)
        found[has, o] = np.bincount(member, weights=n[has])[member] >= 2
    edges = np.full(len(after), WIDTH, dtype=np.int64)
    from_first, from_last = edges.copy(), edges.copy()
    from_first[1:] = np.minimum.accumulate(shared[0][1:])
    from_last[:-1] = np.minimum.accumulate(shared[0][:0:-1])[::-1]
    edges[orders[0]] = np.maximum(from_first, from_last)
    return found, edges


_FOUND = "run long, least int, most int, hash long, n int"


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of offsets of repeated strings, and with a hash the strings that other buckets may hold too."""
    names = ["run", "least", "most", "hash", "n"]
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    table = pa.Table.from_batches(held)
    after, before = table["after"].to_pylist(), table["before"].to_pylist()
    run, n, least, most = (table[c].to_numpy() for c in ("run", "n", "least", "most"))
    found, edges = repeated_strings(after, before, least, most, n)
    edge = np.zeros((len(run), _BEFORE + 3), dtype=np.int8)
    edge[:, 1:-1] = found & (n == 1)[:, None]
    step = np.diff(edge, axis=1)
    at, begins = np.nonzero(step == 1)
    ends = np.nonzero(step == -1)[1] - 1
    none = lambda kind, size: pa.nulls(size, kind)
    ranges = [pa.array(run[at]), pa.array(begins, kinds[1]), pa.array(ends, kinds[2]), none(kinds[3], len(at)), none(kinds[4], len(at))]
    yield pa.RecordBatch.from_arrays(ranges, names)
    folded: set[int] = set()
    for i in np.flatnonzero(edges >= WIDTH - most):
        whole = np.frombuffer(before[i][::-1] + after[i], dtype=np.uint8)
        offsets = np.arange(max(least[i], WIDTH - edges[i]), most[i] + 1)
        hashes = rolling(whole, WIDTH).view(np.int64)[::-1][-len(offsets) :]
        twice = found[i, offsets] | (n[i] > 1)
        known = [h for h in hashes[twice].tolist() if h not in folded]
        folded.update(known)
        alone = int((~twice).sum())
        size = alone + len(known)
        numbers = pa.concat_arrays([pa.array(np.full(alone, run[i])), none(kinds[0], len(known))])
        places = pa.concat_arrays([pa.array(offsets[~twice], kinds[1]), none(kinds[1], len(known))])
        told = pa.array(np.concatenate([hashes[~twice], np.array(known, dtype=np.int64)]))
        times = pa.array(np.repeat([1, 2], [alone, len(known)]), kinds[4])
        if size:
            yield pa.RecordBatch.from_arrays([numbers, places, places, told, times], names)


def repeated_starts(docs: DataFrame) -> DataFrame:
    """``key`` with ``covers``: ranges (first, last) of the starts of repeated strings."""
    texts = docs.select(_key(docs).alias("key"), F.col("text").cast("binary").alias("text")).where(F.octet_length("text") >= WIDTH)
    found = texts.mapInArrow(_run_rows, "key binary, first long, last long, place long, anchor long, whole long")
    found = written(found, "substring-runs")
    kinds = found.groupBy("anchor", "whole").agg(F.count("*").alias("n"), F.min(F.struct("key", "first", "last", "place")).alias("one"))
    kinds = written(kinds, "substring-kinds")
    shared = kinds.groupBy("anchor").agg(F.count("*").alias("m")).where("m > 1").select("anchor")
    again = kinds.where("n > 1").select("anchor", "whole")
    covered = written(found.join(again, ["anchor", "whole"]).select("key", "first", "last"), "substring-covered")
    opened = kinds.join(shared, "anchor").select("one.*", "n")
    opened = written(opened.withColumn("run", F.monotonically_increasing_id()), "substring-opened")
    discard(found, kinds)
    wanted = opened.groupBy("key").agg(F.collect_list(F.struct("first", "last", "place", "run", "n")).alias("opened"))
    suffixes = texts.join(wanted, "key").dropDuplicates(["key"]).mapInArrow(_suffix_rows, _SUFFIXES)
    suffixes = written(suffixes, "substring-suffixes")
    # The shuffle of the texts is of no more use.
    discard()
    buckets = -(-opened.count() // BUCKET) or 1
    laid = suffixes.repartitionByRange(buckets, "after", "before").mapInArrow(_bucket_rows, _FOUND)
    laid = written(laid, "substring-buckets")
    discard(suffixes)
    strings = laid.where("hash IS NOT NULL")
    twice = strings.groupBy("hash").agg(F.sum("n").alias("n")).where("n > 1").select("hash")
    across = strings.where("n = 1").join(twice, "hash").groupBy("run").agg(F.collect_set("least").alias("offsets"))
    across = across.select("run", F.explode("offsets").alias("least")).select("run", "least", F.col("least").alias("most"))
    inside = laid.where("hash IS NULL").select("run", "least", "most")
    single = inside.unionByName(across).join(opened.select("run", "key", "place"), "run")
    single = single.select("key", (F.col("place") - F.col("most")).alias("first"), (F.col("place") - F.col("least")).alias("last"))
    single = written(single, "substring-single")
    discard(laid, opened)
    return covered.unionByName(single).groupBy("key").agg(F.collect_list(F.struct("first", "last")).alias("covers"))


def _cut_rows(shape: StructType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            covers = batch.column("covers")
            out = []
            for i, text in enumerate(batch.column("text")):
                text = text.as_py() or b""
                edge = np.zeros(len(text) + 1, dtype=np.int64)
                if covers[i].is_valid:
                    ranges = covers[i].values
                    np.add.at(edge, ranges.field("first").to_numpy(zero_copy_only=False), 1)
                    np.add.at(edge, ranges.field("last").to_numpy(zero_copy_only=False) + WIDTH, -1)
                gone = np.cumsum(edge)[:-1] > 0
                spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                kept = np.frombuffer(text, dtype=np.uint8)[~gone].tobytes()
                out.append((kept, len(text), int(gone.sum()), spans))
            columns = list(zip(*out)) or [[]] * 4
            kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), *(pa.array(c, k) for c, k in zip(columns, kinds))], [f.name for f in shape]
            )

    return run


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """Every row as ``doc`` (all columns), with ``kept`` (its remaining bytes), ``n_bytes``, ``n_removed`` and ``n_spans``.

    A null text is the empty one.  Texts of fewer than 400 bytes stay whole.  Rows
    that repeat have each other's strings, so everything from 400 bytes on goes
    from both.  Extra columns of any name stay in the struct; an empty table gives
    an empty result.  What remains need not be valid UTF-8, as a cut may fall inside a character.
    """
    rows = docs.select(packed(docs).alias("doc"), _key(docs).alias("key"))
    met = rows.join(repeated_starts(docs), "key", "left").select("doc", F.col("doc.text").cast("binary").alias("text"), "covers")
    longs = [StructField(n, LongType()) for n in ("n_bytes", "n_removed", "n_spans")]
    shape = StructType([rows.schema["doc"], StructField("kept", BinaryType()), *longs])
    return met.mapInArrow(_cut_rows(shape), shape)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return done.select(
        F.col("doc.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )

