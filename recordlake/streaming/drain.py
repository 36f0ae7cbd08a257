"""The drain: micro-batches of messages into the lake, acknowledged only once they are durable.

Each micro-batch writes its dead letters, then its rows, then the manifest of its parts
and its line in the flush log.  The checkpoint commit that follows is the acknowledgement.  An
error on the way escapes, the batch is not committed, and a restart gets the
same messages again: rows may then be there twice, never not at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordlake.operators.decode import FLUSH_FIGURES, decode, to_rejects, to_rows
from recordlake.schema import FLUSH_SCHEMA
from recordlake.sinks.deadletter import UNKNOWN_ORIGIN, to_dead, write_dead
from recordlake.sinks.lake import write_apart, write_lake
from recordlake.sinks.manifest import record_parts
from recordlake.sources.raw import spread_out

#: How long a record waits at most before it is queryable.
DEFAULT_INTERVAL = "5 minutes"

#: Writes one micro-batch somewhere: ``(frame, batch id)``.  It has to tolerate copies.
Writer = Callable[[DataFrame, int], None]


# Where the rejects of a batch lie, so that only that stretch of the dead letters is searched for them; 0 is no place.
_REJECT_SPAN = (
    "min(seq) FILTER (WHERE reason IS NOT NULL AND seq <> 0) AS first_reject",
    "max(seq) FILTER (WHERE reason IS NOT NULL AND seq <> 0) AS last_reject",
)

#: The drain of a batch that was landed by ``flush`` alone.
DIRECT = "direct"

#: Rows after which a batch is flushed where a bound is asked for: parts worth a query.
DEFAULT_MAX_ROWS = 250_000
#: Flushes that one batch may be split into; its flushes are numbered from its own number times this.
FLUSHES_PER_BATCH = 1 << 20

_ARRIVAL = "_arrival"
_FLUSH = "_flush"

#: Flushes whose rows are written by one job, each by a task of its own.
FLUSHES_PER_JOB = 1 << 12

#: Records of one column batch of what is held.
HELD_RECORDS = 200
#: Where decoded records are held: beside the sorts and shuffles of the writes there is no memory for them.
_HELD = StorageLevel.DISK_ONLY
_BATCH_SIZE = "spark.sql.inMemoryColumnarStorage.batchSize"


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """What is held meanwhile is held in batches of ``HELD_RECORDS`` at most.

    A task that writes or reads a held block keeps up to a hundred of its batches alive beside what Spark
    accounts for (``spark.serializer.objectStreamReset``): of batches of the usual size, 4 MB each, some 400 MB a task.
    """
    before = spark.conf.get(_BATCH_SIZE, None)
    spark.conf.set(_BATCH_SIZE, str(min(HELD_RECORDS, int(before or HELD_RECORDS))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_BATCH_SIZE)
        else:
            spark.conf.set(_BATCH_SIZE, before)


def write_flush(spark: SparkSession, path: str, flush_id: int, stats: Row, origin: str, drain_id: str = DIRECT) -> None:
    """Record one flush in a directory of its own, so that a replayed batch replaces its line and no other's.

    Batches are numbered anew by every checkpoint, so the directory names the origin and the drain too.
    """
    line = (flush_id, stats["first_seq"], stats["last_seq"], stats["messages"], stats["rows"], stats["rejects"], origin, drain_id)
    made = spark.createDataFrame([line], FLUSH_SCHEMA).drop("origin", "drain").coalesce(1)
    made.write.mode("overwrite").parquet(f"{path}/origin={origin}/drain={drain_id}/flush={flush_id}")


def read_flushes(spark: SparkSession, path: str) -> DataFrame:
    """The flush log, in ``FLUSH_SCHEMA``; empty before the first flush."""
    try:
        log = spark.read.schema(FLUSH_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], FLUSH_SCHEMA)
    return log.select(*FLUSH_SCHEMA.fieldNames())


def _place() -> tuple[Column, Column]:
    """What orders the messages of a batch: the sequence, and among copies and unknown sequences the order read."""
    return F.coalesce("seq", F.lit(0)).alias("seq"), F.col(_ARRIVAL)


def _within(rows: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The messages of a range in order, and the running sum of their rows."""
    rows = rows.sort_values(["seq", _ARRIVAL])
    return rows, rows["rows"].to_numpy(dtype=np.int64).cumsum()


def _chains(max_rows: int):
    """For every message of a range that may be its first bound: where the chain of bounds ends that begins there, and its length."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        part, (_, to) = int(rows["part"].iloc[0]), _within(rows)
        following = np.searchsorted(to, to + max_rows)
        last, bounds = np.arange(len(to)), np.ones(len(to), dtype=np.int64)
        for i in range(len(to) - 1, -1, -1):
            if following[i] < len(to):
                last[i], bounds[i] = last[following[i]], bounds[following[i]] + 1
        before = np.concatenate([[0], to[:-1]])
        first = np.flatnonzero((to > before) & (before < max_rows))
        return pd.DataFrame({"part": part, "to": to[first], "last": to[last[first]], "bounds": bounds[first]})

    return run


def _numbers(max_rows: int):
    """The number of the flush of every message of a range, from the rows since the last bound before it and that bound's number."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        at, number = -int(rows["since"].iloc[0]), int(rows["number"].iloc[0])
        rows, to = _within(rows)
        bounds = []
        while (next_bound := int(np.searchsorted(to, at + max_rows))) < len(to):
            bounds.append(next_bound)
            at = int(to[next_bound])
        flush_of = number + np.searchsorted(bounds, np.arange(len(to)))
        return pd.DataFrame({"_seq": rows["seq"], _ARRIVAL: rows[_ARRIVAL], _FLUSH: flush_of})

    return run


def flush_numbers(decoded: DataFrame, max_rows: int) -> DataFrame | None:
    """``_seq``, ``_arrival`` and ``_flush`` of every message; None where all of them are one flush.

    A flush ends with the message that brings it to ``max_rows`` rows or more, in order.
    Rows are counted by message, and messages laid out in ranges.  Every range tells, for each message that
    may be its first bound, where the chain of bounds that begins there ends.  The ranges are then gone through in order, with
    one look at each, and last number their messages all at once.  No task holds more than a range, and what
    passes through the driver is a few numbers for every range.
    """
    spark = decoded.sparkSession
    units = decoded.groupBy(*_place()).agg(F.count("row").alias("rows"))
    ranged = units.repartitionByRange(spark.sparkContext.defaultParallelism, "seq", _ARRIVAL).select("*", F.spark_partition_id().alias("part")).persist(StorageLevel.MEMORY_AND_DISK)
    chains = ranged.groupBy("part").applyInPandas(_chains(max_rows), "part int, to long, last long, bounds long").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        totals = ranged.groupBy("part").agg(F.sum("rows").alias("rows")).orderBy("part").collect()
        if sum(r["rows"] for r in totals) < max_rows:
            return None
        since, number, starts = 0, 0, []
        for r in totals:
            starts.append((r["part"], since, number))
            since += r["rows"]
            if since >= max_rows:
                here = (F.col("part") == r["part"]) & (F.col("to") >= max_rows - (since - r["rows"]))
                chain = chains.filter(here).agg(F.min(F.struct("to", "last", "bounds"))).first()[0]
                since, number = r["rows"] - chain["last"], number + chain["bounds"]
        known = spark.createDataFrame(starts, "part int, since long, number long")
        told = ranged.join(F.broadcast(known), "part").groupBy("part")
        numbers = told.applyInPandas(_numbers(max_rows), f"_seq long, {_ARRIVAL} long, {_FLUSH} long").persist(StorageLevel.MEMORY_AND_DISK)
        numbers.count()
        return numbers
    finally:
        chains.unpersist()
        ranged.unpersist()


def _land(
    decoded: DataFrame,
    batch_id: int,
    flush_id: int,
    origin: str,
    lake: str | Writer,
    dead: str | Writer,
    prefix: str,
    flush_log: str | None,
    drain_id: str,
    manifest: str | None,
) -> Row:
    """One flush: dead letters first, rows second, the manifest of its parts and the log last."""
    spark = decoded.sparkSession
    stats = decoded.selectExpr(*FLUSH_FIGURES, *_REJECT_SPAN, "min(stream) AS stream").first()
    if stats["rejects"]:
        letters = to_dead(to_rejects(decoded), origin)
        if callable(dead):
            dead(letters, batch_id)
        else:
            write_dead(letters, dead, (stats["first_reject"], stats["last_reject"]), origin or UNKNOWN_ORIGIN)
    if stats["rows"]:
        if callable(lake):
            lake(to_rows(decoded), batch_id)
        else:
            write_lake(to_rows(decoded), lake, prefix)
            if manifest:
                record_parts(spark, manifest, lake, prefix, to_rows(decoded), stats, flush_id, origin or UNKNOWN_ORIGIN, drain_id)
    if flush_log:
        write_flush(spark, flush_log, flush_id, stats, origin or UNKNOWN_ORIGIN, drain_id)
    return stats


def _land_all(
    placed: DataFrame, flushes: int, batch_id: int, origin: str, lake: str, dead: str, prefix: str, flush_log: str | None, drain_id: str
) -> Row:
    """All flushes of a batch at once: the dead letters of all, then the rows, every flush in parts of its own, the log last."""
    # The rows are only counted here, and not carried through the aggregation.
    counted = placed.selectExpr(_FLUSH, "seq", "idx", "if(row IS NOT NULL, 1, NULL) AS row", "reason", "stream")
    figures = counted.groupBy(_FLUSH).agg(*(F.expr(f) for f in (*FLUSH_FIGURES, *_REJECT_SPAN, "min(stream) AS stream"))).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        told = figures.agg(F.sum("rejects").alias("rejects"), F.min("first_reject").alias("first"), F.max("last_reject").alias("last")).first()
        if told["rejects"]:
            write_dead(to_dead(to_rejects(placed), origin), dead, (told["first"], told["last"]), origin or UNKNOWN_ORIGIN)
        for first in range(0, flushes, FLUSHES_PER_JOB):
            some = min(FLUSHES_PER_JOB, flushes - first)
            ours = placed.filter(F.col(_FLUSH).between(first, first + some - 1))
            write_apart(to_rows(ours, f"{_FLUSH} - {first} AS {_FLUSH}"), _FLUSH, some, lake, prefix)
        if flush_log:
            lines = figures.withColumn("flush_id", F.col(_FLUSH) + batch_id * FLUSHES_PER_BATCH).withColumn("flush", F.col("flush_id"))
            kept = [c for c in FLUSH_SCHEMA.fieldNames() if c not in ("origin", "drain")]
            writer = lines.select(*kept, "flush").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("flush")
            writer.parquet(f"{flush_log}/origin={origin or UNKNOWN_ORIGIN}/drain={drain_id}")
        return figures.orderBy(F.col(_FLUSH).desc()).drop(_FLUSH).first()
    finally:
        figures.unpersist()


def flush(
    batch: DataFrame,
    batch_id: int,
    envelope: str,
    origin: str,
    lake: str | Writer,
    dead: str | Writer,
    prefix: str | None = None,
    flush_log: str | None = None,
    drain_id: str = DIRECT,
    max_rows: int | None = None,
    manifest: str | None = None,
) -> Row:
    """Land one micro-batch: dead letters first, rows second, the manifest and the log last.

    The batch is decoded once, in pieces of about the same number of messages however few files it came in, and
    held on the executors' disks while the writes use it, so that memory does not depend on its size; blocks lost
    with an executor are decoded again from the source.  With ``max_rows``
    it is landed in several flushes, in order of sequence: each ends with the message that
    brings it to ``max_rows`` rows, so it is past the bound by less than that message.
    The figures of the last flush are returned.  With ``manifest`` the parts of every flush are recorded.
    """
    with _small_batches(batch.sparkSession):
        beside = (_ARRIVAL,) if max_rows else ()
        numbered = batch.withColumn(_ARRIVAL, F.monotonically_increasing_id()) if max_rows else batch
        decoded = decode(spread_out(numbered), envelope, True, beside).persist(_HELD)
        to = (origin, lake, dead, origin if prefix is None else prefix, flush_log, drain_id, manifest)
        held = [decoded]
        try:
            if not max_rows:
                return _land(decoded, batch_id, batch_id, *to)
            numbers = flush_numbers(decoded, max_rows)
            if numbers is None:
                return _land(decoded.drop(_ARRIVAL), batch_id, batch_id * FLUSHES_PER_BATCH, *to)
            placed = decoded.withColumn("_seq", _place()[0]).join(numbers, ["_seq", _ARRIVAL]).drop("_seq", _ARRIVAL).persist(_HELD)
            held += [numbers, placed]
            flushes = placed.agg(F.max(_FLUSH)).first()[0] + 1
            # All that is wanted of it is in what was just laid beside the numbers.
            decoded.unpersist()
            if not (callable(lake) or callable(dead) or manifest):
                return _land_all(placed, flushes, batch_id, *to[:-1])
            for k in range(flushes):
                stats = _land(placed.filter(F.col(_FLUSH) == k).drop(_FLUSH), batch_id, batch_id * FLUSHES_PER_BATCH + k, *to)
            return stats
        finally:
            for one in held:
                one.unpersist()


def drain(
    raw: DataFrame,
    envelope: str,
    lake: str | Writer,
    dead: str | Writer,
    checkpoint: str,
    origin: str = "ledger",
    prefix: str | None = None,
    interval: str = DEFAULT_INTERVAL,
    available_now: bool = False,
    flush_log: str | None = None,
    max_rows: int | None = None,
    manifest: str | None = None,
) -> StreamingQuery:
    """Start draining a stream of messages into the lake.

    ``lake`` and ``dead`` are paths or writers, and both are required: without
    somewhere to keep what cannot be read it would have to be thrown away.  The
    lake's prefix is the origin unless given.  No two drains may run under one origin
    or into one lake prefix at a time.  ``checkpoint`` is the durable
    name of the drain.  ``interval`` bounds how long a record waits; how much a
    batch takes is bounded at the source, where rows are not counted yet, and how many rows
    one flush lands by ``max_rows``.  ``manifest`` is where the parts of every flush are recorded.
    """
    if not dead:
        raise ValueError("drain: a dead-letter target is required; pass a path or a writer")
    if not lake:
        raise ValueError("drain: no destination; pass a path or a writer for the lake")
    if not checkpoint:
        raise ValueError("drain: a checkpoint is required; it is what acknowledges a batch")
    if not raw.isStreaming:
        raise ValueError("drain: a stream is required; land a table at rest with flush()")

    def land(batch: DataFrame, batch_id: int) -> None:
        # The id that the checkpoint keeps: the same after a restart, another for another checkpoint.
        drain_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        flush(batch, batch_id, envelope, origin, lake, dead, prefix, flush_log, drain_id, max_rows, manifest)

    writer = raw.writeStream.queryName(f"drain-{origin}").foreachBatch(land).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if available_now else {"processingTime": interval}
    return writer.trigger(**trigger).start()
