"""The tail: look back into a stream without consuming it, or follow it.

A read of a table takes nothing away, so there is no position to disturb.  A
followed tail runs under a checkpoint of its own, never under the drain's.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Mapping
from typing import NamedTuple

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordlake.functions.arguments import DEFAULT_LAST, Start, parse_filters, parse_since
from recordlake.functions.text import instant_literal
from recordlake.operators.decode import decode, render_reject, to_rejects, to_rows
from recordlake.operators.tail import json_lines, where_equals
from recordlake.sources.raw import filter_subject, raw_stream, raw_table


class Tail(NamedTuple):
    """What a tail shows: ``lines`` (seq, idx, line) and ``unreadable`` (subject, seq, idx, message)."""

    lines: DataFrame
    unreadable: DataFrame


def of_stream(raw: DataFrame, stream: str | None) -> DataFrame:
    return raw if stream is None else raw.filter(F.col("stream") == stream)


def last_messages(raw: DataFrame, n: int = DEFAULT_LAST, zones: DataFrame | None = None) -> DataFrame:
    """The last ``n`` sequences of a stream, by arithmetic and not by counting records.

    ``raw`` is the whole stream: gaps, or a subject filter applied afterwards,
    leave fewer than ``n``.  The bound is a subquery of one value that runs
    first and is pushed to the scan, so older row groups are not opened.  With the stream's
    ``zones`` (``sources.zones``) the newest sequence is taken from that map, as far as it has been recorded,
    and the messages are read once.
    """
    if n <= 0:
        n = DEFAULT_LAST
    newest = raw.select(F.max("seq") - (n - 1)) if zones is None else zones.select(F.max("greatest") - (n - 1))
    return raw.filter(F.col("seq") >= newest.scalar())


def since_age(raw: DataFrame, age: dt.timedelta, now: dt.datetime | None = None) -> DataFrame:
    """Messages that arrived within ``age`` of ``now`` (UTC; the present moment when not given)."""
    return raw.filter(f"published_at >= {instant_literal((now or dt.datetime.now(dt.timezone.utc)) - age)}")


def start_at(raw: DataFrame, start: Start, now: dt.datetime | None = None, zones: DataFrame | None = None) -> DataFrame:
    """Messages from where the tail begins: all of them, else by age, else the last so many."""
    if start.from_start:
        return raw
    if start.age is not None:
        return since_age(raw, start.age, now)
    return last_messages(raw, start.last, zones)


def _begin(since: str | int | None, from_start: bool) -> Start:
    return parse_since(since)._replace(from_start=from_start)


def _matching(decoded: DataFrame, filters: Mapping[str, str]) -> DataFrame:
    return where_equals(to_rows(decoded, "seq", "idx"), filters)


def tail_rows(
    raw: DataFrame,
    envelope: str,
    subject: str = ">",
    stream: str | None = None,
    since: str | int | None = None,
    from_start: bool = False,
    filters: Iterable[str] | Mapping[str, str] = (),
    now: dt.datetime | None = None,
    zones: DataFrame | None = None,
) -> DataFrame:
    """The rows a tail shows, before rendering: ``seq``, ``idx`` and the lake columns.

    Sequence and subject are filtered before anything is decoded.  Stream order
    is ``seq, idx``; sorting is left to whoever needs it.
    """
    start, filters = _begin(since, from_start), parse_filters(filters)
    zones = None if zones is None else of_stream(zones, stream)
    messages = filter_subject(start_at(of_stream(raw, stream), start, now, zones), subject)
    return _matching(decode(messages, envelope), filters)


def tail(
    raw: DataFrame,
    envelope: str,
    subject: str = ">",
    stream: str | None = None,
    since: str | int | None = None,
    from_start: bool = False,
    filters: Iterable[str] | Mapping[str, str] = (),
    pretty: bool = False,
    no_detail: bool = False,
    now: dt.datetime | None = None,
    zones: DataFrame | None = None,
) -> Tail:
    """Look back into a stream: a JSON line for every matching row, and a note for every unreadable event."""
    start, filters = _begin(since, from_start), parse_filters(filters)
    zones = None if zones is None else of_stream(zones, stream)
    messages = filter_subject(start_at(of_stream(raw, stream), start, now, zones), subject)
    return _shown(decode(messages, envelope), filters, pretty, no_detail)


def _shown(decoded: DataFrame, filters: Mapping[str, str], pretty: bool, no_detail: bool) -> Tail:
    lines = json_lines(_matching(decoded, filters), pretty, no_detail, ("seq", "idx"))
    told = F.concat("subject", F.lit(" seq "), "seq", F.lit(": unreadable: "), render_reject())
    return Tail(lines, to_rejects(decoded).select("subject", "seq", "idx", told.alias("message")))


def _condition(spark: SparkSession, path: str, stream: str | None, start: Start, now: dt.datetime | None) -> str:
    """Where a followed tail begins, as a condition that does not change when more messages land."""
    if start.from_start:
        return "true"
    if start.age is not None:
        return f"published_at >= {instant_literal((now or dt.datetime.now(dt.timezone.utc)) - start.age)}"
    newest = of_stream(raw_table(spark, path), stream).agg(F.max("seq")).first()[0]
    return "true" if newest is None else f"seq >= {newest - (start.last - 1)}"


def tail_stream(
    spark: SparkSession,
    path: str,
    envelope: str,
    subject: str = ">",
    stream: str | None = None,
    since: str | int | None = None,
    from_start: bool = False,
    filters: Iterable[str] | Mapping[str, str] = (),
    pretty: bool = False,
    no_detail: bool = False,
    now: dt.datetime | None = None,
) -> DataFrame:
    """Follow a stream: the same lines, and those of messages that land later.

    Where to begin is settled once, from the stream as it is now.  Write the
    result in append mode under a checkpoint used for nothing else.
    """
    start, filters = _begin(since, from_start), parse_filters(filters)
    messages = of_stream(raw_stream(spark, path), stream).filter(_condition(spark, path, stream, start, now))
    decoded = decode(filter_subject(messages, subject), envelope)
    return json_lines(_matching(decoded, filters), pretty, no_detail, ("seq", "idx"))


#: Writes what one micro-batch shows: ``(frame, batch id)``.  It has to tolerate copies.
Writer = Callable[[DataFrame, int], None]


def _settled(spark: SparkSession, checkpoint: str, settle: Callable[[], str]) -> str:
    """The condition a follow began with: kept beside its checkpoint, so that a restart goes on from there."""
    kept = f"{checkpoint.rstrip('/')}-begin"
    try:
        return spark.read.schema("condition string").parquet(kept).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    condition = settle()
    spark.createDataFrame([(condition,)], "condition string").coalesce(1).write.mode("overwrite").parquet(kept)
    return condition


def follow(
    spark: SparkSession,
    path: str,
    envelope: str,
    lines: str | Writer,
    unreadable: str | Writer,
    checkpoint: str,
    subject: str = ">",
    stream: str | None = None,
    since: str | int | None = None,
    from_start: bool = False,
    filters: Iterable[str] | Mapping[str, str] = (),
    pretty: bool = False,
    no_detail: bool = False,
    now: dt.datetime | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Follow a stream with both of a tail's outputs: the lines, and a note for every event that cannot be read.

    Each micro-batch is decoded once and shown twice.  ``unreadable`` and ``lines`` are folders or
    writers; in a folder every micro-batch has one of its own, which a repetition after a failure replaces, so that
    nothing is shown twice or lost.  ``checkpoint`` is used for nothing else, and where the follow began is kept
    beside it.  Nothing is consumed.
    """
    start, filters = _begin(since, from_start), parse_filters(filters)
    condition = _settled(spark, checkpoint, lambda: _condition(spark, path, stream, start, now))
    messages = filter_subject(of_stream(raw_stream(spark, path), stream).filter(condition), subject)

    def show(batch: DataFrame, batch_id: int) -> None:
        decoded = decode(batch, envelope).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            shown = _shown(decoded, filters, pretty, no_detail)
            for frame, to in ((shown.unreadable, unreadable), (shown.lines, lines)):
                if callable(to):
                    to(frame, batch_id)
                else:
                    frame.write.mode("overwrite").parquet(f"{to}/batch={batch_id}")
        finally:
            decoded.unpersist()

    writer = messages.writeStream.foreachBatch(show).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
