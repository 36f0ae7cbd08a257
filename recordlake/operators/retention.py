"""Keeping the newest, or refusing the newest: a byte budget for each stream, found without sorting its messages.

Both policies come down to one sequence number a stream, its cut: the message where the running sum of
payload bytes passes the budget.  All cuts are found in one lazy plan, by prefix sums of two levels: bytes are
summed by block of sequences, block totals are added up in order, and only inside the one block of
each stream where the budget runs out are sequences added up.  Tasks fold before they shuffle, and no window
orders more than the blocks of a stream or the sequences of a block.

The search reads ``stream``, ``seq`` and a size.  Messages landed ``with_sizes`` carry theirs as
``payload_bytes``, so that no payload is read for its length.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordlake.functions.text import instant_literal

#: Sequences to a block: what the second window of a stream has to order at most.
FANOUT = 2**20
#: Streams past their budgets that may share one call: their cuts, a row for each, are broadcast.  More are refused, not dropped.
STREAMS = 100_000

_FIRST = -(2**63)

#: A budget for every stream, or one for each stream that has any.
Budget = int | Mapping[str, int]


def _size(raw: DataFrame) -> Column:
    if "payload_bytes" not in raw.columns:
        return F.coalesce(F.length("payload"), F.lit(0)).cast("long")
    return F.coalesce("payload_bytes", F.raise_error(F.lit("payload_bytes is NULL: a message was not landed with its size")).cast("long"))


def _amount(amount: Budget, absent: Column) -> Column:
    """What ``amount`` is for the stream of a row; ``absent`` for one that a mapping does not name."""
    if not isinstance(amount, Mapping):
        return F.lit(amount).cast("long")
    found = absent
    for stream, value in amount.items():
        found = F.when(F.col("stream").eqNullSafe(F.lit(stream)), F.lit(value).cast("long")).otherwise(found)
    return found


def _one_per_stream(table: DataFrame) -> DataFrame:
    """The same rows, one a stream, small enough to broadcast: more than ``STREAMS`` are an error."""
    told = table.limit(STREAMS + 1).agg(F.collect_list(F.struct(*table.columns)).alias("rows"))
    refused = F.raise_error(F.lit(f"more than {STREAMS} streams: retain and admit them in groups"))
    return F.broadcast(told.select(F.inline(F.when(F.size("rows") <= STREAMS, F.col("rows")).otherwise(refused))))


def _order(newest_first: bool) -> tuple[Callable[[str], Column], str]:
    return (F.desc, "max") if newest_first else (F.asc, "min")


def _sizes(raw: DataFrame) -> DataFrame:
    sizes = raw.select("stream", F.coalesce("seq", F.lit(0)).alias("seq"), _size(raw).alias("bytes"))
    return sizes.withColumn("block", F.expr(f"(seq - pmod(seq, {FANOUT})) div {FANOUT}"))


def _blocks(sizes: DataFrame, budget: Column, newest_first: bool) -> DataFrame:
    """Every stream (``_stream``) with the ``block`` in which its budget runs out and the bytes ``left`` for it; NULL when all fit."""
    order, first = _order(newest_first)
    totals = sizes.groupBy("stream", "block").agg(F.sum("bytes").alias("bytes"))
    running = F.sum("bytes").over(Window.partitionBy("stream").orderBy(order("block")))
    summed = totals.select("stream", "block", "bytes", running.alias("running"), budget.alias("budget"))
    passed = f"{first}_by(named_struct('block', block, 'left', budget - (running - bytes)), block) FILTER (WHERE running > budget)"
    return summed.groupBy("stream").agg(F.expr(passed).alias("at")).select(F.col("stream").alias("_stream"), "at.block", "at.left")


def _cuts(sizes: DataFrame, blocks: DataFrame, newest_first: bool) -> DataFrame:
    """``_stream`` and ``_cut``, the sequence at which the budget is first exceeded, of the streams that exceed it."""
    order, first = _order(newest_first)
    over = _one_per_stream(blocks.filter(F.col("block").isNotNull()))
    here = F.col("stream").eqNullSafe(F.col("_stream")) & (sizes["block"] == over["block"])
    inside = sizes.join(over, here).groupBy("_stream", "left", "seq").agg(F.sum("bytes").alias("bytes"))
    running = F.sum("bytes").over(Window.partitionBy("_stream").orderBy(order("seq")))
    passed = inside.select("_stream", "seq", (running > F.col("left")).alias("passed")).filter("passed")
    return _one_per_stream(passed.groupBy("_stream").agg(F.expr(f"{first}(seq)").alias("_cut")))


def _beside_cuts(raw: DataFrame, cuts: DataFrame) -> DataFrame:
    return raw.join(cuts, F.col("stream").eqNullSafe(F.col("_stream")), "left")


def _recent(raw: DataFrame, max_age: dt.timedelta | None, now: dt.datetime | None) -> DataFrame:
    if not max_age:
        return raw
    return raw.filter(f"published_at >= {instant_literal((now or dt.datetime.now(dt.timezone.utc)) - max_age)}")


def _limited(max_bytes: Budget) -> bool:
    return bool(max_bytes) if isinstance(max_bytes, Mapping) else max_bytes > 0


def retain_newest(
    raw: DataFrame, max_bytes: Budget = 0, max_age: dt.timedelta | None = None, now: dt.datetime | None = None
) -> DataFrame:
    """What streams that discard the oldest still hold: young enough, and the newest of each that fit in its ``max_bytes``.

    Every stream has a budget of its own: the same for all, or by name, where a stream not named has
    no limit.  Zero or less is no limit.  The copies of one sequence stay or go together; a message whose sequence is not
    known (0 or NULL) counts as the oldest.
    """
    recent = _recent(raw, max_age, now)
    if not _limited(max_bytes):
        return recent
    limit = _amount(max_bytes, F.lit(None).cast("long"))
    sizes = _sizes(recent)
    blocks = _blocks(sizes, F.when(limit > 0, limit), newest_first=True)
    cuts = _cuts(sizes, blocks, newest_first=True)
    # Row groups below the blocks of all cuts are not opened: the bound is one value, found first and pushed to the scan.
    least = blocks.agg(F.min(F.coalesce(F.col("block") * FANOUT, F.lit(_FIRST)))).scalar()
    near = recent.filter((F.col("seq") >= least) | F.col("seq").isNull())
    kept = F.col("_cut").isNull() | (F.coalesce("seq", F.lit(0)) > F.col("_cut"))
    return _beside_cuts(near, cuts).filter(kept).select(*raw.columns)


def admit(raw: DataFrame, max_bytes: Budget, held_bytes: Budget = 0) -> tuple[DataFrame, DataFrame]:
    """What streams that refuse the newest accept, and what they refuse: ``(accepted, refused)``.

    Accepted is, for each stream, the longest run from its oldest message that fits beside the
    ``held_bytes`` already there; nothing held is ever given up.  Budgets are as for ``retain_newest``, and a
    stream that ``held_bytes`` does not name holds nothing.
    """
    if not _limited(max_bytes):
        return raw, raw.filter(F.lit(False))
    limit = _amount(max_bytes, F.lit(None).cast("long"))
    budget = F.when(limit > 0, limit - _amount(held_bytes, F.lit(0).cast("long")))
    sizes = _sizes(raw)
    cuts = _cuts(sizes, _blocks(sizes, budget, newest_first=False), newest_first=False)
    accepts = F.col("_cut").isNull() | (F.coalesce("seq", F.lit(0)) < F.col("_cut"))
    told = _beside_cuts(raw, cuts)
    return told.filter(accepts).select(*raw.columns), told.filter(~accepts).select(*raw.columns)
