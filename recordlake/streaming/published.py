"""Messages published more than once, landed once, by the ids their publishers gave them.

The ids of the messages that went through are a table, a folder for every batch under the hour it
arrived in.  A batch looks for its ids among those that arrived within the window and in earlier batches,
so what it reads is bounded by the window, and a batch that is repeated after a failure decides as before:
its own ids are not among the earlier ones, and the moment it arrived is kept with them.

A message without an id goes by its sequence.  One without either, or of sequence 0, has no identity
and always passes.  When a message was published plays no part, so none is late.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordlake.functions.text import instant_literal
from recordlake.schema import RAW_ID_SCHEMA

#: How long an id is remembered.
DEFAULT_WINDOW = dt.timedelta(minutes=2)

_IDS = "stream string, identity string, arrived timestamp_ntz"
_NAMES = RAW_ID_SCHEMA.fieldNames()

# Ids and sequences never meet: each is marked as what it is.
_IDENTITY = """CASE WHEN message_id <> '' THEN concat('id ', message_id) WHEN seq > 0 THEN concat('seq ', seq) END"""


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``stream``, ``identity``, ``arrived``, ``hour`` and ``batch`` of the messages that went through."""
    schema = f"{_IDS}, hour string, batch long"
    try:
        return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_of_each(messages: DataFrame) -> DataFrame:
    """Of the messages of one identity the one of least sequence; those without an identity all.

    Folded by task before the shuffle, so an id that very many messages share is a row per task.
    """
    named = messages.withColumn("identity", F.expr(_IDENTITY))
    least = F.min(F.struct("seq", "published_at", "subject", "payload", "message_id")).alias("one")
    folded = named.filter("identity IS NOT NULL").groupBy("stream", "identity").agg(least).select("stream", "identity", "one.*")
    return folded.unionByName(named.filter("identity IS NULL")).select(*_NAMES, "identity")


def _moment(ids: DataFrame, batch_id: int, now: dt.datetime | None) -> dt.datetime:
    """When a batch arrived: as recorded if it is a repetition, and never before an earlier batch, whatever the clock says."""
    own, latest = ids.agg(F.max(F.when(F.col("batch") == batch_id, F.col("arrived"))), F.max("arrived")).first()
    if own is not None:
        return own
    clock = now or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    return clock if latest is None else max(clock, latest)


def fold_published(
    batch: DataFrame, batch_id: int, ids: str, window: dt.timedelta = DEFAULT_WINDOW, now: dt.datetime | None = None
) -> DataFrame:
    """The messages of a batch (``RAW_ID_SCHEMA``) whose identity did not come within ``window`` before; their ids are recorded."""
    spark = batch.sparkSession
    known = read_ids(spark, ids)
    arrived = _moment(known, batch_id, now)
    since = arrived - window
    recent = known.filter(F.col("hour") >= since.strftime("%Y%m%d%H")).filter(f"arrived > {instant_literal(since)} AND batch < {int(batch_id)}")
    fresh = first_of_each(batch).join(recent.select("stream", "identity"), ["stream", "identity"], "left_anti")
    named = fresh.filter("identity IS NOT NULL").select("stream", "identity", F.expr(instant_literal(arrived)).alias("arrived"))
    named.write.mode("overwrite").parquet(f"{ids}/hour={arrived:%Y%m%d%H}/batch={int(batch_id)}")
    return fresh.select(*_NAMES)


def publish_once(
    incoming: DataFrame, target: str, ids: str, checkpoint: str, window: dt.timedelta = DEFAULT_WINDOW, available_now: bool = False
) -> StreamingQuery:
    """Start landing a stream of ``RAW_ID_SCHEMA`` in ``target``, each message once; a repeated batch replaces its own folder."""

    def land(batch: DataFrame, batch_id: int) -> None:
        fold_published(batch, batch_id, ids, window).write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    writer = incoming.writeStream.queryName("publish-once").foreachBatch(land).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
