"""What could not be read is kept: dead letters, each recorded once."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.schema import DEAD_SCHEMA

#: Dead letters of one origin share a subject, so the origins can be watched apart.
DEAD_SUBJECT = "rec.v1.dead"
UNKNOWN_ORIGIN = "unknown"

#: Sequences per directory.  A batch covers a narrow range, so looking for its ids opens a directory or two.
SEQ_BLOCK = 1_000_000
#: The block of letters whose sequence is not known.
UNKNOWN_BLOCK = -1

_BLOCK = "seq_block"
#: The hash of a letter's bytes, stored so that looking for a letter never reads payloads.
_BYTES = "bytes_hash"
_STORED = T.StructType([*DEAD_SCHEMA.fields, T.StructField(_BYTES, T.BinaryType()), T.StructField(_BLOCK, T.LongType())])
_IDENTITY = ["origin", "msg_id", _BYTES]


def dead_subject_for(origin: str) -> str:
    """The subject of an origin's dead letters; an empty origin is ``unknown``."""
    return f"{DEAD_SUBJECT}.{origin or UNKNOWN_ORIGIN}"


def _payload_hash() -> Column:
    return F.unhex(F.sha2(F.coalesce("payload", F.lit("").cast("binary")), 256))


def to_dead(rejects: DataFrame, origin: str) -> DataFrame:
    """Rejects as dead letters: where each came from, why it is here, and its original bytes.

    ``msg_id`` is ``stream-sequence-index``, so however often a batch is
    retried its dead letters have the ids they had the first time.  A sequence of 0
    or none says nothing about which message this is; there the hash of the bytes
    is part of the id.
    """
    sequence, index = F.col("seq").cast("string"), F.col("idx").cast("string")
    known = F.coalesce(F.col("seq") != 0, F.lit(False))
    parts = [F.coalesce("stream", F.lit("")), F.coalesce(sequence, F.lit("0")), F.coalesce(index, F.lit(""))]
    numbered = F.concat_ws("-", *parts)
    hashed = F.concat_ws("-", *parts, F.lower(F.hex(_payload_hash())))
    return rejects.select(
        F.when(known, numbered).otherwise(hashed).alias("msg_id"),
        F.lit(origin or UNKNOWN_ORIGIN).alias("origin"),
        F.lit(dead_subject_for(origin)).alias("dead_subject"),
        "reason",
        "error",
        "stream",
        "subject",
        sequence.alias("sequence"),
        index.alias("event_index"),
        "payload",
    )


def distinct_dead(dead: DataFrame) -> DataFrame:
    """One dead letter per origin, ``msg_id`` and payload; copies are folded before the shuffle, so a hot id is no hot task.

    The payload counts because sequences start again when a stream is made anew.
    """
    same = Window.partitionBy(*_IDENTITY).orderBy("msg_id")
    told = dead.withColumn(_BYTES, _payload_hash()).withColumn("_nth", F.row_number().over(same))
    return told.filter("_nth = 1").select(*dead.columns)


def _root(path: str, origin: str) -> str:
    """The output folder of one origin.  Appends share a commit folder, so no two writers may share an output folder."""
    if not re.fullmatch(r"[A-Za-z0-9_-]+", origin):
        raise ValueError(f"origin {origin!r}: letters, digits, '_' and '-' only, as it names a folder")
    return f"{path}/origin={origin}"


def _stored(spark: SparkSession, path: str, origin: str | None = None) -> DataFrame:
    """The dead-letter table as stored, of one origin if given, or an empty one before its first write."""
    reader = spark.read.schema(_STORED).option("pathGlobFilter", "*.parquet").option("basePath", path)
    try:
        return reader.parquet(path if origin is None else _root(path, origin))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _STORED)


def read_dead(spark: SparkSession, path: str) -> DataFrame:
    """The dead-letter table, in ``DEAD_SCHEMA``."""
    return _stored(spark, path).select(*DEAD_SCHEMA.fieldNames())


def dead_once(
    dead: DataFrame, path: str, seq_range: tuple[int | None, int | None] | None = None, origin: str | None = None
) -> DataFrame:
    """The dead letters that the table at ``path`` does not hold yet.

    With the range of the batch's known sequences only the directories and row
    groups that can hold its ids are read, however large the table has grown, beside the
    letters without a sequence.
    """
    held = _stored(dead.sparkSession, path, origin)
    if seq_range is not None:
        first, last = seq_range
        near = F.col(_BLOCK) == UNKNOWN_BLOCK
        if first is not None:
            near = near | F.col(_BLOCK).between(first // SEQ_BLOCK, last // SEQ_BLOCK)
        held = held.filter(near)
    told = distinct_dead(dead).withColumn(_BYTES, _payload_hash())
    return told.join(held.select(*_IDENTITY), _IDENTITY, "left_anti").select(*dead.columns)


def write_dead(
    dead: DataFrame, path: str, seq_range: tuple[int | None, int | None] | None = None, origin: str | None = None
) -> None:
    """Append the dead letters that are not recorded yet, in an output folder per origin and a directory per block of sequences.

    Writers of different origins may run at once; of one origin there is one
    writer, as there is one drain.  Without ``origin`` the few names that occur are looked up first.
    """
    block = F.when(F.coalesce(F.col("sequence") == "0", F.lit(True)), UNKNOWN_BLOCK)
    block = block.otherwise(F.expr(f"cast(sequence as bigint) div {SEQ_BLOCK}"))
    origins = [origin] if origin is not None else [r.origin for r in dead.select("origin").distinct().collect()]
    for one in origins:
        fresh = dead_once(dead.filter(F.col("origin") == one), path, seq_range, one)
        laid_out = fresh.drop("origin").withColumn(_BYTES, _payload_hash()).withColumn(_BLOCK, block).hint("rebalance", _BLOCK)
        laid_out.write.mode("append").partitionBy(_BLOCK).option("compression", "zstd").parquet(_root(path, one))
