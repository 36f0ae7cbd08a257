"""A zone map of a landing table: the least and greatest sequence of each stream in each landed file.

It is kept beside the table by a stream of its own, which reads the sequences of new files once, so the newest
sequence of a stream is found without a look at its messages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.schema import RAW_SCHEMA, ZONE_SCHEMA

#: Files are new however old their times: a landing table may be a copy.
_ANY_AGE = "36500d"


def record_zones(spark: SparkSession, landing: str, zones: str) -> None:
    """Records the files that landed since the last call, under ``zones``; call it whenever messages have landed.

    Which files are known is kept in a checkpoint beside the map; each micro-batch has a folder of its own, which a
    repetition after a failure replaces.  One call at a time.  Messages without a sequence (0 or NULL) are counted and
    bound nothing.
    """
    landed = spark.readStream.schema(RAW_SCHEMA).option("pathGlobFilter", "*.parquet").option("maxFileAge", _ANY_AGE).parquet(landing)
    known = F.when(F.col("seq") > 0, F.col("seq"))

    def record(batch: DataFrame, batch_id: int) -> None:
        found = batch.groupBy("file", "stream").agg(
            F.min(known).alias("least"), F.max(known).alias("greatest"), F.count("*").alias("messages")
        )
        found.select(*ZONE_SCHEMA.fieldNames()).write.mode("overwrite").parquet(f"{zones}/batch={batch_id}")

    sequences = landed.select(F.col("_metadata.file_path").alias("file"), "stream", "seq")
    writer = sequences.writeStream.foreachBatch(record).option("checkpointLocation", f"{zones.rstrip('/')}-checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()


def read_zones(spark: SparkSession, zones: str) -> DataFrame:
    """The map: ``file``, ``stream``, ``least`` and ``greatest`` sequence, ``messages``."""
    return spark.read.schema(ZONE_SCHEMA).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(zones)
