"""Raw messages, from a table that is read once or a stream of files that keep landing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordlake.schema import RAW_ID_SCHEMA, RAW_SCHEMA, SIZE_FIELD

#: Files per micro-batch unless told otherwise.
DEFAULT_MAX_FILES = 512
#: Pieces that messages are read in, for every task that may run at once.
SPREAD = 3


def raw_table(spark: SparkSession, path: str, message_ids: bool = False, sizes: bool = False) -> DataFrame:
    """Messages at rest: a snapshot, read without consuming anything.

    The ids of their publishers and their stored sizes come along if asked for.
    """
    schema = RAW_ID_SCHEMA if message_ids else RAW_SCHEMA
    if sizes:
        schema = T.StructType([*schema.fields, SIZE_FIELD])
    return spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(path)


def with_sizes(raw: DataFrame) -> DataFrame:
    """Adds ``payload_bytes``, to be landed with the messages so that budgets need not read them."""
    return raw.withColumn(SIZE_FIELD.name, F.coalesce(F.length("payload"), F.lit(0)).cast("long"))


def spread_out(raw: DataFrame) -> DataFrame:
    """The messages in pieces of about the same number, however few files they came in: decoding costs far more than its bytes tell."""
    return raw.repartition(SPREAD * raw.sparkSession.sparkContext.defaultParallelism)


def raw_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = DEFAULT_MAX_FILES,
    max_bytes: int | None = None,
    message_ids: bool = False,
) -> DataFrame:
    """Messages as they land.  How much one micro-batch takes is bounded by files or, when given, by bytes.

    Any other streaming source will do for the drain and the tail, as long as
    it yields ``RAW_SCHEMA``.
    """
    reader = spark.readStream.schema(RAW_ID_SCHEMA if message_ids else RAW_SCHEMA).option("pathGlobFilter", "*.parquet")
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    elif max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def filter_subject(df: DataFrame, pattern: str) -> DataFrame:
    """Messages whose subject matches: an exact subject, or ``base.>`` for one or more tokens below base.

    Written as a prefix match, which Parquet statistics can answer.
    """
    subject = F.col("subject")
    if pattern == ">":
        return df
    if "*" in pattern or ">" in pattern[:-1] or (pattern.endswith(">") and not pattern.endswith(".>")):
        raise ValueError(f"subject pattern {pattern!r}: want a subject or a subject followed by '.>'")
    if not pattern.endswith(".>"):
        return df.filter(subject == pattern)
    prefix = pattern[:-1]
    return df.filter(subject.startswith(prefix) & (F.length(subject) > len(prefix)))


def subject_parts(df: DataFrame, base: str) -> DataFrame:
    """Adds ``subject_tenant`` and ``subject_app``, the two tokens a subject carries below ``base``."""
    depth = len(base.split("."))
    tokens = F.split("subject", "[.]")
    return df.select("*", F.get(tokens, F.lit(depth)).alias("subject_tenant"), F.get(tokens, F.lit(depth + 1)).alias("subject_app"))


def drop_duplicates(df: DataFrame, keys: tuple[str, ...] = ("stream", "seq"), window: str = "2 minutes") -> DataFrame:
    """Messages published more than once, kept once.

    On a table all copies are in sight and the window plays no part.  On a
    stream an id is remembered for ``window`` or more after it arrived, which
    bounds the state.  A message arrives with its micro-batch, whenever it was
    published, so none is late: one published before others that came first
    passes, and a copy that comes after the window passes again.  Only a clock set
    back by more than the window could make a batch late.  The drain does
    without: copies are kept there and folded by the reader.

    A message whose sequence is unknown (0 or NULL) is no copy of another: all of them
    are kept.  ``streaming.published`` goes by the ids of publishers instead.
    """
    unknown = F.coalesce(F.col("seq") <= 0, F.lit(True)) if "seq" in keys else F.lit(False)
    known = df.filter(~unknown)
    if df.isStreaming:
        timed = known.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", window)
        once = timed.dropDuplicatesWithinWatermark(list(keys)).drop("_arrived")
    else:
        once = known.dropDuplicates(list(keys))
    return once.unionByName(df.filter(unknown)) if "seq" in keys else once
