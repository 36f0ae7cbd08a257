"""The manifest of a lake: which flush wrote each part, and of which messages.

Part files have names of Spark's choosing.  After a flush has been committed, the files
of the days it touched that no earlier flush has recorded are its own: one drain at a time
writes under a lake prefix.  A flush that died between its rows and its manifest left files
unrecorded, and the same messages come again: they are recorded with its repetition, whose range is the same.

Every flush has a folder of its own, replaced when the flush is repeated.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from recordlake.operators.decode import decode, to_rows
from recordlake.schema import MANIFEST_SCHEMA
from recordlake.sinks.lake import lake_path

# Fixed value: the partition of an empty app.
_NO_APP = "__HIVE_DEFAULT_PARTITION__"


def _folder(path: str, prefix: str) -> str:
    return f"{path}/prefix={prefix or '-'}"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest, in ``MANIFEST_SCHEMA``; empty before the first flush."""
    try:
        held = spark.read.schema(MANIFEST_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return held.select(*MANIFEST_SCHEMA.fieldNames())


def parts_of_days(spark: SparkSession, lake: str, prefix: str, days: list[str]) -> DataFrame:
    """``part`` (below the prefix), ``date``, ``app`` and ``bytes`` of every file of some days; only folders are listed."""
    folders = [f"{lake_path(lake, prefix)}/date={day}" for day in days]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folders)
    part = F.regexp_extract("path", r"date=[^/]+/app=[^/]+/[^/]+$", 0)
    named = F.regexp_extract("part", r"/app=([^/]+)/", 1)
    app = F.when(named == _NO_APP, "").otherwise(F.url_decode(F.replace(named, F.lit("+"), F.lit("%2B"))))
    date = F.to_date(F.regexp_extract("part", r"date=([^/]+)/", 1))
    listed = files.select(part.alias("part"), F.col("length").alias("bytes"))
    return listed.select("part", date.alias("date"), app.alias("app"), "bytes")


def record_parts(
    spark: SparkSession, path: str, lake: str, prefix: str, rows: DataFrame, stats: Row, flush_id: int, origin: str, drain_id: str
) -> None:
    """Record the parts that a flush has just written; ``rows`` are its rows and ``stats`` its figures."""
    days = sorted(str(r[0]) for r in rows.select(F.to_date("time")).distinct().collect())
    own = (F.col("origin") == origin) & (F.col("drain") == drain_id) & (F.col("flush") == flush_id)
    # Manifests of other prefixes do not name these parts, but may name parts of the same name.
    earlier = read_manifest(spark, _folder(path, prefix)).filter(~own & F.col("date").isin(*days)).select("part")
    fresh = parts_of_days(spark, lake, prefix, days).join(earlier, "part", "left_anti")
    told = fresh.select(
        "part",
        "date",
        "app",
        "bytes",
        F.lit(stats["stream"]).cast("string").alias("stream"),
        F.lit(stats["first_seq"]).cast("long").alias("first_seq"),
        F.lit(stats["last_seq"]).cast("long").alias("last_seq"),
    )
    told.coalesce(1).write.mode("overwrite").parquet(f"{_folder(path, prefix)}/origin={origin}/drain={drain_id}/flush={flush_id}")


def _width(first: Column, last: Column) -> Column:
    """The power of two that an interval fits in: it then meets at most two aligned blocks of that size."""
    return F.ceil(F.log2((last - first + 1).cast("double"))).cast("int")


def part_to_messages(manifest: DataFrame, raw: DataFrame, envelope: str) -> DataFrame:
    """``part``, ``date``, ``app``, ``origin``, ``drain``, ``flush``, ``stream``, ``seq`` and ``rows`` of every message that a part may hold rows of.

    A message belongs to a part if its sequence lies in the range of the part's flush and some of its rows in the
    part's day and app; of several parts that one flush wrote for a day and app, to each.
    The ranges are an interval index: a range is filed under the one or two aligned blocks of its own size that it
    meets, a message under its block of every size in use, and both meet by equality.  Messages of unknown
    sequence are in no range.
    """
    ranges = manifest.filter("first_seq > 0").withColumn("size", _width(F.col("first_seq"), F.col("last_seq")))
    sizes = [r[0] for r in ranges.select("size").distinct().collect()]
    blocks = F.explode(F.array_distinct(F.array(F.expr("shiftright(first_seq, size)"), F.expr("shiftright(last_seq, size)"))))
    filed = ranges.select("*", blocks.alias("block"))
    held = to_rows(decode(raw.filter("seq > 0"), envelope), "stream", "seq")
    counted = held.groupBy("stream", "seq", F.to_date("time").alias("date"), "app").agg(F.count("*").alias("rows"))
    places = F.array(*[F.struct(F.lit(s).alias("size"), F.expr(f"shiftright(seq, {s})").alias("block")) for s in sizes] or [F.lit(None).cast("struct<size:int,block:bigint>")])
    placed = counted.select("*", F.inline(places))
    met = filed.join(placed, ["stream", "date", "app", "size", "block"]).filter("seq BETWEEN first_seq AND last_seq")
    return met.select("part", "date", "app", "origin", "drain", "flush", "stream", "seq", "rows")
