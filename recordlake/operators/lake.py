"""What readers do with the lake: remove copies, tell provenance apart, open JSON columns, check totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The three answers ``execution_subject`` can give.
RUNNER = "runner"
DIRECT = "direct"
NOT_RECORDED = "not recorded"


def dedupe(df: DataFrame, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """One row per ``event_id``, the earliest by ``time``.

    Delivery is at least once, so the lake holds copies.  Each map task keeps
    one row per id before the shuffle, which also bounds what one much-repeated
    id can send to one task.

    Filter first and dedupe after: only a filter on ``event_id`` moves below the
    window by itself, and copies agree in every column, so a filter on ``date``
    or ``app`` put before it changes nothing but the partitions read.  Copies
    made elsewhere that do differ can be ordered with ``tie_breakers``; each one
    named is one more column that is read.
    """
    first = Window.partitionBy("event_id").orderBy("time", *tie_breakers)
    return df.withColumn("_copy", F.row_number().over(first)).filter(F.col("_copy") == 1).drop("_copy")


def with_provenance(df: DataFrame) -> DataFrame:
    """Adds ``provenance``: a runner acted, a direct call (``''``), or not recorded (NULL).

    NULL and ``''`` stay apart: taking one for the other would claim that no
    runner was involved where nothing was written down.
    """
    subject = F.col("execution_subject")
    return df.withColumn(
        "provenance", F.when(subject.isNull(), NOT_RECORDED).when(subject == "", DIRECT).otherwise(RUNNER)
    )


def provenance_counts(df: DataFrame) -> DataFrame:
    """How many rows of each provenance: the check that a read across the boundary lost neither side."""
    return with_provenance(df).groupBy("provenance").agg(F.count("*").alias("rows"))


def lake_totals(df: DataFrame) -> DataFrame:
    """Row count and the sum of input tokens."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum("input_tokens"), F.lit(0)).alias("input_tokens"))


def partition_count(df: DataFrame, date: str, app: str) -> DataFrame:
    """Rows of one (date, app): answered from that partition's files alone."""
    return df.filter((F.col("date") == F.lit(date).cast("date")) & (F.col("app") == app)).agg(F.count("*").alias("rows"))


def any_tenant_app(df: DataFrame) -> DataFrame:
    """Some tenant and some app of the rows."""
    return df.agg(F.any_value("tenant").alias("tenant"), F.any_value("app").alias("app"))


def ids_in_order(df: DataFrame) -> DataFrame:
    """Event id, the partition it lies in (date as text) and its tokens, ordered by id."""
    return df.select("event_id", "app", F.col("date").cast("string").alias("date"), "input_tokens").orderBy("event_id")


def tag(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Adds one tag of ``tags_json`` as a column; NULL where the event has no such tag."""
    return df.withColumn(name or key, F.from_json("tags_json", "map<string,string>")[key])


def list_items(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Adds the items of a JSON list column as an array."""
    return df.withColumn(name or f"{column}_items", F.from_json(column, "array<string>"))


def usage_by_tenant_day(rows: DataFrame) -> DataFrame:
    """Calls, tokens and cost per tenant and day."""
    return rows.groupBy("tenant", F.to_date("time").alias("date")).agg(
        F.count("*").alias("calls"),
        F.sum("input_tokens").alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.round(F.sum("cost_usd"), 2).alias("cost_usd"),
    )


def register_views(spark: SparkSession, lake: DataFrame, name: str = "lake") -> None:
    """The lake for SQL users: ``<name>``, ``<name>_deduped`` and ``<name>_provenance``."""
    lake.createOrReplaceTempView(name)
    dedupe(lake).createOrReplaceTempView(f"{name}_deduped")
    with_provenance(lake).createOrReplaceTempView(f"{name}_provenance")
