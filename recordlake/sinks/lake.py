"""Rows into the lake: ZSTD Parquet under ``<root>/<prefix>/date=YYYY-MM-DD/app=X/``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.schema import LAKE_SCHEMA, PARTITION_COLUMNS


def lake_path(root: str, prefix: str) -> str:
    """One table per stream: ``root/ledger``, ``root/audit``.  Any store Spark has a path for will do."""
    return f"{root.rstrip('/')}/{prefix}" if prefix else root.rstrip("/")


def with_date(rows: DataFrame) -> DataFrame:
    """Rows with ``date``, the UTC day of ``time``: derived, so it can never disagree with the time."""
    return rows.withColumn("date", F.to_date("time"))


def laid_out(rows: DataFrame) -> DataFrame:
    """Rows arranged for the write: few large files per (date, app), and no task that holds a whole hot one.

    Rebalancing shuffles by the partition columns, after which adaptive
    execution splits an (date, app) that outgrows the advisory size and merges
    the small ones, from the sizes it measured.
    """
    dated = with_date(rows).select(*LAKE_SCHEMA.fieldNames())
    return dated.hint("rebalance", *PARTITION_COLUMNS)


def write_lake(rows: DataFrame, root: str, prefix: str = "", max_records_per_file: int = 0) -> None:
    """Append rows to the lake.  No rows write no file.

    Spark's commit protocol makes a failed write leave whole files or none; a
    retry appends again and readers remove the copies with ``dedupe``.
    """
    writer = laid_out(rows).write.mode("append").partitionBy(*PARTITION_COLUMNS).option("compression", "zstd")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.parquet(lake_path(root, prefix))


def write_apart(rows: DataFrame, number: str, count: int, root: str, prefix: str = "") -> None:
    """Append rows to the lake, those of every ``number`` from 0 to below ``count`` in parts of their own; a task holds one number's."""
    dated = with_date(rows).select(number, *LAKE_SCHEMA.fieldNames()).repartitionById(count, F.col(number).cast("int")).drop(number)
    dated.write.mode("append").partitionBy(*PARTITION_COLUMNS).option("compression", "zstd").parquet(lake_path(root, prefix))
