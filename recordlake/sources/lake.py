"""Reading the lake: explicit schema, whole files only, pruned partitions."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.schema import LAKE_SCHEMA, PARTITION_COLUMNS
from recordlake.sinks.lake import lake_path


class SchemaMismatch(Exception):
    """A strict read met parts that do not hold a column the query asks for."""


def _scan(spark: SparkSession, root: str, prefix: str) -> DataFrame:
    """The lake's files under the contract's schema.

    The schema is never inferred: inference takes one file's columns for the
    whole lake's and turns an all-digit ``app`` into a number.  The glob keeps
    half-written ``*.parquet.incomplete`` files shut.
    """
    return spark.read.schema(LAKE_SCHEMA).option("pathGlobFilter", "*.parquet").parquet(lake_path(root, prefix))


def _app():
    """``app`` with its empty value back: a directory name cannot be empty, so it is stored as the null partition.

    This is the one column where NULL stands for ``''``; anywhere else NULL
    means that the part predates the column.
    """
    return F.coalesce("app", F.lit("")).alias("app")


def read_lake(
    spark: SparkSession, root: str, prefix: str = "", columns: Sequence[str] | None = None, strict: bool = False
) -> DataFrame:
    """The lake's rows, 40 columns and ``date``, or only ``columns``.

    A column that a part predates reads as NULL.  With ``strict`` such a part is
    an error instead, but only when ``columns`` asks for a column it lacks.
    """
    names = list(columns) if columns is not None else LAKE_SCHEMA.fieldNames()
    unknown = [n for n in names if n not in LAKE_SCHEMA.fieldNames()]
    if unknown:
        raise ValueError(f"no column {', '.join(unknown)}; columns are {', '.join(LAKE_SCHEMA.fieldNames())}")
    scan = _scan(spark, root, prefix)
    if strict:
        _refuse_missing(spark, root, prefix, names)
    return scan.select(*[_app() if n == "app" else F.col(n) for n in names])


def _opened(path: str) -> pa.NativeFile:
    """A file of any store that pyarrow knows, by the path as Spark lists it: nothing in it is an escape."""
    scheme, store, inside = re.fullmatch(r"(?:(\w[\w+.-]*):(?://([^/]*))?)?(.*)", path, re.DOTALL).groups()
    if scheme in (None, "file"):
        return fs.LocalFileSystem().open_input_file(inside)
    held, root = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{store or ''}/")
    return held.open_input_file(f"{root.rstrip('/')}{inside}")


def _lacking(names: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for part in batch.column("path").to_pylist():
                with _opened(part) as file:
                    held = set(pq.read_schema(file).names)
                missing = [n for n in names if n not in held]
                if missing:
                    found.append({"part": part, "columns": missing})
            yield pa.RecordBatch.from_pylist(found, pa.schema([("part", pa.string()), ("columns", pa.list_(pa.string()))]))

    return read


def parts_lacking(spark: SparkSession, root: str, prefix: str = "", columns: Sequence[str] | None = None) -> DataFrame:
    """``part`` and ``columns``: every part file whose footer lacks some of the columns, and which.

    Tasks list the files and read their footers, never their rows: a part that holds NULLs lacks
    nothing, and one without a single row is looked at too.
    """
    wanted = LAKE_SCHEMA.fieldNames() if columns is None else columns
    carried = [n for n in wanted if n not in PARTITION_COLUMNS]
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    paths = listed.load(lake_path(root, prefix)).select("path")
    return paths.mapInArrow(_lacking(carried), "part string, columns array<string>")


def _refuse_missing(spark: SparkSession, root: str, prefix: str, names: Sequence[str]) -> None:
    """Raise when a part lacks one of the columns."""
    if all(n in PARTITION_COLUMNS for n in names):
        return
    first = parts_lacking(spark, root, prefix, names).agg(F.min(F.struct("part", "columns")).alias("first")).first()["first"]
    if first is not None:
        missing = ", ".join(first["columns"])
        raise SchemaMismatch(
            f"schema mismatch: column {missing} could not be found in file {first['part']}; "
            "read without strict to take it as NULL"
        )


def lake_parts(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """One record per part file: its partition, rows, time span, size and age.

    Beside the flush log's ranges this leads from a file back to the messages.
    """
    meta = F.col("_metadata")
    return (
        _scan(spark, root, prefix)
        .select(
            "date",
            _app(),
            "time",
            meta["file_path"].alias("part"),
            meta["file_size"].alias("bytes"),
            meta["file_modification_time"].alias("written_at"),
        )
        .groupBy("date", "app", "part", "bytes", "written_at")
        .agg(F.count("*").alias("rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    )
