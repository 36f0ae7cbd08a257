"""What several operators share: rows carried whole, and tables that cut lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the shared folder and read back.

    A later stage then starts from files every executor can read, instead of
    from work that a lost executor takes with it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` that nothing reads any more, and let go of the shuffles that made later ones.

    Spark removes the files of a shuffle once the driver's collector finds its plan
    gone, which a driver with room to spare would put off until the disks are full.
    """
    for table in tables:
        jvm = table.sparkSession._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.scratch)
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    SparkSession.active()._jvm.System.gc()


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that no working column can clash with one of them."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns])


def refitted(docs: DataFrame, row: str, text: Column) -> list[Column]:
    """The columns of ``docs`` out of the struct ``row``, with ``text`` as the text and ``n_chars``, if any, made to fit."""
    cells = []
    for name, kind in [(f.name, f.dataType) for f in docs.schema]:
        value = {"text": text, "n_chars": F.length(text).cast(kind)}.get(name, F.col(row)[name])
        cells.append(value.alias(name))
    return cells


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


#: One in so many documents is held out of every training, by the checksum of its id.
FOLDS = 5


def held_out(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    """True for a document that no model may learn from; a row without an id counts as one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(True))
