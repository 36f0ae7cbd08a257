"""The training corpus, end to end: five stages over documents, each written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordlake.llm import decontaminate, jaccard_join, line_dedup, mixing, quality
from recordlake.llm.common import documents, labels, written

#: SQL cannot express the classifier; tests hold the stages against brute force instead.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier does not reject."""
    return quality.classify(docs, labels(spark, sf_dir)).where("predicted = 1").select("doc.*")


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of three lines or more that occurred before."""
    return line_dedup.dedup_lines(docs).select("doc.*")


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return jaccard_join.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contaminated(docs, benchmark).where(F.size("item_ids") == 0).select("doc.*")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies drawn, with the number and the shuffle key of each."""
    return mixing.mix(docs).select("doc.*", F.col("copy").alias("mix_copy"), F.col("shuffle_key").alias("mix_key"))


STAGES = [
    ("quality", good_quality),
    ("line_dedup", without_repeated_lines),
    ("jaccard_join", one_of_each_class),
    ("decontaminate", without_benchmark),
    ("mix", mixed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
