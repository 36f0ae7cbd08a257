"""Session settings the engine relies on, and the shared folder for derived tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings that are right at any size.  Parallelism and memory stay with the cluster's own configuration.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # A task holds one batch of messages as a whole, of some 50 KB each, beside the memory that Spark accounts for.
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

_local_dirs: dict[str, str] = {}


def configure(spark: SparkSession) -> SparkSession:
    """Apply ``SETTINGS`` to a session that is already running."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str | int = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own.

    The two sizes fit test data, so that adaptive execution leaves work for every
    core; at full size the defaults or more are right.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("recordlake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of this machine:
    on a cluster no executor would see it.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getConf().get(CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_dirs:
        _local_dirs[application] = tempfile.mkdtemp(prefix="recordlake-")
    return _local_dirs[application]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder; nothing is created there yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
