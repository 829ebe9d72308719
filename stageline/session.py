"""Session settings and the shared folder that every written step goes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def build_session(app_name: str = "stageline", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the library is tuned for.

    Nothing here is sized to one data scale: AQE coalesces shuffle partitions to
    ``advisoryPartitionSizeInBytes`` and splits skewed ones, so only the initial
    partition count (``shuffle_partitions_for``) follows the data.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # the default, INT96, has no statistics, so that no bound on a time skips data
        "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
        # state for millions of keys lives off the heap
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 128 * 1024 * 1024) -> int:
    """Initial shuffle partitions so that one holds about ``target_bytes``."""
    return max(200, -(-shuffle_bytes // target_bytes))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, asked of the file system of ``path``."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder, seen by all executors, for written steps and checkpoints.

    The cluster names the root in ``spark.checkpoint.dir``. Where it is not set, the
    folder lies in the session's warehouse, which all executors share too.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    root = root or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/stageline/{purpose}-{uuid.uuid4().hex}"
