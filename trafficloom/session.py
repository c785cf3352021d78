"""Session settings for large runs, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from trafficloom.storage import delete_at_exit

# AQE coalesces shuffles down from spark.sql.shuffle.partitions, which has to be set to
# about shuffle bytes / 128 MB (the commands ask for it), and splits skewed rebalance
# partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

_local_root: str | None = None


def build_session(app_name: str = "trafficloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with ``SCALE_CONF``; pass further settings with dots as ``__``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = SCALE_CONF | {key.replace("__", "."): value for key, value in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a session whose driver is its executor may run without that setting; it gets
    a temporary folder.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="trafficloom-")
    return _local_root


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name that every executor can read and write.

    What is written there is deleted when the driver's JVM ends, if not before: results are
    lazy, and a query that has returned may still be read.
    """
    path = f"{_shared_root(spark)}/trafficloom/{purpose}-{uuid.uuid4().hex}"
    delete_at_exit(spark, path)
    return path


def checkpointed(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder, partitions as they are."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(_shared_root(spark))
    return frame.checkpoint()
