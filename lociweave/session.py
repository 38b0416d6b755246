"""Session settings the library is tuned for.

Every operator works on any session; these are the settings to start from.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "lociweave", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # alignment blocks are wide rows: keep Arrow batches small in bytes
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "256")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def _shared(spark: SparkSession) -> str:
    """The checkpoint folder that the cluster names in spark.checkpoint.dir; one of our own only where the session has none (tests, laptops)."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            shared = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(shared)
    return sc.getCheckpointDir()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name for one run, inside the folder that driver and executors share."""
    return f"{_shared(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the folder the cluster names in spark.checkpoint.dir."""
    _shared(df.sparkSession)
    return df.checkpoint(eager=True)
