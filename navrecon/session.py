"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Keep splitting hot join partitions even when a later shuffle is then needed.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "navrecon", **extra: str) -> SparkSession:
    """A session with the settings above; size shuffle partitions per cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from spark.checkpoint.dir.

    Only a local master may fall back to a temporary folder: on a cluster the
    executors could not see it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="navrecon-"))
    return sc.getCheckpointDir()


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Mark df for broadcast only after its size has been measured.

    df is computed once and kept on shared storage (checkpoint), so the check
    costs no second run. Above max_rows it is returned without a hint and the
    join shuffles, with AQE splitting hot partitions.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    kept = df.checkpoint(eager=True)
    return F.broadcast(kept) if kept.limit(max_rows + 1).count() <= max_rows else kept
