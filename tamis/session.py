"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# ANSI stays on (Spark 4 default): bad casts must be handled with try_* at the text boundary.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Call-site capture per column costs more than a second of driver time per wide mart.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def build_session(app: str = "tamis", master: str | None = None, **extra: str) -> SparkSession:
    """Session with the settings the operators rely on; ``master`` only for local runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder of the cluster (``spark.checkpoint.dir``); it must be set."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return shared.rstrip("/")


def ensure_scratch(spark: SparkSession) -> None:
    """For entry points: a local session without a shared folder gets one of this machine, where all its tasks run."""
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir():
        return
    if spark.sparkContext.master.startswith("local") and not spark.sparkContext.master.startswith("local-cluster"):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tamis-"))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has been given."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
