"""Session settings the operators rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "sunledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume; cluster sizing stays with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return pin_session(builder.getOrCreate())


def pin_session(spark: SparkSession) -> SparkSession:
    """UTC session zone (instants print as UTC), adaptive execution with skew handling, and joins on
    (asset_id, ts_utc) that accept inputs partitioned by series and range (see `features.partitioned_by_range`)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir`, or a temporary one on a local master only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="sunledger-")
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for an intermediate table."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
