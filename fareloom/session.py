"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Settings the operators rely on. Partition counts and memory stay with the cluster.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key also where the split costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Largest row count that may be broadcast; dimension rows here are under 200 bytes.
BROADCAST_ROWS = 500_000


def get_session(app: str = "fareloom", master: str | None = None, **extra: str) -> SparkSession:
    """Build or fetch a session carrying :data:`SQL_SETTINGS`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Give a session built elsewhere the same SQL settings."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the cluster's ``spark.checkpoint.dir``.

    Only a local session, whose executors are the driver's own threads, may do without that setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="fareloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` has at most ``max_rows`` rows.

    The count stops after ``max_rows + 1`` rows. A larger side keeps the shuffled
    join, whose skewed partitions adaptive execution splits.
    """
    if df.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(df)
    return df


def broadcast_if_bounded(df: DataFrame, bound: int, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when the caller can prove ``df`` has at most ``bound`` rows."""
    return F.broadcast(df) if bound <= max_rows else df
