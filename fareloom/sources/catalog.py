"""Registration of stored layers for SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(frames: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Temporary views under ``prefix`` + name."""
    names = []
    for name, df in frames.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def register_table(spark: SparkSession, database: str, name: str, path: str) -> str:
    """An external table over stored parquet, partitions discovered."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    full = f"`{database}`.`{name}`"
    escaped = path.replace("'", "\\'")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {full} USING parquet LOCATION '{escaped}'")
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
        spark.sql(f"MSCK REPAIR TABLE {full}")
    return f"{database}.{name}"
