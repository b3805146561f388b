"""All named queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fareloom.plans import master_queries, run_queries, storage_queries, trip_queries
from fareloom.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]
MODULES = (trip_queries, master_queries, run_queries, storage_queries)


def _with_settings(query: Query) -> Query:
    return lambda spark, sf_dir: query(apply_settings(spark), sf_dir)


def queries() -> dict[str, Query]:
    """Every query, run under the library's session settings."""
    return {
        name: _with_settings(fn) for module in MODULES for name, fn in module.QUERIES.items()
    }


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
