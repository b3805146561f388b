"""Full-refresh warehouse loads that all tables enter at once.

A load writes every table under a name of its own, analyses it, and only then moves
one pointer: a view that says which load is current. Moving it is a single catalog
change, so a reader sees the tables of one load, whole, before and after; a load that
fails on the way is never seen. Tables of a load are never changed, so frames opened
from it stay readable until it is dropped.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fareloom.operators.tieout import row_count_manifest

#: Name of the view that holds the current load.
POINTER = "current_load"


@dataclass(frozen=True)
class Load:
    """One load of a database: its id and the tables in it."""

    database: str
    load_id: str
    tables: tuple[str, ...]

    def table_name(self, name: str) -> str:
        """Catalog name of a table of this load."""
        if name not in self.tables:
            raise ValueError(f"load {self.load_id} has no table {name}")
        return f"`{self.database}`.`{name}__{self.load_id}`"

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        return spark.table(self.table_name(name))

    def frames(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {name: self.read(spark, name) for name in self.tables}

    def attach(self, spark: SparkSession) -> None:
        """Plain table names as temporary views of this session, for SQL over one load."""
        for name, df in self.frames(spark).items():
            df.createOrReplaceTempView(name)


def stage_load(spark: SparkSession, paths: Mapping[str, str], database: str) -> Load:
    """Write and analyse all tables of a new load. Readers do not see it yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    load = Load(database, uuid.uuid4().hex, tuple(sorted(paths)))
    for name, path in paths.items():
        spark.read.parquet(path).write.format("parquet").saveAsTable(load.table_name(name))
        spark.sql(f"ANALYZE TABLE {load.table_name(name)} COMPUTE STATISTICS FOR ALL COLUMNS")
    return load


def publish_load(spark: SparkSession, load: Load) -> None:
    """Make the load the current one, by one change of the pointer.

    Of two loads published at a time one ends up current, with all its tables.
    """
    listed = ", ".join(f"'{name}'" for name in load.tables)
    body = f"SELECT '{load.load_id}' AS load_id, array({listed}) AS tables"
    pointer = f"`{load.database}`.`{POINTER}`"
    # ALTER changes the view in place; CREATE OR REPLACE would drop it first.
    if spark.catalog.tableExists(f"{load.database}.{POINTER}"):
        spark.sql(f"ALTER VIEW {pointer} AS {body}")
    else:
        spark.sql(f"CREATE VIEW {pointer} AS {body}")


def current_load(spark: SparkSession, database: str) -> Load | None:
    """The load that readers see, or None before the first."""
    if not spark.catalog.tableExists(f"{database}.{POINTER}"):
        return None
    row = spark.table(f"`{database}`.`{POINTER}`").first()
    return Load(database, row.load_id, tuple(row.tables))


def load_warehouse(spark: SparkSession, paths: Mapping[str, str], database: str) -> DataFrame:
    """Load all tables, check that none lost a row, let them in at once, and report row counts."""
    load = stage_load(spark, paths, database)
    counts = {r.table_name: r.row_count for r in row_count_manifest(load.frames(spark)).collect()}
    given = row_count_manifest({name: spark.read.parquet(path) for name, path in paths.items()})
    for row in given.collect():
        if counts[row.table_name] != row.row_count:
            raise ValueError(
                f"{row.table_name}: {counts[row.table_name]} rows staged of {row.row_count}"
            )
    publish_load(spark, load)
    return row_count_manifest(load.frames(spark))


def drop_other_loads(spark: SparkSession, database: str, keep: tuple[Load, ...] = ()) -> list[str]:
    """Drop the tables of loads that are neither current nor in ``keep``; their names.

    Also removes what failed loads left. Run it when no reader holds an older load and no
    load is under way.
    """
    now = current_load(spark, database)
    ids = {load.load_id for load in (*keep, *([now] if now else []))}
    dropped = []
    for table in spark.catalog.listTables(database):
        name, mark, load_id = table.name.rpartition("__")
        if mark and len(load_id) == 32 and load_id not in ids:
            spark.sql(f"DROP TABLE `{database}`.`{table.name}`")
            dropped.append(name)
    return sorted(dropped)
