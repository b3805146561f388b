"""Writers of the silver, gold and warehouse layers.

Nothing here overwrites a path that the same plan reads.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareloom.operators.contract import require_row_count
from fareloom.operators.gold import gold_cube, gold_summaries
from fareloom.operators.star import Star

COMPRESSION = "snappy"


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str] = ()) -> None:
    """Overwrite ``path``, one folder per partition value.

    The rebalance hint gathers a partition's rows before the write and lets
    adaptive execution cut an oversized one into several files, so a month that
    holds a third of the rows is not one task.
    """
    writer = df.hint("rebalance", *partitions) if partitions else df.hint("rebalance")
    out = writer.write.mode("overwrite").option("compression", COMPRESSION)
    if partitions:
        out = out.partitionBy(*partitions)
    out.parquet(path)


def write_silver(silver: DataFrame, path: str) -> None:
    """Silver, partitioned by pickup year and month."""
    write_partitioned(silver, path, ["pickup_year", "pickup_month"])


def write_many(datasets: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> list[str]:
    """Write name -> (frame, path, partition columns) in order; the first failure stops the rest."""
    done = []
    for name, (df, path, partitions) in datasets.items():
        write_partitioned(df, path, partitions)
        done.append(name)
    return done


def publish_gold(trips: DataFrame, root: str) -> list[str]:
    """Store the cube, then all five summaries; the trips are read twice."""
    spark = trips.sparkSession
    cube_path = f"{root}/_cube"
    write_partitioned(gold_cube(trips), cube_path)
    summaries = gold_summaries(trips, spark.read.parquet(cube_path))
    return write_many({name: (df, f"{root}/{name}", ()) for name, df in summaries.items()})


def write_snapshot(df: DataFrame, path: str, target_bytes: int | None = None) -> None:
    """A parquet snapshot in as many files as its bytes need.

    The rows are shuffled, and adaptive execution joins or cuts the partitions by their
    measured bytes: a small table is one file, a large one is never written by one task.
    ``target_bytes`` is the size aimed at, before compression by the file format; without
    it the session's ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` holds. What one
    input partition sends to one shuffle partition is not cut further.
    """
    spark = df.sparkSession
    settings = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    if target_bytes:
        settings["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(target_bytes)
        settings["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = str(min(target_bytes, 1 << 20))
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        df.hint("rebalance").write.mode("overwrite").option("compression", COMPRESSION).parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def sorted_by_time(df: DataFrame, column: str, partitions: int | None = None) -> DataFrame:
    """Rows in time order across files, for row-group skipping.

    A hash of the row is part of the range key, so one timestamp shared by very
    many rows is spread over several partitions.
    """
    spread = df.withColumn("_spread", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    keys = [F.col(column), F.col("_spread")]
    ranged = spread.repartitionByRange(partitions, *keys) if partitions else spread.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(column).drop("_spread")


def order_violations(df: DataFrame, column: str) -> DataFrame:
    """Whether stored files are in the order of ``column``: violations of two rules, zero for both if so.

    ``df`` is a plain scan of parquet files. ``inside_files`` counts rows smaller than the row
    before them in their file, by the file's own row numbers. ``between_files`` counts files
    whose range begins before that of the files before it ends, so that one value could be
    in several; files may share an end. NULLs are left out.
    """
    placed = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"), F.col(column).alias("value")
    ).filter(F.col("value").isNotNull())
    # A file is what one task wrote; its rows are in one task here as well.
    before = F.lag("value").over(Window.partitionBy("file").orderBy("row"))
    inside = placed.withColumn("_before", before).agg(
        F.count_if(F.col("value") < F.col("_before")).alias("violations")
    )
    files = placed.groupBy("file").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    # One row for each file.
    reach = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    between = files.withColumn("_reach", reach).agg(F.count_if(F.col("low") < F.col("_reach")).alias("violations"))
    return inside.select(F.lit("inside_files").alias("rule"), "violations").unionAll(
        between.select(F.lit("between_files").alias("rule"), "violations")
    )


def publish_star(
    star: Star, root: str, expected: Mapping[str, int], *, fact_files: int | None = None
) -> dict[str, str]:
    """Write the star under ``root`` after its row-count gate: dimensions first, then the fact.

    ``expected`` names the dimension row counts to insist on; nothing is written
    when one is off. Point readers at ``root`` only after this returns.
    """
    tables = star.tables()
    fact = tables.pop("fact_trips")
    for name, count in expected.items():
        require_row_count(tables[name], count, name)
    for name, df in tables.items():
        write_snapshot(df, f"{root}/{name}")
    shaped = fact.hint("rebalance") if fact_files is None else fact.repartition(fact_files)
    shaped.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{root}/fact_trips")
    return {name: f"{root}/{name}" for name in [*tables, "fact_trips"]}


@dataclass(frozen=True)
class RunSummary:
    """Outcome of one job run."""

    job_name: str
    status: str
    start_time: datetime
    end_time: datetime
    inserted: int = 0
    updated: int = 0
    no_change: int = 0
    errors: int = 0


def run_summary_frame(spark: SparkSession, summary: RunSummary) -> DataFrame:
    """The summary as one row with its counters nested and its duration in seconds."""
    values = asdict(summary)
    row = spark.createDataFrame(
        [tuple(values.values())],
        "job_name string, status string, start_time timestamp_ntz, end_time timestamp_ntz, "
        "inserted long, updated long, no_change long, errors long",
    )
    return row.select(
        "job_name",
        "status",
        "start_time",
        "end_time",
        F.lit((summary.end_time - summary.start_time).total_seconds()).alias("duration_seconds"),
        F.struct("inserted", "updated", "no_change", "errors").alias("execution_summary"),
    )


def append_run_summary(spark: SparkSession, summary: RunSummary, path: str) -> None:
    """Append the summary to a JSON-lines run log."""
    run_summary_frame(spark, summary).write.mode("append").json(path)
