"""Run events as streams: failure filter and idempotent sync."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.operators.merge import new_rows
from fareloom.operators.runs import failed_runs, terminal_runs


def watch_failures(
    runs: DataFrame, path: str, checkpoint: str, jobs: list[str] | None = None
) -> StreamingQuery:
    """Append failed runs of a stream to parquet, taking all input available now."""
    return (
        failed_runs(runs, jobs)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


#: Parts of a history, by hash of the run.
BUCKETS = 64


def sync_stream(
    runs: DataFrame,
    path: str,
    checkpoint: str,
    schema: str,
    arrival: str | None = None,
    buckets: int = BUCKETS,
) -> StreamingQuery:
    """Keep a run history under ``path`` holding each finished run once.

    Every micro-batch writes the runs the history lacks into a folder of its own: below
    the id that Spark gave the checkpoint, then the batch number. A batch that is retried
    replaces its folder, so re-delivered events add nothing, and a query under another
    checkpoint can never meet an earlier one's folders. Unfinished runs are left for the
    event that finishes them.

    The history is kept in ``buckets`` by a hash of the run, and a micro-batch reads the keys
    of the buckets its own runs fall into. All writers of a path must give the same number.
    Of several deliveries of a run in one micro-batch the first by ``arrival`` stays; that
    column need not be in ``schema``. One query at a time may write to a path.
    """
    spark = runs.sparkSession
    bucket = F.pmod(F.xxhash64("run_id"), F.lit(buckets)).cast("int")

    def add(batch: DataFrame, batch_id: int) -> None:
        origin = json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        finished = terminal_runs(batch).withColumn("bucket", bucket)
        touched = [r["bucket"] for r in finished.select("bucket").distinct().collect()]
        own = (F.col("origin") == origin) & (F.col("batch") == batch_id)
        known = read_history(spark, path, schema).filter(F.col("bucket").isin(touched) & ~own)
        fresh = new_rows(known, finished, ["run_id"], arrival)
        if arrival and arrival not in known.columns:
            fresh = fresh.drop(arrival)
        fresh.write.mode("overwrite").partitionBy("bucket").parquet(
            f"{path}/origin={origin}/batch={batch_id}"
        )

    # The folder exists from the start, so the first batch reads an empty history.
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(
        f"{path}/origin=none/batch=-1/bucket=-1"
    )
    return (
        runs.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_history(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The history kept by :func:`sync_stream`, with what added each run: ``origin`` and ``batch``."""
    return spark.read.schema(f"{schema}, origin string, batch bigint, bucket int").parquet(path)
