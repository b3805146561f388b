"""Threshold alarms over tumbling windows, in batch or as a stream."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from fareloom.functions.numeric import exact_rest, exact_sum, exact_units, total_of
from fareloom.operators.runs import ALARMS, Alarm, breaching, seconds_of


def alarms(points: DataFrame, rules: Sequence[Alarm] = ALARMS) -> DataFrame:
    """Breaching windows of all alarms over a static table of metric points.

    Points are read and grouped once: each point is handed to the rules on its
    metric, and the window length comes from the rule.
    """
    place = {rule: F.lit(number) for number, rule in enumerate(rules)}
    wanted = reduce(
        lambda expr, metric: expr.when(
            F.col("metric") == metric, F.array(*[place[r] for r in rules if r.metric == metric])
        ),
        dict.fromkeys(r.metric for r in rules),
        F,
    )

    def by_rule(value) -> Column:
        return F.element_at(F.array(*[F.lit(value(r)) for r in rules]), F.col("rule") + 1)

    period = by_rule(lambda r: seconds_of(r) * 1_000_000)
    grouped = (
        points.withColumn("rule", F.explode(wanted))
        .withColumn("_start", F.floor(F.unix_micros("ts") / period) * period)
        .groupBy("rule", "_start")
        .agg(exact_sum("value").alias("_sum"), F.max("value").alias("_max"))
    )
    value = F.when(by_rule(lambda r: r.statistic == "sum"), F.col("_sum")).otherwise(F.col("_max"))
    limit = by_rule(lambda r: float(r.threshold))
    over = F.when(by_rule(lambda r: r.inclusive), F.col("value") >= limit).otherwise(
        F.col("value") > limit
    )

    def moment(micros: Column) -> Column:
        return F.timestamp_micros(micros).cast("timestamp_ntz")

    return grouped.withColumn("value", value).filter(over).select(
        by_rule(lambda r: r.name).alias("alarm"),
        moment(F.col("_start")).alias("window_start"),
        moment(F.col("_start") + period).alias("window_end"),
        "value",
    )


#: What a micro-batch keeps of a window: parts that add up with those of other batches.
WINDOW_SCHEMA = (
    "alarm string, window_start timestamp_ntz, window_end timestamp_ntz, units decimal(38,18), "
    "rest double, highest double, points bigint, late bigint, batch bigint"
)
MARK_SCHEMA = "newest timestamp_ntz, batch bigint"


def alarm_stream(
    points: DataFrame, rule: Alarm, path: str, checkpoint: str, delay: str = "1 hour"
) -> StreamingQuery:
    """Follow one alarm over a stream of ``points`` (``ts``, ``metric``, ``value``).

    Every micro-batch adds up its own points by window and stores the partial sums,
    largest values and counts under ``path``; :func:`stored_alarms` combines them. There is
    no watermark and no state that it could drop, so a point enters its window however
    late it comes. Points older by more than ``delay`` than the newest of the batches
    before are counted as late; :func:`late_points` lists them. A retried micro-batch
    replaces its own folders.
    """
    spark = points.sparkSession
    for kind, schema in (("windows", WINDOW_SCHEMA), ("marks", MARK_SCHEMA)):
        # The folders exist from the start, so the first batch reads empty tables.
        try:
            spark.read.schema(schema).parquet(f"{path}/{kind}")
        except AnalysisException:
            empty = spark.createDataFrame([], schema).drop("batch")
            empty.write.mode("overwrite").parquet(f"{path}/{kind}/batch=-1")

    def store(batch: DataFrame, batch_id: int) -> None:
        wanted = batch.filter((F.col("metric") == rule.metric) & F.col("ts").isNotNull())
        marks = spark.read.schema(MARK_SCHEMA).parquet(f"{path}/marks")
        newest = marks.filter(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]
        partial_windows(wanted, rule, newest, delay).write.mode("overwrite").parquet(
            f"{path}/windows/batch={batch_id}"
        )
        wanted.agg(F.max("ts").cast("timestamp_ntz").alias("newest")).write.mode("overwrite").parquet(
            f"{path}/marks/batch={batch_id}"
        )

    return (
        points.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def partial_windows(points: DataFrame, rule: Alarm, newest: datetime | None, delay: str) -> DataFrame:
    """The points by window, in parts that can be added to those of other points.

    ``newest`` is the time of the newest point before these.
    """
    at = F.col("ts").cast("timestamp_ntz")
    if newest is None:
        late = F.lit(False)
    else:
        late = at < F.lit(newest).cast("timestamp_ntz") - F.expr(f"interval {delay}")
    return (
        points.groupBy(F.window("ts", rule.period).alias("w"))
        .agg(
            F.sum(exact_units("value")).cast("decimal(38,18)").alias("units"),
            F.sum(exact_rest("value")).alias("rest"),
            F.max("value").cast("double").alias("highest"),
            F.count(F.lit(1)).alias("points"),
            F.count_if(late).alias("late"),
        )
        .select(
            F.lit(rule.name).alias("alarm"),
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "units", "rest", "highest", "points", "late",
        )
    )


def read_windows(spark: SparkSession, path: str) -> DataFrame:
    """The partial windows kept by :func:`alarm_stream`, with the batch of each."""
    return spark.read.schema(WINDOW_SCHEMA).parquet(f"{path}/windows")


def stored_alarms(windows: DataFrame, rule: Alarm) -> DataFrame:
    """Breaching windows from :func:`read_windows`, all batches added up."""
    total = total_of(F.sum("units"), F.sum("rest")) if rule.statistic == "sum" else F.max("highest")
    whole = windows.groupBy("alarm", "window_start", "window_end").agg(total.alias("value"))
    return breaching(whole, rule)


def late_points(windows: DataFrame) -> DataFrame:
    """Windows that points reached late: how many, of how many. All are in the window's value."""
    return (
        windows.groupBy("alarm", "window_start", "window_end")
        .agg(F.sum("late").alias("late"), F.sum("points").alias("points"))
        .filter(F.col("late") > 0)
    )
