"""Exact quantiles of large columns, by distributed selection.

The built-in exact ``percentile`` keeps every distinct value of a group in one task.
Here the distinct values and their counts are range-partitioned, so that each part is an
interval of the order. The counts of the parts tell which of them holds a wanted rank;
only that part is kept, and partitioned again while it is larger than a bound. The cuts
come from the values themselves, so scales, outliers and infinities do not matter: no
task ever orders more than the bound.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareloom.session import shared_dir

#: Distinct values that one task may put in order.
TASK_VALUES = 200_000
#: Parts of a round at least; with fewer a round would hardly narrow anything.
LEAST_PARTS = 8


def melt(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Measures as rows (``measure``, ``value``); NULL and NaN are left out.

    ``measure`` is the position in ``measures``: grouping by two numbers is much
    cheaper than grouping by a name. :func:`named` puts the names back.
    """
    entries = F.array(
        *[
            F.struct(F.lit(place).alias("measure"), F.col(m).cast("double").alias("value"))
            for place, m in enumerate(measures)
        ]
    )
    return (
        df.select(F.explode(entries).alias("e"))
        .select("e.*")
        .filter(F.col("value").isNotNull() & ~F.isnan("value"))
    )


def named(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Measure positions as names."""
    names = F.array(*[F.lit(m) for m in measures])
    return df.withColumn("measure", F.element_at(names, F.col("measure") + 1))


def value_counts(melted: DataFrame) -> DataFrame:
    """Number of times each value of each measure occurs."""
    return melted.groupBy("measure", "value").agg(F.count(F.lit(1)).alias("n"))


def stored_counts(melted: DataFrame) -> DataFrame:
    """:func:`value_counts`, written to the shared folder: a selection reads them several times."""
    counts, path = value_counts(melted), shared_dir(melted.sparkSession, "value-counts")
    counts.write.parquet(path)
    return melted.sparkSession.read.schema(counts.schema).parquet(path)


def exact_quantiles(
    counts: DataFrame, probabilities: Sequence[float], task_values: int = TASK_VALUES
) -> DataFrame:
    """Linear-interpolated quantiles of value counts, one row per measure and probability.

    ``counts`` is best a stored table (:func:`stored_counts`), as every round reads it.
    Infinities are values like others, at the ends of the order. A quantile that lies between
    two values of which one is infinite is that infinity; between both, it is NaN.
    The search runs at once: its rounds are jobs. Only the searched ranks, a few for each
    measure and probability, reach the driver.
    """
    spark, found = counts.sparkSession, []
    part = _ranged(counts.withColumn("_range", F.lit(0)), task_values)
    targets = _wanted(part, probabilities)
    while True:
        located = _located(part, targets)
        rows = [r.asDict() for r in located.collect()]
        # The kept intervals are numbered; targets in one interval share it.
        spans = {(r["measure"], r["_lo"], r["_hi"]) for r in rows if r["_rows"] > task_values}
        number = {span: place for place, span in enumerate(sorted(spans))}
        done = [r for r in rows if r["_rows"] <= task_values]
        if done:
            found.append(_picked(part, spark.createDataFrame(done, located.schema)))
        if not number:
            break
        left = [r | {"_range": number[r["measure"], r["_lo"], r["_hi"]]} for r in rows if r["_rows"] > task_values]
        targets = spark.createDataFrame(left, located.schema)
        place = reduce(
            lambda expr, span: expr.when(
                (F.col("measure") == span[0]) & F.col("value").between(span[1], span[2]), F.lit(number[span])
            ),
            number,
            F,
        )
        part = _ranged(part.withColumn("_range", place).filter(F.col("_range").isNotNull()), task_values)
    if not found:
        return counts.select("measure", F.lit(0.0).alias("probability"), "value").limit(0)
    return _interpolate(reduce(DataFrame.unionAll, found))


def _ranged(counts: DataFrame, task_values: int) -> DataFrame:
    """The counts of each interval (``_range``), cut into parts by value.

    The parts are stored, because another run would cut elsewhere. What fits a task stays whole.
    """
    spark, size = counts.sparkSession, counts.count()
    kept = counts.select("measure", "_range", "value", "n")
    if size <= task_values:
        return kept.withColumn("_part", F.lit(0))
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Twice the parts that would do, as ranges are drawn from a sample.
    parts = max(LEAST_PARTS, min(-(-2 * size // task_values), 16 * usual))
    ranged = kept.repartitionByRange(parts, "measure", "_range", "value").withColumn("_part", F.spark_partition_id())
    path = shared_dir(spark, "value-ranges")
    ranged.write.parquet(path)
    return spark.read.schema(ranged.schema).parquet(path)


def _wanted(part: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Ranks to find: floor and ceiling of every quantile's position; no rows are passed yet."""
    asked = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    ranks = F.array_distinct(F.array(F.floor("_position"), F.ceil("_position")))
    return (
        part.groupBy("measure")
        .agg(F.sum("n").alias("_n"))
        .select("measure", "_n", asked.alias("probability"))
        .withColumn("_position", F.col("probability") * (F.col("_n") - 1))
        .select(
            "measure", "probability", "_position", F.explode(ranks).alias("_rank"),
            F.lit(0).alias("_range"), F.lit(0).cast("long").alias("_below"),
        )
    )


def _located(part: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with the part of its interval that holds its rank.

    ``_below`` is the number of rows below the interval, then below the part.
    """
    parts = part.groupBy(F.col("measure").alias("_m"), F.col("_range").alias("_r"), "_part").agg(
        F.sum("n").alias("_in"), F.count(F.lit(1)).alias("_rows"),
        F.min("value").alias("_lo"), F.max("value").alias("_hi"),
    )
    keys = ["measure", "probability", "_position", "_rank"]
    # Targets are a few rows for each measure and probability; parts are as many as tasks.
    started = targets.select(*keys, "_range", F.col("_below").alias("_start"))
    met = parts.join(F.broadcast(started), (F.col("_m") == F.col("measure")) & (F.col("_r") == F.col("_range")))
    ahead = Window.partitionBy("measure", "probability", "_rank").orderBy("_lo")
    return (
        met.withColumn("_upto", F.col("_start") + F.sum("_in").over(ahead.rowsBetween(Window.unboundedPreceding, 0)))
        .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_in")))
        .select(*keys, "_range", (F.col("_upto") - F.col("_in")).alias("_below"), "_rows", "_lo", "_hi")
    )


def _picked(part: DataFrame, targets: DataFrame) -> DataFrame:
    """The value at each rank, from the ordered values of one part."""
    t = targets.withColumnRenamed("measure", "_m")
    inside = (F.col("measure") == F.col("_m")) & F.col("value").between(F.col("_lo"), F.col("_hi"))
    order = Window.partitionBy("measure", "probability", "_rank").orderBy("value")
    return (
        part.join(F.broadcast(t), inside)
        .withColumn("_upto", F.col("_below") + F.sum("n").over(order))
        .filter((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("n")))
        .select("measure", "probability", "_position", "_rank", "value")
    )


def _interpolate(picked: DataFrame) -> DataFrame:
    fraction = F.first("_position") - F.floor(F.first("_position"))
    low, high = F.min_by("value", "_rank"), F.max_by("value", "_rank")
    infinite = F.lit(float("inf"))
    between = (
        F.when((low == high) | (fraction == 0), low)
        .when((F.abs(low) == infinite) & (F.abs(high) == infinite), F.lit(float("nan")))
        .when(F.abs(low) == infinite, low)
        .when(F.abs(high) == infinite, high)
        .otherwise(low + (high - low) * fraction)
    )
    return picked.groupBy("measure", "probability").agg(between.alias("value"))
