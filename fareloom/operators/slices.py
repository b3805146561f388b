"""Cutting the ordered rows of hot keys into slices of about equal depth.

A window over (key, slice) lets many tasks share one key, whatever the values of the
order column are: the cuts come from the rows, not from a grid of values. Only keys with
more rows than a slice are cut; everything else is slice 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fareloom.session import shared_dir

#: Rows of one key that a task may have to order.
SLICE_ROWS = 1_000_000
#: Cuts are looked up in two steps, first among every so many.
STEP = 64


def cut_slices(
    df: DataFrame, key: str, order: str, rows: int = SLICE_ROWS
) -> DataFrame | None:
    """Where to cut the keys of ``df`` that have more than about ``rows`` rows.

    Key and order column are range-partitioned and sorted, and every part is dealt into blocks
    of ``rows``; a key that runs over a block's end is cut where the next block begins. Small
    slices do not make more parts than a shuffle usually has, or than :data:`SLICE_ROWS` rows a
    part need: every part sends a sample and a result to the driver. Result: the cut keys as ``_cut_key`` with their cuts, in
    order, written to the shared folder because another run would cut elsewhere; None
    when there is nothing to cut. The order column must not be NULL and should be unique
    in a key: equal values stay in one slice.
    """
    spark = df.sparkSession
    narrow = df.select(F.col(key).alias("_cut_key"), F.col(order).alias("_at"))
    size = narrow.count()
    if size <= rows:
        return None
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = min(-(-size // rows), max(usual, -(-size // SLICE_ROWS)))
    place = F.struct("_cut_key", "_at")
    # The id is the part's number, then the row's in it.
    row = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    edges = (
        narrow.repartitionByRange(parts, "_cut_key", "_at")
        .sortWithinPartitions("_cut_key", "_at")
        .withColumn("_row", F.monotonically_increasing_id())
        .groupBy(F.shiftright("_row", 33).alias("_part"), F.floor(row / rows).alias("_block"))
        .agg(F.min(place).alias("_low"), F.max(place).alias("_high"))
    )
    # One row for each block. A cut among equal values comes before all of them.
    before = F.lag("_high").over(Window.orderBy("_part", "_block"))
    cuts = (
        edges.withColumn("_before", before)
        .filter(F.col("_before._cut_key") == F.col("_low._cut_key"))
        .groupBy(F.col("_low._cut_key").alias("_cut_key"))
        .agg(F.sort_array(F.collect_set("_low._at")).alias("_cuts"))
    )
    path = shared_dir(spark, "slice-cuts")
    cuts.write.parquet(path)
    return spark.read.schema(cuts.schema).parquet(path)


def with_slices(
    df: DataFrame, cuts: DataFrame | None, key: str, order: Column
) -> DataFrame:
    """``df`` with the number of each row's slice in its key as ``_slice``.

    The cuts are fewer than the blocks they come from, so they are broadcast.
    """
    if cuts is None:
        return df.withColumn("_slice", F.lit(0).cast("long"))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_cuts") - 1) / STEP).cast("int")),
        lambda i: F.slice("_cuts", i * STEP + 1, F.lit(STEP)),
    )
    stepped = cuts.select("_cut_key", runs.alias("_runs")).withColumn(
        "_heads", F.transform("_runs", lambda run: run[0])
    )
    joined = df.withColumn("_order", order).join(
        F.broadcast(stepped), F.col(key) == F.col("_cut_key"), "left"
    )
    run = F.size(F.filter("_heads", lambda cut: cut <= F.col("_order")))
    inside = F.size(F.filter(F.element_at("_runs", F.col("_run")), lambda cut: cut <= F.col("_order")))
    number = F.when(F.col("_run") > 0, (F.col("_run") - 1) * STEP + inside).otherwise(0)
    return (
        joined.withColumn("_run", F.when(F.col("_heads").isNotNull(), run).otherwise(0))
        .withColumn("_slice", number.cast("long"))
        .drop("_order", "_cut_key", "_runs", "_heads", "_run")
    )


def slices_of(cuts: DataFrame) -> DataFrame:
    """Every slice of the cut keys: ``_cut_key`` and ``_slice``."""
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.size("_cuts").cast("long")))
    return cuts.select("_cut_key", every.alias("_slice"))
