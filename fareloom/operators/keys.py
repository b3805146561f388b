"""Surrogate keys without a single-task numbering step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def assign_ids(
    df: DataFrame,
    unique: Sequence[str],
    id_column: str,
    start_after: DataFrame | int = 0,
    buckets: int = 4096,
    in_order: str | None = None,
    step: int = 1_000_000,
) -> DataFrame:
    """Number the rows 1, 2, 3, ... after ``start_after``.

    ``unique`` names columns that together identify a row. Rows are spread over
    hash buckets, numbered inside their bucket, and shifted by the number of rows
    in earlier buckets; only the bucket totals (at most ``buckets`` rows) are
    ordered in one task. The numbering depends on the data alone, so a repeated
    task gives the same ids. ``start_after`` is a number or a one-cell frame.

    ``in_order`` names a whole number, such as a version: rows that agree in ``unique``
    get ids in its order. Each ``step`` of its values has buckets of its own, after
    those of the step before, so that no bucket has more than ``step`` rows of one key.
    """
    names = [c for c in df.columns if c != id_column]
    bucket = F.pmod(F.xxhash64(*unique), F.lit(buckets)).cast("long")
    order = list(unique)
    if in_order:
        bucket += F.floor(F.col(in_order) / step).cast("long") * buckets
        order.append(in_order)
    spread = df.select(*names).withColumn("_bucket", bucket)
    numbered = spread.withColumn(
        "_place", F.row_number().over(Window.partitionBy("_bucket").orderBy(*order))
    )
    sizes = spread.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    if isinstance(start_after, DataFrame):
        start = F.coalesce(start_after.scalar(), F.lit(0))
    else:
        start = F.lit(start_after)
    # The number of steps has no fixed bound, so there Spark chooses the join.
    offsets = offsets if in_order else F.broadcast(offsets)
    return numbered.join(offsets, "_bucket").select(
        *names, (start + F.col("_offset") + F.col("_place")).cast("long").alias(id_column)
    )


def highest_id(df: DataFrame, id_column: str) -> DataFrame:
    """One cell: the highest id in use, at least zero."""
    return df.agg(F.greatest(F.coalesce(F.max(id_column), F.lit(0)), F.lit(0)).alias(id_column))
