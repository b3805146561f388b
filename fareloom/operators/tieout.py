"""Cross-layer tie-outs: the same summary computed from two layers must agree."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def tie_out(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    value: str,
    *,
    tolerance: float = 0.0,
    digits: int | None = None,
) -> DataFrame:
    """Compare ``value`` of two summaries by ``keys``.

    Both sides hold one row per key. ``digits`` rounds the right side first. A key
    found on one side only fails, as does a NULL on either side.
    """
    a = left.select(*keys, F.col(value).alias("left_value"), F.lit(True).alias("_in_left"))
    b = right.select(*keys, F.col(value).alias("right_value"), F.lit(True).alias("_in_right"))
    both = a.join(b, list(keys), "full_outer")
    right_value = F.col("right_value") if digits is None else F.round("right_value", digits)
    gap = F.abs(F.col("left_value") - right_value)
    # Cents are compared with a little room for the binary form of the tolerance itself.
    room = tolerance + 1e-9 if tolerance else 0.0
    agrees = F.col("_in_left") & F.col("_in_right") & (gap <= F.lit(room))
    return both.select(
        *keys,
        "left_value",
        right_value.alias("right_value"),
        F.when(F.coalesce(agrees, F.lit(False)), "PASS").otherwise("FAIL").alias("verdict"),
    )


def row_count_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every named table, ordered by name."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in sorted(tables.items())
    ]
    stacked = counts[0]
    for other in counts[1:]:
        stacked = stacked.unionAll(other)
    return stacked.orderBy("table_name")


def compare_manifests(exported: DataFrame, imported: DataFrame) -> DataFrame:
    """Row counts before and after a transfer, with a verdict per table."""
    return tie_out(exported, imported, ["table_name"], "row_count")
