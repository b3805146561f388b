"""Joins of a large table to a table with one row per key, when some keys are hot.

Adaptive execution splits a hot partition by its size in bytes. Copies of one row
compress so well that their partition looks small, so hot keys are found from a
sample and matched by broadcast, which leaves their rows where they were read.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, functions as F

#: Rows looked at when searching for hot keys.
SAMPLE_ROWS = 1_000_000
#: A key is hot when it holds this share of the rows ...
HOT_SHARE = 0.001
#: ... and at least this many rows; fewer are no burden for one task.
HOT_ROWS = 250_000


def hot_keys(df: DataFrame, key: str) -> list[Any]:
    """Keys that hold an unusual share of ``df``, at most ``1 / HOT_SHARE`` of them.

    The choice only decides how a row is joined, never whether it is, so a sample
    is enough. Only the key column is read, and only keys above the share reach
    the driver.
    """
    total = df.count()
    if total < HOT_ROWS:
        return []
    fraction = min(1.0, SAMPLE_ROWS / total)
    keys = df.select(F.col(key).alias("k")).filter(F.col("k").isNotNull())
    sampled = keys.sample(fraction=fraction, seed=17) if fraction < 1.0 else keys
    least = max(HOT_SHARE * total, HOT_ROWS) * fraction
    found = (
        sampled.groupBy("k").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
        .orderBy(F.desc("n")).limit(int(1 / HOT_SHARE))
    )
    return [row["k"] for row in found.collect()]


def lookup_join(
    rows: DataFrame, lookup: DataFrame, row_key: str, lookup_key: str, hot: list[Any]
) -> DataFrame:
    """Inner join of ``rows`` to ``lookup``, whose key is unique.

    Rows of hot keys meet the few lookup rows they need by broadcast, at most one
    per hot key; all other rows take the join Spark chooses.
    """
    same = F.col(row_key) == F.col(lookup_key)
    if not hot:
        return rows.join(lookup, same)
    is_hot, wanted = F.col(row_key).isin(hot), F.col(lookup_key).isin(hot)
    return rows.filter(~is_hot).join(lookup.filter(~wanted), same).unionAll(
        rows.filter(is_hot).join(F.broadcast(lookup.filter(wanted)), same)
    )
