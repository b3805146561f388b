"""Duplicate removal and duplicate listing.

Each operator first combines copies inside the map tasks, so a group of copies
that holds a large share of the table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: A key counts as hot when it holds more than this share of the rows, so there
#: are at most ``1 / HOT_SHARE`` hot keys however large the table is.
HOT_SHARE = 0.001


def _as_struct(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(f"`{c}`") for c in columns])


def keep_one(
    df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first"
) -> DataFrame:
    """One row per key: the first, the last, or none of a repeated key.

    ``order`` decides which copy wins; remaining ties go by the whole row, so the
    survivor never depends on task timing. An aggregate is used in place of a
    ranking window because it combines before the shuffle.
    """
    columns = df.columns
    rest = [c for c in columns if c not in order]
    ranked = _as_struct([*order, *rest])
    if keep == "none":
        picked = df.groupBy(*key).agg(
            F.count(F.lit(1)).alias("_copies"), F.min(ranked).alias("_row")
        ).filter(F.col("_copies") == 1)
    elif keep == "first":
        picked = df.groupBy(*key).agg(F.min(ranked).alias("_row"))
    elif keep == "last":
        picked = df.groupBy(*key).agg(F.max(ranked).alias("_row"))
    else:
        raise ValueError(f"keep must be first, last or none, not {keep!r}")
    return picked.select("_row.*").select(*columns)


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once, all copies kept.

    The rows are read twice: to count the keys, which also gives their total, and to list.
    """
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_copies"))
    total = counts.agg(F.coalesce(F.sum("_copies"), F.lit(0))).scalar()
    return semi_join_counted(df, counts.filter(F.col("_copies") > 1), key, total)


#: Tasks that the rows of a hot key are spread over.
SPREAD = 64


def semi_join_counted(
    df: DataFrame, counted: DataFrame, key: Sequence[str], total: Column | None = None
) -> DataFrame:
    """``df`` rows whose key is in ``counted`` (one row per key, with ``_copies``).

    Rows of hot keys (at most ``1 / HOT_SHARE`` keys, told by broadcast) are dealt to one of
    ``SPREAD`` places in their key, and the key is listed in all of them, so one shuffled
    join takes all rows and no task gets a hot key whole. NULL keys match each other, as
    they do in a group-by. ``total`` is the number of rows, where it is known.
    """
    rows = df.agg(F.count(F.lit(1))).scalar() if total is None else total
    is_hot = F.col("_copies") > rows * HOT_SHARE
    hot = counted.filter(is_hot).select(*key, F.lit(True).alias("_hot"))
    told = df.alias("_l").join(F.broadcast(hot).alias("_r"), _same(key), "left").select("_l.*", "_hot")
    place = F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD))).otherwise(0)
    first, last = F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long")
    places = F.when(is_hot, F.sequence(first, last)).otherwise(F.array(first))
    keys = counted.select(*key, F.explode(places).alias("_place"))
    left, right = told.withColumn("_place", place.cast("long")).alias("_l"), keys.alias("_r")
    same = _same(key) & (F.col("_l._place") == F.col("_r._place"))
    return left.join(right, same, "left_semi").select(*[f"`{c}`" for c in df.columns])


def _same(key: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(f"_l.`{k}`").eqNullSafe(F.col(f"_r.`{k}`")) for k in key])


def copies_per_row(df: DataFrame) -> DataFrame:
    """Distinct rows with the number of copies of each (``copies``)."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("copies"))


def duplicated_rows(df: DataFrame) -> DataFrame:
    """Rows that occur more than once, one line per distinct row with ``copies``."""
    return copies_per_row(df).filter(F.col("copies") > 1)


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Number of rows that have an exact copy, all copies counted."""
    return duplicated_rows(df).agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
