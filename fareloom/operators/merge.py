"""Type-1 upsert, insert-ignore, seeding and conditional update."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def scd1_merge(
    target: DataFrame,
    batch: DataFrame,
    key: Sequence[str],
    touched_at: tuple[str, Column] | None = None,
) -> DataFrame:
    """Insert new keys and overwrite all other columns of known ones.

    A key repeated in the batch is an error, raised when the result is computed.
    Columns the batch lacks become NULL for the rows it writes. ``touched_at`` is a
    column and the time to store in it for overwritten rows only.
    """
    key = list(key)
    once = F.when(
        F.count(F.lit(1)) > 1, F.raise_error(F.lit("a batch must not hold a key twice")).cast("int")
    ).otherwise(F.lit(1))
    # The count is needed by the output (it filters), so the error cannot be optimised away.
    rest = [c for c in batch.columns if c not in key]
    checked = (
        batch.groupBy(*key)
        .agg(once.alias("_copies"), F.min(F.struct(*rest)).alias("_row"))
        .filter(F.col("_copies") == 1)
        .select(*key, "_row.*")
    )
    kept = target.join(checked.select(*key), key, "left_anti")
    if touched_at is not None:
        column, time = touched_at
        known = target.select(*key, F.lit(True).alias("_known"))
        checked = (
            checked.join(known, key, "left")
            .withColumn(column, F.when(F.col("_known"), time).otherwise(
                F.col(column) if column in checked.columns else F.lit(None)))
            .drop("_known")
        )
    return kept.unionByName(checked, allowMissingColumns=True).select(*target.columns)


def new_rows(
    target: DataFrame, batch: DataFrame, key: Sequence[str], arrival: str | None = None
) -> DataFrame:
    """Batch rows whose key the target lacks; a key repeated in the batch enters once.

    ``arrival`` is a column giving the order of deliveries: the first one enters.
    Without it, or between equal arrivals, the smallest row does.
    """
    key = list(key)
    first = [arrival] if arrival else []
    rest = first + [c for c in batch.columns if c not in key and c not in first]
    once = batch.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*")
    return once.join(target.select(*key), key, "left_anti").select(*batch.columns)


def insert_ignore(
    target: DataFrame, batch: DataFrame, key: Sequence[str], arrival: str | None = None
) -> DataFrame:
    """Append the batch rows whose key is new; known keys keep their row.

    An ``arrival`` column that the target lacks only orders the batch and is not stored.
    """
    fresh = new_rows(target, batch, key, arrival)
    if arrival and arrival not in target.columns:
        fresh = fresh.drop(arrival)
    return target.unionByName(fresh, allowMissingColumns=True)


def seed_if_absent(target: DataFrame, seed: DataFrame, name: str) -> DataFrame:
    """Append seed rows whose name the target does not hold yet."""
    absent = seed.join(target.select(name), name, "left_anti")
    return target.unionByName(absent.select(*seed.columns), allowMissingColumns=True)


def conditional_update(df: DataFrame, condition: Column, values: Mapping[str, Column]) -> DataFrame:
    """Set columns on the rows that meet a condition; the others stay as they are."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns(
        {name: F.when(hit, value).otherwise(F.col(name)) for name, value in values.items()}
    ).select(*df.columns)
