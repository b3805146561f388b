"""Point-in-time lookup: the master version valid when a fact happened."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F, types as T

from fareloom.operators.slices import SLICE_ROWS, cut_slices, slices_of, with_slices


def as_of(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    fact_time: str,
    key: str,
    attributes: Sequence[str],
    *,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Left join each fact to the version with ``effective_date <= time < end_date``.

    Facts and versions are put in one order of key and time, and the last version before
    a fact is carried to it; its end decides whether it is still in force. A fact therefore
    meets one version, not all of its key, and no range condition is joined. The versions
    of a key must not overlap, as those of a history do not.

    A key with more than ``slice_rows`` rows is cut into slices along time (facts of one
    moment along a hash), and each slice starts with what the slices before it left: one
    row per slice. Facts without a key or a time meet no version.
    """
    names = [f"asof_{a}" for a in attributes]
    placed = F.col(fact_key).isNotNull() & F.col(fact_time).isNotNull()
    hashed = [F.col(f"`{f.name}`") for f in facts.schema if not isinstance(f.dataType, T.MapType)]
    happened = facts.filter(placed).select(
        F.col(fact_key).alias("_key"),
        F.col(fact_time).alias("_time"),
        F.xxhash64(*hashed).alias("_spread"),
        F.struct(*[F.col(f"`{c}`") for c in facts.columns]).alias("_fact"),
    )
    versions = history.filter(F.col(key).isNotNull() & F.col("effective_date").isNotNull()).select(
        F.col(key).alias("_key"),
        F.col("effective_date").alias("_time"),
        F.struct(
            F.col("end_date").alias("_to"), *[F.col(a).alias(n) for a, n in zip(attributes, names)]
        ).alias("_version"),
    )
    # A version has no hash, and NULL comes first: it is in force at its own moment.
    both = happened.unionByName(versions, allowMissingColumns=True)
    place = F.struct("_time", "_spread")
    cuts = cut_slices(both.withColumn("_place", place), "_key", "_place", slice_rows)
    sliced = with_slices(both, cuts, "_key", place)
    up_to = (
        Window.partitionBy("_key", "_slice")
        .orderBy("_time", F.asc_nulls_first("_spread"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    found = sliced.withColumn("_found", F.last("_version", ignorenulls=True).over(up_to))
    if cuts is not None:
        found = (
            found.join(F.broadcast(_left_behind(sliced, cuts)), ["_key", "_slice"], "left")
            .withColumn("_found", F.coalesce("_found", "_before"))
        )
    in_force = F.col("_found._to").isNull() | (F.col("_time") < F.col("_found._to"))
    matched = found.filter(F.col("_fact").isNotNull()).select(
        "_fact.*", *[F.when(in_force, F.col(f"_found.{n}")).alias(n) for n in names]
    )
    unplaced = facts.filter(~placed)
    return matched.unionByName(unplaced, allowMissingColumns=True)


def _left_behind(sliced: DataFrame, cuts: DataFrame) -> DataFrame:
    """For every slice of a cut key the last version of the slices before it.

    A cut key has one row per slice, and all have fewer than twice the blocks that the cuts
    come from, so the result may be broadcast.
    """
    last = (
        sliced.filter(F.col("_version").isNotNull())
        .join(F.broadcast(cuts.select(F.col("_cut_key").alias("_key"))), "_key", "left_semi")
        .groupBy("_key", "_slice")
        .agg(F.max_by("_version", "_time").alias("_last"))
    )
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return (
        slices_of(cuts)
        .withColumnRenamed("_cut_key", "_key")
        .join(last, ["_key", "_slice"], "left")
        .select("_key", "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_before"))
    )
