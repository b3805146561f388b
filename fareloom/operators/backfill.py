"""Backfills that bring an older master table up to the versioned layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fareloom.operators.keys import assign_ids, highest_id


def backfill_key(golden: DataFrame, sources: DataFrame) -> DataFrame:
    """Fill a NULL ``location_id`` from (borough, zone) where that pair names one source row.

    A pair shared by several source rows stays NULL for review. Only rows without
    a key are joined; the source side has one row per pair.
    """
    pairs = (
        sources.groupBy("borough", "zone")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("location_id").alias("_found"))
        .filter(F.col("_n") == 1)
        .select("borough", "zone", "_found")
    )
    has_key = golden.filter(F.col("location_id").isNotNull())
    filled = golden.filter(F.col("location_id").isNull()).join(pairs, ["borough", "zone"], "left")
    return has_key.unionByName(
        filled.withColumn("location_id", F.col("_found")).select(*golden.columns)
    )


def key_report(golden: DataFrame, key: str = "location_id") -> DataFrame:
    """Rows in all and rows still without a key."""
    return golden.agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_if(F.col(key).isNull()).alias("null_keys")
    )


def backfill_pointer(matches: DataFrame, golden: DataFrame) -> DataFrame:
    """Fill a NULL ``golden_zone_row_id`` of a match from its legacy master id.

    When a legacy id has several versions the lowest row id is taken.
    """
    by_id = golden.groupBy(F.col("golden_id").alias("golden_zone_id")).agg(
        F.min("golden_zone_row_id").alias("_found")
    )
    pointed = matches.filter(F.col("golden_zone_row_id").isNotNull())
    filled = matches.filter(F.col("golden_zone_row_id").isNull()).join(
        by_id, "golden_zone_id", "left"
    )
    return pointed.unionByName(
        filled.withColumn("golden_zone_row_id", F.col("_found")).select(*matches.columns)
    )


def backfill_scd_columns(df: DataFrame) -> DataFrame:
    """Version 1, current, effective from creation, open end: for rows lacking any of these."""
    lacking = (
        F.col("version").isNull() | F.col("is_current").isNull() | F.col("effective_date").isNull()
    )

    def fill(name: str, default: Column) -> Column:
        return F.when(lacking, F.coalesce(F.col(name), default)).otherwise(F.col(name))

    return df.withColumns(
        {
            "version": fill("version", F.lit(1)),
            "is_current": fill("is_current", F.lit(True)),
            "effective_date": fill("effective_date", F.col("created_at")),
            "end_date": F.when(~lacking, F.col("end_date")),
        }
    )


def backfill_surrogate(df: DataFrame, row_id: str, unique: list[str]) -> DataFrame:
    """Give rows without a surrogate key the next free numbers."""
    numbered = df.filter(F.col(row_id).isNotNull())
    added = assign_ids(
        df.filter(F.col(row_id).isNull()), unique, row_id, start_after=highest_id(df, row_id)
    )
    return numbered.unionByName(added.select(*df.columns))
