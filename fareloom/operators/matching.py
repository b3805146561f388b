"""Matching of source records to master versions, and resolution of current records."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareloom.operators.keys import assign_ids, highest_id

# Accepted codes of a match row.
STATUSES = ("pending", "confirmed", "rejected")
OPERATIONS = ("insert", "update", "delete")


def current_version(golden: DataFrame) -> DataFrame:
    """Rows valid now."""
    return golden.filter("is_current")


def match_zones(sources: DataFrame, golden: DataFrame, existing: DataFrame) -> DataFrame:
    """New match rows: every source zone with the current master version of its id.

    Pairs already present in ``existing`` are left out, so a second run adds nothing.
    """
    current = current_version(golden).select("location_id", "golden_id", "golden_zone_row_id")
    pairs = sources.select("location_id").join(current, "location_id").select(
        F.col("golden_id").alias("golden_zone_id"),
        F.col("location_id").alias("source_zone_id"),
        "golden_zone_row_id",
        F.lit("1.0000").cast("decimal(5,4)").alias("confidence_score"),
        F.lit("confirmed").alias("status"),
        F.lit("insert").alias("operation"),
    )
    fresh = pairs.join(existing, ["source_zone_id", "golden_zone_row_id"], "left_anti")
    return assign_ids(
        fresh,
        ["source_zone_id", "golden_zone_row_id"],
        "match_id",
        start_after=highest_id(existing, "match_id"),
    )


def resolve_current(
    matches: DataFrame, sources: DataFrame, golden: DataFrame, lo: int = 1, hi: int = 265
) -> DataFrame:
    """Current master record of every matched source zone with an id in ``lo..hi``.

    Resolution goes by business key. Matched ids are made distinct first, so a zone
    with several match rows still comes out once; as current rows are unique per
    key the result has at most ``hi - lo + 1`` rows.
    """
    matched = (
        matches.select(F.col("source_zone_id").alias("location_id"))
        .filter(F.col("location_id").between(lo, hi))
        .distinct()
    )
    known = matched.join(sources.select("location_id"), "location_id", "left_semi")
    return current_version(golden).join(known, "location_id", "left_semi").select(
        "location_id", "borough", "zone", "service_zone", "golden_zone_row_id", "version"
    )


def resolve_by_pointer(matches: DataFrame, golden: DataFrame) -> DataFrame:
    """Current records reached through the stored row id, which goes stale on change."""
    return matches.join(current_version(golden), "golden_zone_row_id").select(
        "location_id", "golden_zone_row_id", "version"
    )


def stale_pointers(matches: DataFrame, sources: DataFrame, golden: DataFrame,
                   lo: int = 1, hi: int = 265) -> DataFrame:
    """Zones that resolution by key finds and resolution by pointer loses."""
    by_key = resolve_current(matches, sources, golden, lo, hi)
    by_pointer = resolve_by_pointer(matches, golden).select("location_id")
    return by_key.join(by_pointer, "location_id", "left_anti").select(
        "location_id", "golden_zone_row_id", "version"
    )


def match_details(matches: DataFrame, golden: DataFrame, sources: DataFrame) -> DataFrame:
    """Master and source attributes of every match side by side, by legacy master id."""
    m, g, s = matches.alias("m"), golden.alias("g"), sources.alias("s")
    return (
        m.join(g, F.col("m.golden_zone_id") == F.col("g.golden_id"))
        .join(s, F.col("m.source_zone_id") == F.col("s.location_id"))
        .select(
            "m.match_id",
            "m.status",
            "m.confidence_score",
            "g.golden_id",
            F.col("g.borough").alias("golden_borough"),
            F.col("g.zone").alias("golden_zone"),
            F.col("g.service_zone").alias("golden_service_zone"),
            F.col("s.location_id").alias("source_location_id"),
            F.col("s.borough").alias("source_borough"),
            F.col("s.zone").alias("source_zone"),
            F.col("s.service_zone").alias("source_service_zone"),
            *[f"m.{c}" for c in ("created_at", "updated_at") if c in matches.columns],
        )
    )


def match_summary(matches: DataFrame) -> DataFrame:
    """Totals over the match table in one pass."""
    return matches.agg(
        F.count(F.lit(1)).alias("total_matches"),
        F.count_distinct("source_zone_id").alias("distinct_source_zones"),
        F.count_if(F.col("status") == "confirmed").alias("confirmed"),
        F.count_if(F.col("confidence_score") == F.lit("1.0000").cast("decimal(5,4)"))
        .alias("exact_matches"),
        F.count_if(F.col("golden_zone_row_id").isNull()).alias("orphans"),
    )


def match_domain_violations(matches: DataFrame) -> DataFrame:
    """Rows outside the allowed score range, statuses and operations."""
    return matches.agg(
        F.count_if(~F.col("confidence_score").between(0, 1)).alias("bad_score"),
        F.count_if(~F.col("status").isin(*STATUSES)).alias("bad_status"),
        F.count_if(~F.col("operation").isin(*OPERATIONS)).alias("bad_operation"),
    )


def foreign_key_violations(matches: DataFrame, sources: DataFrame, golden: DataFrame) -> DataFrame:
    """Match rows pointing at a missing source zone or a missing master version."""
    zones = sources.select(F.col("location_id").alias("source_zone_id"))
    no_source = matches.filter(F.col("source_zone_id").isNotNull()).join(
        zones, "source_zone_id", "left_anti"
    )
    no_version = matches.filter(F.col("golden_zone_row_id").isNotNull()).join(
        golden.select("golden_zone_row_id"), "golden_zone_row_id", "left_anti"
    )

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("rule"), "violations"
        )

    return counted(no_source, "source_zone_id").unionAll(counted(no_version, "golden_zone_row_id"))
