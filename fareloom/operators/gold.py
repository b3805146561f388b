"""The five daily summaries.

Four of them are coarser groupings of one small cube (date, hour, vendor,
payment). Sums are exact decimals, so adding cube cells gives the same result as
adding trips; a publish run scans the trips twice instead of five times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fareloom.functions.numeric import exact_avg, exact_rest, exact_sum, exact_units, total_of
from fareloom.operators.contract import require_columns

REQUIRED = (
    "tpep_pickup_datetime", "VendorID", "PULocationID", "DOLocationID",
    "payment_type", "trip_distance", "fare_amount", "tip_amount",
)
CUBE_KEYS = ("trip_date", "pickup_hour", "VendorID", "payment_type")
MEASURES = {"fare": "fare_amount", "distance": "trip_distance", "tip": "tip_amount"}


def _dated(trips: DataFrame) -> DataFrame:
    return require_columns(trips, REQUIRED).withColumn("trip_date", F.to_date("tpep_pickup_datetime"))


def gold_cube(trips: DataFrame) -> DataFrame:
    """Counts and exact sums by date, hour, vendor and payment type."""
    sums: list[Column] = [F.count(F.lit(1)).alias("trips")]
    for short, column in MEASURES.items():
        sums += [
            F.count(column).alias(f"{short}_n"),
            F.sum(exact_units(column)).alias(f"{short}_units"),
            F.sum(exact_rest(column)).alias(f"{short}_rest"),
        ]
    return (
        _dated(trips)
        .withColumn("pickup_hour", F.hour("tpep_pickup_datetime"))
        .groupBy(*CUBE_KEYS)
        .agg(*sums)
    )


def _total(short: str) -> Column:
    return total_of(F.sum(f"{short}_units"), F.sum(f"{short}_rest"))


def _mean(short: str) -> Column:
    return _total(short) / F.nullif(F.sum(f"{short}_n"), F.lit(0)).cast("double")


def daily_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("trip_date").agg(
        F.sum("trips").alias("total_trips"),
        _total("fare").alias("total_revenue"),
        _mean("fare").alias("average_fare"),
        _mean("distance").alias("average_distance"),
    )


def vendor_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("trip_date", "VendorID").agg(
        F.sum("trips").alias("trip_count"),
        _total("fare").alias("total_revenue"),
        _mean("tip").alias("average_tip"),
        _mean("distance").alias("average_trip_distance"),
    )


def payment_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("trip_date", "payment_type").agg(
        F.sum("trips").alias("trip_count"),
        _total("fare").alias("total_amount"),
        _mean("fare").alias("average_fare"),
    )


def hourly_from_cube(cube: DataFrame) -> DataFrame:
    return cube.groupBy("trip_date", "pickup_hour").agg(
        F.sum("trips").alias("trip_count"), _mean("fare").alias("average_fare")
    )


def daily_summary(trips: DataFrame) -> DataFrame:
    """Trips, revenue, average fare and average distance by day."""
    return _dated(trips).groupBy("trip_date").agg(
        F.count(F.lit(1)).alias("total_trips"),
        exact_sum("fare_amount").alias("total_revenue"),
        exact_avg("fare_amount").alias("average_fare"),
        exact_avg("trip_distance").alias("average_distance"),
    )


def vendor_summary(trips: DataFrame) -> DataFrame:
    """Trips, revenue, average tip and distance by day and vendor."""
    return _dated(trips).groupBy("trip_date", "VendorID").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("fare_amount").alias("total_revenue"),
        exact_avg("tip_amount").alias("average_tip"),
        exact_avg("trip_distance").alias("average_trip_distance"),
    )


def borough_summary(trips: DataFrame) -> DataFrame:
    """Trips, revenue and average fare by day, pickup id and dropoff id."""
    places = [
        F.col("PULocationID").alias("pickup_location_id"),
        F.col("DOLocationID").alias("dropoff_location_id"),
    ]
    return _dated(trips).groupBy("trip_date", *places).agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("fare_amount").alias("total_revenue"),
        exact_avg("fare_amount").alias("average_fare"),
    )


def payment_summary(trips: DataFrame) -> DataFrame:
    """Trips, summed fare (published as ``total_amount``) and average fare by day and payment."""
    return _dated(trips).groupBy("trip_date", "payment_type").agg(
        F.count(F.lit(1)).alias("trip_count"),
        exact_sum("fare_amount").alias("total_amount"),
        exact_avg("fare_amount").alias("average_fare"),
    )


def hourly_summary(trips: DataFrame) -> DataFrame:
    """Trips and average fare by day and pickup hour."""
    return (
        _dated(trips)
        .groupBy("trip_date", F.hour("tpep_pickup_datetime").alias("pickup_hour"))
        .agg(F.count(F.lit(1)).alias("trip_count"), exact_avg("fare_amount").alias("average_fare"))
    )




def sort_order(name: str) -> list[Column]:
    """Row order each summary is read in."""
    return {
        "daily_summary": [F.asc("trip_date")],
        "vendor_summary": [F.asc("trip_date"), F.asc("VendorID")],
        "borough_summary": [F.asc("trip_date"), F.asc("pickup_location_id"), F.asc("dropoff_location_id")],
        "payment_summary": [F.desc("trip_date"), F.desc("trip_count"), F.asc("payment_type")],
        "hourly_summary": [F.asc("trip_date"), F.asc("pickup_hour")],
    }[name]


def gold_summaries(trips: DataFrame, cube: DataFrame | None = None) -> dict[str, DataFrame]:
    """All five summaries; pass a stored :func:`gold_cube` to avoid rescanning the trips."""
    cube = gold_cube(trips) if cube is None else cube
    return {
        "daily_summary": daily_from_cube(cube),
        "vendor_summary": vendor_from_cube(cube),
        "borough_summary": borough_summary(trips),
        "payment_summary": payment_from_cube(cube),
        "hourly_summary": hourly_from_cube(cube),
    }


def busiest_days(daily: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` days with most trips; earlier day first on ties."""
    return daily.orderBy(F.desc("total_trips"), F.asc("trip_date")).limit(k)


def latest_days(daily: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most recent days."""
    return daily.orderBy(F.desc("trip_date")).limit(k)


def vendors_on(vendor: DataFrame, day: str) -> DataFrame:
    """Vendors of one day, highest revenue first."""
    return vendor.filter(F.col("trip_date") == F.lit(day).cast("date")).orderBy(
        F.desc("total_revenue"), F.asc("VendorID")
    )


def layer_counts(raw: DataFrame, cleaned: DataFrame, year: int, month: int) -> DataFrame:
    """Raw row count beside the cleaned count of one year and month partition."""
    part = cleaned.filter((F.col("pickup_year") == year) & (F.col("pickup_month") == month))
    return raw.agg(F.count(F.lit(1)).alias("bronze_rows")).select(
        "bronze_rows", part.agg(F.count(F.lit(1))).scalar().alias("silver_rows")
    )
