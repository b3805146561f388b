"""The denormalised reporting dataset: four left joins, renames, three bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fareloom.functions.bands import distance_band, fare_band
from fareloom.operators.star import FACT_COLUMNS, Star

# Dimension columns and their role names in the dataset.
ZONE_ROLE = {
    "location_id": "zone_id",
    "borough": "borough",
    "zone": "zone_name",
    "service_zone": "service_zone",
    "golden_zone_row_id": "golden_zone_row_id",
    "version": "zone_version",
}
DATE_ROLE = {
    "date_key": "dim_date_key",
    "full_date": "trip_date",
    "year": "trip_year",
    "month": "trip_month",
    "day": "trip_day",
    "day_of_week": "trip_day_of_week",
    "day_name": "day_name",
    "is_weekend": "is_weekend",
}
PAYMENT_ROLE = {"payment_type": "dim_payment_type", "payment_description": "payment_description"}


def zone_role(dim_zone: DataFrame, role: str) -> DataFrame:
    """The zone dimension under the names of one role (``pickup`` or ``dropoff``)."""
    return dim_zone.withColumnsRenamed({c: f"{role}_{name}" for c, name in ZONE_ROLE.items()})


def bi_dataset(star: Star) -> DataFrame:
    """37 columns, one row per fact row whether or not its dimensions resolve."""
    joined = (
        star.fact_trips
        .join(zone_role(star.dim_zone, "pickup"),
              F.col("pickup_location_id") == F.col("pickup_zone_id"), "left")
        .join(zone_role(star.dim_zone, "dropoff"),
              F.col("dropoff_location_id") == F.col("dropoff_zone_id"), "left")
        .join(star.dim_date.withColumnsRenamed(DATE_ROLE),
              F.col("date_key") == F.col("dim_date_key"), "left")
        .join(star.dim_payment.withColumnsRenamed(PAYMENT_ROLE),
              F.col("payment_type") == F.col("dim_payment_type"), "left")
    )
    roles = [f"{role}_{name}" for role in ("pickup", "dropoff") for name in ZONE_ROLE.values()]
    return joined.select(
        *FACT_COLUMNS,
        *roles,
        *DATE_ROLE.values(),
        *PAYMENT_ROLE.values(),
        F.hour("pickup_datetime").alias("pickup_hour"),
        distance_band().alias("distance_band"),
        fare_band().alias("fare_band"),
    )
