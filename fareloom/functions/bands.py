"""Reporting bands. A NULL measure falls into the last band, as an if-else chain does."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Upper limits and labels of the reporting bands.
DISTANCE_BANDS = (
    (1, "1. 0-1 mi"),
    (2, "2. 1-2 mi"),
    (5, "3. 2-5 mi"),
    (10, "4. 5-10 mi"),
    (20, "5. 10-20 mi"),
)
DISTANCE_REST = "6. 20+ mi"
FARE_BANDS = (
    (10, "1. $0-10"),
    (20, "2. $10-20"),
    (30, "3. $20-30"),
    (50, "4. $30-50"),
    (100, "5. $50-100"),
)
FARE_REST = "6. $100+"


def _banded(value: Column, bands: tuple, rest: str) -> Column:
    return reduce(lambda expr, band: expr.when(value < band[0], band[1]), bands, F).otherwise(rest)


def distance_band(value: str = "trip_distance") -> Column:
    return _banded(F.col(value), DISTANCE_BANDS, DISTANCE_REST)


def fare_band(value: str = "fare_amount") -> Column:
    return _banded(F.col(value), FARE_BANDS, FARE_REST)
