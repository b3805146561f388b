"""Star schema: one fact and three dimensions, and the queries that read it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from fareloom.functions.numeric import money, money_mean, money_sum
from fareloom.functions.temporal import calendar_columns, date_key
from fareloom.session import broadcast_if_bounded, broadcast_if_small

# The full payment code list, including codes the data may not hold yet.
PAYMENT_TYPES = (
    (0, "Flex Fare trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
)

FACT_COLUMNS = (
    "vendorid", "pickup_datetime", "dropoff_datetime", "date_key", "pickup_location_id",
    "dropoff_location_id", "payment_type", "passenger_count", "trip_distance",
    "fare_amount", "tip_amount", "total_amount",
)


@dataclass(frozen=True)
class Star:
    """The four tables. The dimensions carry a broadcast hint where their size is known."""

    fact_trips: DataFrame
    dim_zone: DataFrame
    dim_date: DataFrame
    dim_payment: DataFrame
    zone_bound: int | None = None

    def tables(self) -> dict[str, DataFrame]:
        """The four tables by name, dimensions first."""
        return {
            "dim_zone": self.dim_zone,
            "dim_date": self.dim_date,
            "dim_payment": self.dim_payment,
            "fact_trips": self.fact_trips,
        }

    def hint_zones(self, zones: DataFrame) -> DataFrame:
        """Broadcast hint for a frame of at most one row per zone, if zones are few."""
        if self.zone_bound is None:
            return broadcast_if_small(zones)
        return broadcast_if_bounded(zones, self.zone_bound)


def fact_trips(silver: DataFrame) -> DataFrame:
    """Silver to the fact: projection and casts only, so no row is lost or merged."""
    return silver.select(
        F.col("VendorID").try_cast("short").alias("vendorid"),
        F.col("tpep_pickup_datetime").alias("pickup_datetime"),
        F.col("tpep_dropoff_datetime").alias("dropoff_datetime"),
        date_key("tpep_pickup_datetime").alias("date_key"),
        F.col("PULocationID").try_cast("short").alias("pickup_location_id"),
        F.col("DOLocationID").try_cast("short").alias("dropoff_location_id"),
        F.col("payment_type").try_cast("short").alias("payment_type"),
        F.col("passenger_count").try_cast("short").alias("passenger_count"),
        money("trip_distance").alias("trip_distance"),
        money("fare_amount").alias("fare_amount"),
        money("tip_amount").alias("tip_amount"),
        money("total_amount").alias("total_amount"),
    )


def dim_zone(resolved: DataFrame) -> DataFrame:
    """Current master records (see ``matching.resolve_current``) as the zone dimension."""
    return resolved.select(
        F.col("location_id").cast("short").alias("location_id"),
        "borough",
        "zone",
        "service_zone",
        F.col("golden_zone_row_id").cast("long").alias("golden_zone_row_id"),
        F.col("version").cast("short").alias("version"),
    )


def date_bounds(fact: DataFrame) -> DataFrame:
    """First and last pickup date of the fact."""
    day = F.to_date("pickup_datetime")
    return fact.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def dim_date(fact: DataFrame) -> DataFrame:
    """Gap-free calendar over the fact's own date range, in one plan.

    The row count is the day span, at most 3.7 million for the whole date type,
    whatever the number of trips. An empty fact gives an empty calendar.
    """
    days = date_bounds(fact).select(
        F.explode(F.sequence("min_date", "max_date", F.expr("interval 1 day"))).alias("full_date")
    )
    return days.select(*calendar_columns("full_date"))


def dim_payment(spark: SparkSession) -> DataFrame:
    """Static payment dimension."""
    schema = T.StructType(
        [
            T.StructField("payment_type", T.ShortType(), False),
            T.StructField("payment_description", T.StringType(), False),
        ]
    )
    return spark.createDataFrame(list(PAYMENT_TYPES), schema)


def build_star(
    silver: DataFrame, zones: DataFrame, *, zone_bound: int | None = None, dated: DataFrame | None = None
) -> Star:
    """All four tables. ``zone_bound`` is the proven row limit of ``zones``, when known.

    ``dated`` holds the same trips with copies kept (see ``clean.valid_trips``): the calendar
    needs their first and last day alone, so it is read from there without a shuffle of rows.
    """
    fact = fact_trips(silver)
    days = fact if dated is None else fact_trips(dated)
    payments = F.broadcast(dim_payment(silver.sparkSession))
    bare = Star(fact, dim_zone(zones), dim_date(days), payments, zone_bound)
    return replace(bare, dim_zone=bare.hint_zones(bare.dim_zone))


def star_join(star: Star, how: str = "inner") -> DataFrame:
    """Fact with pickup zone (``zp``), dropoff zone (``zd``), date (``d``) and payment (``p``)."""
    f = star.fact_trips.alias("f")
    zp, zd = star.dim_zone.alias("zp"), star.dim_zone.alias("zd")
    d, p = star.dim_date.alias("d"), star.dim_payment.alias("p")
    return (
        f.join(zp, F.col("zp.location_id") == F.col("f.pickup_location_id"), how)
        .join(zd, F.col("zd.location_id") == F.col("f.dropoff_location_id"), how)
        .join(d, F.col("d.date_key") == F.col("f.date_key"), how)
        .join(p, F.col("p.payment_type") == F.col("f.payment_type"), how)
    )


def star_rollup(star: Star) -> DataFrame:
    """Trips and fare revenue by pickup borough, dropoff borough, weekday and payment text.

    The fact is summed over its narrow keys first; names are joined to the few
    summed rows instead of to every trip.
    """
    keys = ["pickup_location_id", "dropoff_location_id", "date_key", "payment_type"]
    cells = star.fact_trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("trips"), money_sum("fare_amount").alias("fare_revenue")
    )
    named = star_join(replace(star, fact_trips=cells))
    return named.groupBy(
        F.col("zp.borough").alias("pickup_borough"),
        F.col("zd.borough").alias("dropoff_borough"),
        F.col("d.day_name").alias("day_name"),
        F.col("p.payment_description").alias("payment_description"),
    ).agg(
        F.sum("trips").alias("trips"),
        F.round(F.sum("fare_revenue"), 2).alias("fare_revenue"),
    )


def busiest_groups(star: Star, k: int = 10) -> DataFrame:
    """The ``k`` roll-up groups with most trips, names breaking ties."""
    names = ["pickup_borough", "dropoff_borough", "day_name", "payment_description"]
    return star_rollup(star).orderBy(F.desc("trips"), *names).limit(k)


def _dated(cells: DataFrame, star: Star) -> DataFrame:
    """Replace the date key of already summed rows by the calendar date."""
    d = star.dim_date.select("date_key", F.col("full_date").alias("trip_date"))
    return cells.join(d, "date_key").drop("date_key")


def star_counts(star: Star, *by: str) -> DataFrame:
    """Trips by date and further keys; ``pickup_hour`` is taken from the pickup time.

    Trips are counted by date key first, so the calendar meets a few cells only.
    """
    fact = star.fact_trips.withColumn("pickup_hour", F.hour("pickup_datetime"))
    cells = fact.groupBy("date_key", *by).agg(F.count(F.lit(1)).alias("n"))
    return _dated(cells, star).groupBy("trip_date", *by).agg(F.sum("n").alias("trip_count"))


def star_revenue(star: Star) -> DataFrame:
    """Fare revenue and weighted averages by date."""
    cells = star.fact_trips.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("n"),
        money_sum("fare_amount").alias("fare"),
        money_sum("trip_distance").alias("distance"),
    )
    return _dated(cells, star).groupBy("trip_date").agg(
        F.sum("fare").cast("decimal(20,2)").alias("fare_revenue"),
        F.round(F.sum("fare") / F.sum("n"), 4).alias("average_fare"),
        F.round(F.sum("distance") / F.sum("n"), 4).alias("average_distance"),
    )


def star_totals(fact: DataFrame) -> DataFrame:
    """Global sums and weighted averages; never the mean of daily means."""
    return fact.agg(
        money_sum("fare_amount").alias("total_fare_revenue"),
        money_mean("fare_amount", 10).alias("weighted_average_fare"),
        money_mean("trip_distance", 10).alias("weighted_average_distance"),
        money_sum("total_amount").alias("total_amount_sum"),
    )
