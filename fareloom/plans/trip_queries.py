"""Queries over trips: silver, gold, star, checks, tie-outs, reporting, profile."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareloom.operators import checks as ck
from fareloom.operators import gold, profile as pf, star as st
from fareloom.operators.bi import bi_dataset
from fareloom.operators.clean import cleaning_accounts
from fareloom.operators.dedupe import duplicate_row_count
from fareloom.operators.tieout import row_count_manifest, tie_out
from fareloom.plans.inputs import (
    STAR_SQL, TRIPS_SQL, bronze, exact, exact_mean, portable, star, stored_trips, table, trips,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None, with_sql: str = TRIPS_SQL):
    def add(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = f"WITH {with_sql.strip()}\n{sql.strip()}"
        return fn

    return add


# ---------------------------------------------------------------- silver

register("silver_clean", "SELECT * FROM silver")(trips)

register(
    "silver_accounting",
    """
    SELECT (SELECT COUNT(*) FROM bronze) AS rows_in,
           (SELECT COUNT(*) FROM bronze) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM bronze))
             AS duplicates_removed,
           (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM bronze)) - (SELECT COUNT(*) FROM silver)
             AS invalid_removed,
           (SELECT COUNT(*) FROM silver) AS rows_out
    """,
)(lambda s, d: cleaning_accounts(bronze(s, d)))

# ---------------------------------------------------------------- gold

DAILY_SQL = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, COUNT(*) AS total_trips,
       {exact('fare_amount')} AS total_revenue, {exact_mean('fare_amount')} AS average_fare,
       {exact_mean('trip_distance')} AS average_distance
FROM silver GROUP BY 1"""
VENDOR_SQL = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, "VendorID", COUNT(*) AS trip_count,
       {exact('fare_amount')} AS total_revenue, {exact_mean('tip_amount')} AS average_tip,
       {exact_mean('trip_distance')} AS average_trip_distance
FROM silver GROUP BY 1, 2"""
BOROUGH_SQL = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, "PULocationID" AS pickup_location_id,
       "DOLocationID" AS dropoff_location_id, COUNT(*) AS trip_count,
       {exact('fare_amount')} AS total_revenue, {exact_mean('fare_amount')} AS average_fare
FROM silver GROUP BY 1, 2, 3"""
PAYMENT_SQL = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date, payment_type, COUNT(*) AS trip_count,
       {exact('fare_amount')} AS total_amount, {exact_mean('fare_amount')} AS average_fare
FROM silver GROUP BY 1, 2"""
HOURLY_SQL = f"""
SELECT CAST(tpep_pickup_datetime AS DATE) AS trip_date,
       CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour, COUNT(*) AS trip_count,
       {exact_mean('fare_amount')} AS average_fare
FROM silver GROUP BY 1, 2"""

register("gold_daily", DAILY_SQL)(lambda s, d: gold.daily_summary(trips(s, d)))
register("gold_vendor", VENDOR_SQL)(lambda s, d: gold.vendor_summary(trips(s, d)))
register("gold_borough", BOROUGH_SQL)(lambda s, d: gold.borough_summary(trips(s, d)))
register("gold_payment", PAYMENT_SQL)(lambda s, d: gold.payment_summary(trips(s, d)))
register("gold_hourly", HOURLY_SQL)(lambda s, d: gold.hourly_summary(trips(s, d)))

for _name, _key, _sql in (
    ("gold_daily_from_cube", "daily_summary", DAILY_SQL),
    ("gold_vendor_from_cube", "vendor_summary", VENDOR_SQL),
    ("gold_payment_from_cube", "payment_summary", PAYMENT_SQL),
    ("gold_hourly_from_cube", "hourly_summary", HOURLY_SQL),
):
    register(_name, _sql)(lambda s, d, k=_key: gold.gold_summaries(trips(s, d))[k])

register(
    "gold_busiest_days",
    f"SELECT * FROM ({DAILY_SQL}) ORDER BY total_trips DESC, trip_date LIMIT 10",
)(lambda s, d: gold.busiest_days(gold.daily_summary(trips(s, d))))

register("gold_latest_days", f"SELECT * FROM ({DAILY_SQL}) ORDER BY trip_date DESC LIMIT 10")(
    lambda s, d: gold.latest_days(gold.daily_summary(trips(s, d)))
)

register(
    "gold_vendors_on_day",
    f"SELECT * FROM ({VENDOR_SQL}) WHERE trip_date = DATE '1998-03-15' ORDER BY total_revenue DESC",
)(lambda s, d: gold.vendors_on(gold.vendor_summary(trips(s, d)), "1998-03-15"))

register(
    "gold_payment_sorted", f"SELECT * FROM ({PAYMENT_SQL}) ORDER BY trip_date DESC, trip_count DESC"
)(lambda s, d: gold.payment_summary(trips(s, d)).orderBy(*gold.sort_order("payment_summary")))

register(
    "layer_counts",
    """SELECT (SELECT COUNT(*) FROM bronze) AS bronze_rows,
              (SELECT COUNT(*) FROM silver WHERE pickup_year = 1998 AND pickup_month = 1)
                AS silver_rows""",
)(lambda s, d: gold.layer_counts(bronze(s, d), trips(s, d), 1998, 1))

register(
    "silver_month",
    "SELECT * FROM silver WHERE pickup_year = 1998 AND pickup_month = 1",
)(lambda s, d: trips(s, d).filter("pickup_year = 1998 AND pickup_month = 1"))

register(
    "preview_head",
    """SELECT l_orderkey, l_linenumber, tpep_pickup_datetime, fare_amount FROM silver
       ORDER BY tpep_pickup_datetime, l_orderkey, l_linenumber, fare_amount LIMIT 10""",
)(
    lambda s, d: trips(s, d)
    .select("l_orderkey", "l_linenumber", "tpep_pickup_datetime", "fare_amount")
    .orderBy("tpep_pickup_datetime", "l_orderkey", "l_linenumber", "fare_amount")
    .limit(10)
)

register(
    "preview_tail",
    """SELECT l_orderkey, l_linenumber, tpep_pickup_datetime, fare_amount FROM silver
       ORDER BY tpep_pickup_datetime DESC, l_orderkey DESC, l_linenumber DESC, fare_amount DESC
       LIMIT 10""",
)(
    lambda s, d: trips(s, d)
    .select("l_orderkey", "l_linenumber", "tpep_pickup_datetime", "fare_amount")
    .orderBy(*[F.desc(c) for c in ("tpep_pickup_datetime", "l_orderkey", "l_linenumber", "fare_amount")])
    .limit(10)
)

# ---------------------------------------------------------------- star

FACT_SQL = """
SELECT vendorid, pickup_datetime, dropoff_datetime, date_key, pickup_location_id,
       dropoff_location_id, payment_type, passenger_count,
       CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(fare_amount AS DOUBLE) AS fare_amount,
       CAST(tip_amount AS DOUBLE) AS tip_amount, CAST(total_amount AS DOUBLE) AS total_amount
FROM fact_trips"""


def star_query(name: str, sql: str):
    return register(name, sql, STAR_SQL)


star_query("fact_trips", FACT_SQL)(lambda s, d: star(s, d).fact_trips)
star_query("dim_zone", "SELECT * FROM dim_zone")(lambda s, d: star(s, d).dim_zone)
star_query("dim_date", "SELECT * FROM dim_date")(lambda s, d: star(s, d).dim_date)
star_query(
    "date_bounds",
    """SELECT min(CAST(pickup_datetime AS DATE)) AS min_date,
              max(CAST(pickup_datetime AS DATE)) AS max_date FROM fact_trips""",
)(lambda s, d: st.date_bounds(star(s, d).fact_trips))

star_query(
    "dim_payment_usage",
    """SELECT p.payment_type, p.payment_description, COUNT(f.payment_type) AS trips
       FROM dim_payment p LEFT JOIN fact_trips f ON f.payment_type = p.payment_type
       GROUP BY 1, 2""",
)(
    lambda s, d: st.dim_payment(s)
    .join(
        star(s, d).fact_trips.groupBy("payment_type").agg(F.count(F.lit(1)).alias("n")),
        "payment_type",
        "left",
    )
    .select("payment_type", "payment_description", F.coalesce("n", F.lit(0)).alias("trips"))
)

STAR_JOIN_FROM = """
FROM fact_trips f
JOIN dim_zone zp ON zp.location_id = f.pickup_location_id
JOIN dim_zone zd ON zd.location_id = f.dropoff_location_id
JOIN dim_date d ON d.date_key = f.date_key
JOIN dim_payment p ON p.payment_type = f.payment_type"""

star_query(
    "star_join",
    f"""SELECT f.vendorid, f.pickup_datetime, zp.zone AS pickup_zone, zd.zone AS dropoff_zone,
               d.full_date, d.is_weekend, p.payment_description,
               CAST(f.fare_amount AS DOUBLE) AS fare_amount {STAR_JOIN_FROM}""",
)(
    lambda s, d: st.star_join(star(s, d)).select(
        "f.vendorid", "f.pickup_datetime", F.col("zp.zone").alias("pickup_zone"),
        F.col("zd.zone").alias("dropoff_zone"), "d.full_date", "d.is_weekend",
        "p.payment_description", "f.fare_amount",
    )
)

ROLLUP_SQL = f"""
SELECT zp.borough AS pickup_borough, zd.borough AS dropoff_borough, d.day_name,
       p.payment_description, COUNT(*) AS trips,
       CAST(round(SUM(f.fare_amount), 2) AS DOUBLE) AS fare_revenue
{STAR_JOIN_FROM} GROUP BY 1, 2, 3, 4"""
star_query("star_rollup", ROLLUP_SQL)(lambda s, d: st.star_rollup(star(s, d)))
star_query(
    "star_rollup_top10",
    f"""SELECT * FROM ({ROLLUP_SQL})
        ORDER BY trips DESC, pickup_borough, dropoff_borough, day_name, payment_description LIMIT 10""",
)(lambda s, d: st.busiest_groups(star(s, d)))


def star_count_sql(*keys: str) -> str:
    listed = "".join(f", {k}" for k in keys)
    return f"""SELECT d.full_date AS trip_date{listed}, COUNT(*) AS trip_count
               FROM fact_trips f JOIN dim_date d ON d.date_key = f.date_key GROUP BY ALL"""


HOUR_EXPR = "CAST(hour(f.pickup_datetime) AS INTEGER) AS pickup_hour"
star_query("star_daily", star_count_sql())(lambda s, d: st.star_counts(star(s, d)))
star_query("star_vendor", star_count_sql("f.vendorid"))(
    lambda s, d: st.star_counts(star(s, d), "vendorid"))
star_query("star_payment", star_count_sql("f.payment_type"))(
    lambda s, d: st.star_counts(star(s, d), "payment_type"))
star_query("star_hourly", star_count_sql(HOUR_EXPR))(
    lambda s, d: st.star_counts(star(s, d), "pickup_hour"))


def mean_sql(column: str, digits: int) -> str:
    """Sum over count rounded half up, in whole numbers."""
    unit = 10**digits
    total = f"CAST(SUM({column}) * 100 AS HUGEINT) * {unit // 100}"
    return f"CAST((2 * {total} + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / {unit}.0"


REVENUE_SQL = f"""
SELECT d.full_date AS trip_date, CAST(SUM(f.fare_amount) AS DOUBLE) AS fare_revenue,
       {mean_sql('f.fare_amount', 4)} AS average_fare,
       {mean_sql('f.trip_distance', 4)} AS average_distance
FROM fact_trips f JOIN dim_date d ON d.date_key = f.date_key GROUP BY 1"""
star_query("star_revenue", REVENUE_SQL)(lambda s, d: st.star_revenue(star(s, d)))
star_query(
    "star_totals",
    f"""SELECT CAST(SUM(fare_amount) AS DOUBLE) AS total_fare_revenue,
               {mean_sql('fare_amount', 10)} AS weighted_average_fare,
               {mean_sql('trip_distance', 10)} AS weighted_average_distance,
               CAST(SUM(total_amount) AS DOUBLE) AS total_amount_sum
        FROM fact_trips""",
)(lambda s, d: st.star_totals(star(s, d).fact_trips))

# ---------------------------------------------------------------- reporting dataset

ZONE_COLUMNS_SQL = ", ".join(
    f"z{r[0]}.{c} AS {r}_{n}"
    for r in ("pickup", "dropoff")
    for c, n in (
        ("location_id", "zone_id"), ("borough", "borough"), ("zone", "zone_name"),
        ("service_zone", "service_zone"), ("golden_zone_row_id", "golden_zone_row_id"),
        ("version", "zone_version"),
    )
)
star_query(
    "bi_dataset",
    f"""
    SELECT f.vendorid, f.pickup_datetime, f.dropoff_datetime, f.date_key, f.pickup_location_id,
           f.dropoff_location_id, f.payment_type, f.passenger_count,
           CAST(f.trip_distance AS DOUBLE) AS trip_distance,
           CAST(f.fare_amount AS DOUBLE) AS fare_amount, CAST(f.tip_amount AS DOUBLE) AS tip_amount,
           CAST(f.total_amount AS DOUBLE) AS total_amount, {ZONE_COLUMNS_SQL},
           d.date_key AS dim_date_key, d.full_date AS trip_date, d.year AS trip_year,
           d.month AS trip_month, d.day AS trip_day, d.day_of_week AS trip_day_of_week,
           d.day_name, d.is_weekend, p.payment_type AS dim_payment_type, p.payment_description,
           CAST(hour(f.pickup_datetime) AS INTEGER) AS pickup_hour,
           CASE WHEN f.trip_distance < 1 THEN '1. 0-1 mi' WHEN f.trip_distance < 2 THEN '2. 1-2 mi'
                WHEN f.trip_distance < 5 THEN '3. 2-5 mi' WHEN f.trip_distance < 10 THEN '4. 5-10 mi'
                WHEN f.trip_distance < 20 THEN '5. 10-20 mi' ELSE '6. 20+ mi' END AS distance_band,
           CASE WHEN f.fare_amount < 10 THEN '1. $0-10' WHEN f.fare_amount < 20 THEN '2. $10-20'
                WHEN f.fare_amount < 30 THEN '3. $20-30' WHEN f.fare_amount < 50 THEN '4. $30-50'
                WHEN f.fare_amount < 100 THEN '5. $50-100' ELSE '6. $100+' END AS fare_band
    FROM fact_trips f
    LEFT JOIN dim_zone zp ON zp.location_id = f.pickup_location_id
    LEFT JOIN dim_zone zd ON zd.location_id = f.dropoff_location_id
    LEFT JOIN dim_date d ON d.date_key = f.date_key
    LEFT JOIN dim_payment p ON p.payment_type = f.payment_type
    """,
)(lambda s, d: bi_dataset(star(s, d)))

# ---------------------------------------------------------------- checks

ORPHANS = "FROM fact_trips f LEFT JOIN {dim} x ON x.{key} = f.{fk} WHERE x.{key} IS NULL"
DUPLICATES = "FROM (SELECT {key} FROM {dim} GROUP BY 1 HAVING COUNT(*) > 1)"
SILVER_COUNT = "(SELECT COUNT(*) FROM silver)"
SPAN = "CAST(max(CAST(tpep_pickup_datetime AS DATE)) - min(CAST(tpep_pickup_datetime AS DATE)) AS BIGINT) + 1"
CHECK_SQL = {
    "A": ("FROM fact_trips", SILVER_COUNT),
    "B": ("FROM dim_zone", "(SELECT COUNT(*) FROM nation)"),
    "C": ("FROM dim_date", f"(SELECT {SPAN} FROM silver)"),
    "D": ("FROM dim_payment", "7"),
    "E": (ORPHANS.format(dim="dim_zone", key="location_id", fk="pickup_location_id"), "0"),
    "F": (ORPHANS.format(dim="dim_zone", key="location_id", fk="dropoff_location_id"), "0"),
    "F2": (ORPHANS.format(dim="dim_payment", key="payment_type", fk="payment_type"), "0"),
    "F3": (ORPHANS.format(dim="dim_date", key="date_key", fk="date_key"), "0"),
    "G": (DUPLICATES.format(dim="dim_zone", key="location_id"), "0"),
    "G2": (DUPLICATES.format(dim="dim_date", key="date_key"), "0"),
    "G3": (DUPLICATES.format(dim="dim_payment", key="payment_type"), "0"),
    "H": ("FROM fact_trips WHERE " + " OR ".join(f"{c} IS NULL" for c in ck.REQUIRED_KEYS), "0"),
    "I": (STAR_JOIN_FROM, SILVER_COUNT),
    "O": ("FROM dim_zone WHERE location_id = 99999 OR borough ILIKE 'Test%' OR zone ILIKE 'Test%'", "0"),
    "O2": ("FROM dim_zone WHERE location_id NOT BETWEEN 1 AND 265", "0"),
    "P": ("FROM dim_zone WHERE golden_zone_row_id IS NULL OR version IS NULL OR "
          + " OR ".join(f"{c} IS NULL OR trim({c}) = ''" for c in ("borough", "zone", "service_zone")),
          "0"),
    "P2": (DUPLICATES.format(dim="dim_zone", key="golden_zone_row_id"), "0"),
    "P3": ("FROM (SELECT max(full_date) - min(full_date) + 1 AS span, COUNT(*) AS n FROM dim_date)"
           " WHERE span <> n", "0"),
}


def check_sql(check_id: str) -> str:
    source, expected = CHECK_SQL[check_id]
    return f"""SELECT '{ck.NAMES[check_id]}' AS check_name, actual, CAST({expected} AS BIGINT) AS expected,
                      CASE WHEN actual = {expected} THEN 'PASS' ELSE 'FAIL' END AS verdict
               FROM (SELECT COUNT(*) AS actual {source})"""


def expected_counts(cleaned: DataFrame, nations: DataFrame) -> dict:
    """Expected row counts of the star, taken from the layers below it."""
    day = F.to_date("tpep_pickup_datetime")
    span = F.datediff(F.max(day), F.min(day)) + 1
    return {
        "fact_trips": cleaned.agg(F.count(F.lit(1))).scalar(),
        "dim_zone": nations.agg(F.count(F.lit(1))).scalar(),
        "dim_date": cleaned.agg(span.alias("n")).scalar(),
        "dim_payment": len(st.PAYMENT_TYPES),
    }


def reconciliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks on the proxy star."""
    cleaned = trips(spark, sf_dir)
    expected = expected_counts(cleaned, table(spark, sf_dir, "nation"))
    return ck.run_checks(star(spark, sf_dir, cleaned), expected)


def one_check(spark: SparkSession, sf_dir: str, check_id: str) -> DataFrame:
    """A single check, from the group of checks that shares its scan."""
    cleaned = trips(spark, sf_dir)
    built = star(spark, sf_dir, cleaned)
    expected = expected_counts(cleaned, table(spark, sf_dir, "nation"))
    if check_id in ("B", "G", "O", "O2", "P", "P2"):
        group = ck.zone_checks(built.dim_zone, expected["dim_zone"], 1, 265)
    elif check_id in ("C", "G2", "P3"):
        group = ck.calendar_checks(built.dim_date, expected["dim_date"])
    elif check_id in ("D", "G3"):
        group = ck.payment_checks(built.dim_payment, expected["dim_payment"])
    else:
        group = ck.fact_checks(built, expected["fact_trips"])
    return group.filter(F.col("check_name") == ck.NAMES[check_id])


ALL_CHECKS_SQL = "\nUNION ALL\n".join(check_sql(i) for i in CHECK_SQL)
star_query("reconciliation", ALL_CHECKS_SQL)(reconciliation)
star_query(
    "reconciliation_tally",
    f"SELECT verdict, COUNT(*) AS checks FROM ({ALL_CHECKS_SQL}) GROUP BY 1",
)(lambda s, d: ck.tally(reconciliation(s, d)))
for _id in CHECK_SQL:
    star_query(f"check_{_id.lower()}", check_sql(_id))(
        lambda s, d, i=_id: one_check(s, d, i)
    )

BROKEN_ID = "P"


def broken_star(built: st.Star) -> st.Star:
    """The star with a zone whose service zone cannot be computed; one check alone reads it."""
    raised = F.when(F.col("location_id") == 1, F.raise_error(F.lit("service zone lost")).cast("string"))
    zones = built.dim_zone.withColumn("service_zone", raised.otherwise(F.col("service_zone")))
    return replace(built, dim_zone=zones)


@star_query(
    "reconciliation_with_an_error",
    "\nUNION ALL\n".join(
        f"SELECT '{ck.NAMES[i]}' AS check_name, CAST(NULL AS BIGINT) AS actual, "
        "CAST(NULL AS BIGINT) AS expected, 'FAIL' AS verdict" if i == BROKEN_ID else check_sql(i)
        for i in CHECK_SQL
    ),
)
def reconciliation_with_an_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eighteen checks where one raises: it fails, and the others keep their results."""
    cleaned = trips(spark, sf_dir)
    expected = expected_counts(cleaned, table(spark, sf_dir, "nation"))
    groups = ck.star_check_groups(broken_star(star(spark, sf_dir, cleaned)), expected)
    return ck.run_checks_apart(spark, groups).drop("error")


star_query(
    "load_summary",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ("dim_date", "dim_payment", "dim_zone", "fact_trips")
    ),
)(lambda s, d: row_count_manifest(star(s, d).tables()))


# ---------------------------------------------------------------- tie-outs


def tie_sql(left: str, right: str, keys: list[str], value: str, right_value: str, tolerance: float = 0,
            rounded: bool = False) -> str:
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys)
    names = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)
    other = f"round(b.{right_value}, 2)" if rounded else f"b.{right_value}"
    return f"""
    SELECT {names}, a.{value} AS left_value, {other} AS right_value,
           CASE WHEN abs(a.{value} - {other}) <= {tolerance} THEN 'PASS' ELSE 'FAIL' END AS verdict
    FROM ({left}) a FULL OUTER JOIN ({right}) b ON {on}"""


def tie_counts(name: str, keys: list[str], gold_fn, gold_sql: str, star_sql: str, *by: str,
               renames: dict[str, str] | None = None, count: str = "trip_count") -> None:
    def run(s: SparkSession, d: str) -> DataFrame:
        cleaned = stored_trips(s, d)
        left = st.star_counts(star(s, d, cleaned, stored=True), *by)
        right = gold_fn(cleaned).withColumnsRenamed({**(renames or {}), count: "trip_count"})
        return tie_out(left, right, keys, "trip_count")

    quoted = ", ".join(f'"{a}" AS {b}' for a, b in (renames or {}).items())
    extra = ", ".join(k for k in keys if k not in (renames or {}).values())
    columns = ", ".join(p for p in (extra, quoted) if p)
    right = f"SELECT {columns}, {count} AS trip_count FROM ({gold_sql})"
    star_query(name, tie_sql(star_sql, right, keys, "trip_count", "trip_count"))(run)


tie_counts("tie_out_daily", ["trip_date"], gold.daily_summary, DAILY_SQL, star_count_sql(),
           count="total_trips")
tie_counts("tie_out_vendor", ["trip_date", "vendorid"], gold.vendor_summary, VENDOR_SQL,
           star_count_sql("f.vendorid"), "vendorid", renames={"VendorID": "vendorid"})
tie_counts("tie_out_payment", ["trip_date", "payment_type"], gold.payment_summary, PAYMENT_SQL,
           star_count_sql("f.payment_type"), "payment_type")
tie_counts("tie_out_hourly", ["trip_date", "pickup_hour"], gold.hourly_summary, HOURLY_SQL,
           star_count_sql(HOUR_EXPR), "pickup_hour")
star_query(
    "tie_out_revenue",
    tie_sql(REVENUE_SQL, f"SELECT trip_date, total_revenue AS fare_revenue FROM ({DAILY_SQL})",
            ["trip_date"], "fare_revenue", "fare_revenue", 0.010000001, rounded=True),
)(lambda s, d: revenue_tie_out(s, d))


def revenue_tie_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = stored_trips(spark, sf_dir)
    return tie_out(
        st.star_revenue(star(spark, sf_dir, cleaned, stored=True)),
        gold.daily_summary(cleaned).withColumnRenamed("total_revenue", "fare_revenue"),
        ["trip_date"], "fare_revenue", tolerance=0.01, digits=2,
    )


# ---------------------------------------------------------------- profile

BRONZE_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "PULocationID", "DOLocationID", "payment_type", "fare_amount", "tip_amount", "total_amount",
    "RatecodeID", "store_and_fwd_flag", "extra", "tolls_amount", "l_orderkey", "l_linenumber",
)
register(
    "profile_missing",
    "SELECT * FROM ("
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, COUNT(*) - COUNT("{c}") AS missing,
                   floor(((COUNT(*) - COUNT("{c}")) * 20000 + COUNT(*)) / (2.0 * COUNT(*))) / 100.0
                     AS missing_pct FROM bronze"""
        for c in BRONZE_COLUMNS
    )
    + ") WHERE missing > 0",
)(lambda s, d: pf.missing_values(bronze(s, d)))

register(
    "profile_negative",
    " UNION ALL ".join(
        f"SELECT '{c}' AS measure, COUNT(*) FILTER (WHERE {c} < 0) AS negatives FROM bronze"
        for c in pf.NEGATIVE_MEASURES
    ),
)(lambda s, d: pf.negative_values(bronze(s, d)))

MINUTES = "(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 60000000.0"
register(
    "profile_invalid",
    " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, COUNT(*) FILTER (WHERE {condition}) AS rows FROM bronze"
        for name, condition in (
            ("passenger_count_not_positive", "passenger_count <= 0"),
            ("pickup_after_dropoff", "tpep_pickup_datetime > tpep_dropoff_datetime"),
            ("missing_pickup_location", '"PULocationID" IS NULL'),
            ("missing_dropoff_location", '"DOLocationID" IS NULL'),
            ("negative_duration", f"{MINUTES} < 0"),
            ("duration_over_180_minutes", f"{MINUTES} > 180"),
        )
    ),
)(lambda s, d: pf.invalid_counts(bronze(s, d)))

SECONDS = "(epoch_us(tpep_dropoff_datetime) - epoch_us(tpep_pickup_datetime)) / 1000000.0"
register(
    "profile_duration",
    " UNION ALL ".join(
        f"""SELECT CAST({p} AS DOUBLE) AS probability,
                   round(quantile_cont({SECONDS}, {p}) / 60.0, 2) AS duration_minutes FROM bronze"""
        for p in (0.95, 0.99)
    ),
)(lambda s, d: pf.duration_quantiles(bronze(s, d)))

MELTED = "(" + " UNION ALL ".join(
    f"SELECT '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM bronze WHERE {m} IS NOT NULL"
    for m in pf.DISTRIBUTION_MEASURES
) + ")"
register(
    "profile_histogram",
    f"""
    SELECT measure, bin, lo + bin * ((hi - lo) / 40.0) AS lower_edge,
           lo + (bin + 1) * ((hi - lo) / 40.0) AS upper_edge, COUNT(*) AS rows
    FROM (SELECT m.measure, lo, hi,
                 CAST(least(floor((value - lo) / ((hi - lo) / 40.0)), 39) AS INTEGER) AS bin
          FROM {MELTED} m
          JOIN (SELECT measure, min(value) AS lo, max(value) AS hi FROM {MELTED} GROUP BY 1) r
            ON r.measure = m.measure)
    GROUP BY measure, bin, lo, hi""",
)(lambda s, d: pf.histogram(bronze(s, d)))

MELTED4 = MELTED[:-1] + f" UNION ALL SELECT 'duration_seconds', {SECONDS} FROM bronze)"
register(
    "profile_boxplot",
    f"""
    SELECT measure, q1, median, q3,
           min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
             AS whisker_low,
           max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
             AS whisker_high,
           COUNT(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))
             AS outliers
    FROM (SELECT measure, value, quantile_cont(value, 0.25) OVER w AS q1,
                 quantile_cont(value, 0.5) OVER w AS median, quantile_cont(value, 0.75) OVER w AS q3
          FROM {MELTED4} WINDOW w AS (PARTITION BY measure))
    GROUP BY measure, q1, median, q3""",
)(lambda s, d: pf.box_plot(bronze(s, d)))

register(
    "profile_distinct",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name,
                   (SELECT string_agg(CAST(v AS VARCHAR), ',' ORDER BY v)
                    FROM (SELECT DISTINCT "{c}" AS v FROM bronze WHERE "{c}" IS NOT NULL
                          ORDER BY v LIMIT 20)) AS first_values,
                   (SELECT COUNT(DISTINCT "{c}") FROM bronze) AS distinct_count"""
        for c in pf.CATEGORIES
    ),
)(lambda s, d: pf.distinct_values(bronze(s, d)))

register(
    "profile_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS measure, COUNT({c}) AS non_null, {exact_mean(c)} AS mean,
                   CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum
            FROM bronze"""
        for c in pf.DISTRIBUTION_MEASURES
    ),
)(lambda s, d: pf.numeric_summary(bronze(s, d)))

TIME_COLUMNS = ("tpep_pickup_datetime", "tpep_dropoff_datetime")
TEXT_COLUMNS = ("store_and_fwd_flag",)
WIDTH_OF = {"int": 4, "double": 8, "bigint": 8, "timestamp_ntz": 8}
BRONZE_TYPES = {
    **dict.fromkeys(("VendorID", "passenger_count", "PULocationID", "DOLocationID", "payment_type", "RatecodeID"), "int"),
    **dict.fromkeys(TIME_COLUMNS, "timestamp_ntz"),
    **dict.fromkeys(("trip_distance", "fare_amount", "tip_amount", "total_amount", "extra", "tolls_amount"), "double"),
    **dict.fromkeys(TEXT_COLUMNS, "string"),
    "l_orderkey": "bigint",
    "l_linenumber": "int",
}


def described_sql(column: str) -> str:
    if column in TEXT_COLUMNS:
        return f"""SELECT '{column}' AS column_name, COUNT({column}) AS "count", CAST(COUNT(DISTINCT {column}) AS DOUBLE) AS "unique",
          (SELECT {column} FROM bronze WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 1) AS top,
          (SELECT CAST(COUNT(*) AS DOUBLE) FROM bronze WHERE {column} IS NOT NULL GROUP BY {column} ORDER BY 1 DESC LIMIT 1) AS freq,
          {", ".join(f"CAST(NULL AS DOUBLE) AS {n}" for n in pf.DESCRIBED[4:])} FROM bronze"""
    value = f'(epoch_us({column}) / 1000000.0)' if column in TIME_COLUMNS else f'CAST("{column}" AS DOUBLE)'
    spread = f"stddev_samp({value}) / 3600" if column in TIME_COLUMNS else f"stddev_samp({value})"
    return f"""SELECT '{column}' AS column_name, COUNT("{column}") AS "count", CAST(NULL AS DOUBLE) AS "unique",
          CAST(NULL AS VARCHAR) AS top, CAST(NULL AS DOUBLE) AS freq, {exact(value)} / COUNT("{column}") AS mean,
          round({spread}, 4) AS std, CAST(min({value}) AS DOUBLE) AS minimum, quantile_cont({value}, 0.25) AS q25,
          quantile_cont({value}, 0.5) AS median, quantile_cont({value}, 0.75) AS q75,
          CAST(max({value}) AS DOUBLE) AS maximum FROM bronze"""


@register("profile_describe", " UNION ALL ".join(described_sql(c) for c in BRONZE_COLUMNS))
def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column described; deviations rounded, those of times in hours."""
    spread = F.when(F.col("column_name").isin(*TIME_COLUMNS), F.col("std") / 3600).otherwise(F.col("std"))
    return pf.describe(bronze(spark, sf_dir)).withColumn("std", F.round(spread, 4))


register(
    "profile_schema",
    " UNION ALL ".join(
        f"""SELECT {place} AS position, '{c}' AS column_name, '{BRONZE_TYPES[c]}' AS data_type, COUNT("{c}") AS non_null,
                   CAST({'coalesce(SUM(strlen("' + c + '")), 0)' if c in TEXT_COLUMNS else f'COUNT("{c}") * {WIDTH_OF[BRONZE_TYPES[c]]}'} AS BIGINT)
                     AS data_bytes FROM bronze"""
        for place, c in enumerate(BRONZE_COLUMNS)
    ),
)(lambda s, d: pf.schema_rows(bronze(s, d)))

BRONZE_LIST = ", ".join(f'"{c}"' for c in BRONZE_COLUMNS)
DUPLICATE_ROWS = f"""(SELECT CAST(coalesce(SUM(copies), 0) AS BIGINT)
                      FROM (SELECT COUNT(*) AS copies FROM bronze GROUP BY {BRONZE_LIST}
                            HAVING COUNT(*) > 1))"""
register("full_duplicate_count", f"SELECT {DUPLICATE_ROWS} AS duplicate_rows")(
    lambda s, d: duplicate_row_count(bronze(s, d))
)
register(
    "quality_report",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS check_name, {value} AS records_affected,
                   '{action}' AS recommended_action, '{priority}' AS priority"""
        for name, value, action, priority in (
            ("Duplicate Rows", DUPLICATE_ROWS, "Remove", "High"),
            ("Negative Fare", "(SELECT COUNT(*) FROM bronze WHERE fare_amount < 0)", "Remove", "High"),
            ("Negative Trip Distance", "(SELECT COUNT(*) FROM bronze WHERE trip_distance < 0)",
             "Remove", "High"),
            ("Invalid Passenger Count", "(SELECT COUNT(*) FROM bronze WHERE passenger_count <= 0)",
             "Remove", "High"),
            ("Pickup After Dropoff",
             "(SELECT COUNT(*) FROM bronze WHERE tpep_pickup_datetime > tpep_dropoff_datetime)",
             "Remove", "High"),
            ("Missing Passenger Count", "(SELECT COUNT(*) FROM bronze WHERE passenger_count IS NULL)",
             "Review/Replace", "Medium"),
            ("Missing RatecodeID", '(SELECT COUNT(*) FROM bronze WHERE "RatecodeID" IS NULL)',
             "Review/Replace", "Medium"),
            ("Missing Store and Forward Flag",
             "(SELECT COUNT(*) FROM bronze WHERE store_and_fwd_flag IS NULL)",
             "Review/Replace", "Medium"),
            ("Missing Location IDs",
             '(SELECT COUNT(*) FROM bronze WHERE "PULocationID" IS NULL)'
             ' + (SELECT COUNT(*) FROM bronze WHERE "DOLocationID" IS NULL)',
             "Remove/Review", "Medium"),
        )
    ),
)(lambda s, d: pf.quality_report(bronze(s, d)))
