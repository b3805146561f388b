"""Trips, zones, vendors and runs derived from the driver's tables.

Each input exists twice: as a DataFrame and as SQL text for the comparison
engine. Both state the same definition, over the whole table. Modulo conditions
only decide which rows carry a change, a fault or a repeat; in `customer_matches`
they decide which pairs are present already when matching runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fareloom.operators.clean import silver, valid_trips
from fareloom.operators.matching import resolve_current
from fareloom.operators.skew import hot_keys, lookup_join
from fareloom.operators.star import Star, build_star
from fareloom.session import shared_dir
from fareloom.sources.readers import read_table, spread_if_narrow

# ---------------------------------------------------------------- helpers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


_HOT_KEYS: dict[tuple[str, str, str], list] = {}


def table_hot_keys(spark: SparkSession, sf_dir: str, name: str, key: str) -> list:
    """Hot keys of a table column, looked for once per table and program run."""
    known = (sf_dir, name, key)
    if known not in _HOT_KEYS:
        _HOT_KEYS[known] = hot_keys(table(spark, sf_dir, name), key)
    return _HOT_KEYS[known]


def two_decimals(value: Column) -> Column:
    """Nearest hundredth, in plain double arithmetic."""
    return F.rint(value * 100) / F.lit(100.0)


def portable(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines print the same numbers."""
    decimals = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals}) if decimals else df


def hours(value: str | Column) -> Column:
    number = F.col(value) if isinstance(value, str) else value
    return F.make_dt_interval(F.lit(0), (number % 24).cast("int"), F.lit(0), F.lit(0))


# ---------------------------------------------------------------- trips


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as raw trips, with about one row in a hundred delivered twice."""
    copies = F.when(F.col("l_orderkey") % 97 == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
            "l_extendedprice", "l_tax", "l_discount", "l_returnflag", "l_shipdate",
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )
    # Orders meet customers first: that shuffles orders, not order lines, on the customer key.
    orders = (
        spread_if_narrow(table(spark, sf_dir, "orders"), "o_orderkey")
        .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    placed = lookup_join(
        orders, customers, "o_custkey", "c_custkey", table_hot_keys(spark, sf_dir, "orders", "o_custkey")
    )
    bought = lookup_join(
        lines, placed, "l_orderkey", "o_orderkey",
        table_hot_keys(spark, sf_dir, "lineitem", "l_orderkey"),
    )
    joined = lookup_join(
        bought, suppliers, "l_suppkey", "s_suppkey",
        table_hot_keys(spark, sf_dir, "lineitem", "l_suppkey"),
    )
    absent = F.col("l_partkey") % 50 == 0
    return joined.select(
        F.col("l_linenumber").cast("int").alias("VendorID"),
        (F.col("o_orderdate") + hours("l_orderkey")).alias("tpep_pickup_datetime"),
        (F.col("l_shipdate") + hours("l_partkey")).alias("tpep_dropoff_datetime"),
        F.when(~absent, F.col("l_quantity").cast("int") % 7).alias("passenger_count"),
        F.when(F.col("l_suppkey") % 40 == 0, -F.col("l_quantity"))
        .otherwise(F.col("l_quantity")).alias("trip_distance"),
        (F.col("c_nationkey") + 1).alias("PULocationID"),
        (F.col("s_nationkey") + 1).alias("DOLocationID"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("payment_type"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_tax") * 100).alias("tip_amount"),
        two_decimals(F.col("l_extendedprice") + F.col("l_tax") * 100).alias("total_amount"),
        F.when(~absent, (F.col("l_partkey") % 6 + 1).cast("int")).alias("RatecodeID"),
        F.when(~absent, F.when(F.col("l_returnflag") == "A", "Y").otherwise("N"))
        .alias("store_and_fwd_flag"),
        two_decimals(F.col("l_discount") * 100 - 2).alias("extra"),
        two_decimals(F.col("l_discount") * 100 - 1).alias("tolls_amount"),
        "l_orderkey",
        "l_linenumber",
    )


TRIPS_SQL = """
one AS (
  SELECT CAST(l_linenumber AS INTEGER) AS "VendorID",
         o_orderdate + CAST(l_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS tpep_pickup_datetime,
         l_shipdate + CAST(l_partkey % 24 AS INTEGER) * INTERVAL 1 HOUR AS tpep_dropoff_datetime,
         CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_quantity AS INTEGER) % 7 END AS passenger_count,
         CASE WHEN l_suppkey % 40 = 0 THEN -l_quantity ELSE l_quantity END AS trip_distance,
         c_nationkey + 1 AS "PULocationID",
         s_nationkey + 1 AS "DOLocationID",
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS payment_type,
         l_extendedprice AS fare_amount,
         l_tax * 100 AS tip_amount,
         round(l_extendedprice + l_tax * 100, 2) AS total_amount,
         CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey % 6 + 1 AS INTEGER) END AS "RatecodeID",
         CASE WHEN l_partkey % 50 <> 0
              THEN CASE WHEN l_returnflag = 'A' THEN 'Y' ELSE 'N' END END AS store_and_fwd_flag,
         round(l_discount * 100 - 2, 2) AS extra,
         round(l_discount * 100 - 1, 2) AS tolls_amount,
         l_orderkey, l_linenumber
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
),
bronze AS (SELECT * FROM one UNION ALL SELECT * FROM one WHERE l_orderkey % 97 = 0),
silver AS (
  SELECT *, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
         CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month
  FROM (SELECT DISTINCT * FROM bronze)
  WHERE trip_distance >= 0 AND fare_amount >= 0 AND passenger_count > 0
    AND tpep_pickup_datetime <= tpep_dropoff_datetime
    AND "VendorID" IS NOT NULL AND "PULocationID" IS NOT NULL AND "DOLocationID" IS NOT NULL
)"""


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The silver layer of the proxy trips."""
    return silver(bronze(spark, sf_dir))


def exact(column: str) -> str:
    """SQL of an order-independent sum: every value by its shortest decimal digits."""
    return f"CAST(CAST(SUM(CAST(CAST({column} AS VARCHAR) AS DECIMAL(38, 18))) AS VARCHAR) AS DOUBLE)"


def exact_mean(column: str) -> str:
    return f"{exact(column)} / COUNT({column})"


# ---------------------------------------------------------------- zones and star


def service_zone(key: str) -> Column:
    k = F.col(key) % 3
    return F.when(k == 0, "YELLOW ZONE").when(k == 1, "BORO ZONE").otherwise("AIRPORTS")


def nation_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs."""
    regions = table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "nation")
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            (F.col("n_nationkey") + 1).alias("location_id"),
            F.col("r_name").alias("borough"),
            F.col("n_name").alias("zone"),
            service_zone("n_regionkey").alias("service_zone"),
        )
    )


def nation_golden(zones: DataFrame) -> DataFrame:
    """One current master version per nation zone, and an expired one for even ids."""
    versions = F.when(F.col("location_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return (
        zones.withColumn("version", F.explode(versions))
        .withColumn("golden_zone_row_id", (F.col("location_id") * 10 + F.col("version")).cast("long"))
        .withColumn("is_current", (F.col("version") == 2) | (F.col("location_id") % 2 == 1))
    )


def current_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current master zones, resolved through the match table."""
    zones = nation_zones(spark, sf_dir)
    matches = zones.select(F.col("location_id").alias("source_zone_id"))
    return resolve_current(matches, zones, nation_golden(zones), 1, 265)


def stored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned trips written as a layer of their own, for what compares the layers above it."""
    cleaned, path = trips(spark, sf_dir), shared_dir(spark, "silver")
    cleaned.write.parquet(path)
    return spark.read.schema(cleaned.schema).parquet(path)


def star(
    spark: SparkSession, sf_dir: str, cleaned: DataFrame | None = None, stored: bool = False
) -> Star:
    """The proxy star. Resolution keeps ids 1..265, so the zone dimension is that small.

    ``stored`` trips also give the calendar's bounds.
    """
    cleaned = trips(spark, sf_dir) if cleaned is None else cleaned
    dated = cleaned if stored else valid_trips(bronze(spark, sf_dir))
    return build_star(cleaned, current_zones(spark, sf_dir), zone_bound=265, dated=dated)


STAR_SQL = TRIPS_SQL + """,
dim_zone AS (
  SELECT CAST(n_nationkey + 1 AS SMALLINT) AS location_id, r_name AS borough, n_name AS zone,
         CASE n_regionkey % 3 WHEN 0 THEN 'YELLOW ZONE' WHEN 1 THEN 'BORO ZONE'
                              ELSE 'AIRPORTS' END AS service_zone,
         CAST((n_nationkey + 1) * 10 + CASE WHEN (n_nationkey + 1) % 2 = 0 THEN 2 ELSE 1 END
              AS BIGINT) AS golden_zone_row_id,
         CAST(CASE WHEN (n_nationkey + 1) % 2 = 0 THEN 2 ELSE 1 END AS SMALLINT) AS version
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
fact_trips AS (
  SELECT CAST("VendorID" AS SMALLINT) AS vendorid,
         tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
         CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS INTEGER) AS date_key,
         CAST("PULocationID" AS SMALLINT) AS pickup_location_id,
         CAST("DOLocationID" AS SMALLINT) AS dropoff_location_id,
         CAST(payment_type AS SMALLINT) AS payment_type,
         CAST(passenger_count AS SMALLINT) AS passenger_count,
         CAST(trip_distance AS DECIMAL(10,2)) AS trip_distance,
         CAST(fare_amount AS DECIMAL(10,2)) AS fare_amount,
         CAST(tip_amount AS DECIMAL(10,2)) AS tip_amount,
         CAST(total_amount AS DECIMAL(10,2)) AS total_amount
  FROM silver
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
         CAST(year(d) AS SMALLINT) AS year, CAST(month(d) AS SMALLINT) AS month,
         CAST(day(d) AS SMALLINT) AS day, CAST(dayofweek(d) + 1 AS SMALLINT) AS day_of_week,
         dayname(d) AS day_name, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(min(CAST(pickup_datetime AS DATE)),
                                      max(CAST(pickup_datetime AS DATE)), INTERVAL 1 DAY)) AS d
        FROM fact_trips)
),
dim_payment AS (
  SELECT CAST(code AS SMALLINT) AS payment_type, text AS payment_description
  FROM (VALUES (0, 'Flex Fare trip'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
               (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip')) v(code, text)
)"""


# ---------------------------------------------------------------- master records


def customer_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as zone records in standard spelling; this table grows with the data."""
    return table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + 1).alias("location_id"),
        F.upper("c_mktsegment").alias("borough"),
        F.upper("c_name").alias("zone"),
        F.concat(F.lit("ZONE "), F.col("c_nationkey").cast("string")).alias("service_zone"),
    )


CUSTOMER_ZONES_SQL = """
customer_zones AS (
  SELECT c_custkey + 1 AS location_id, upper(c_mktsegment) AS borough, upper(c_name) AS zone,
         'ZONE ' || CAST(c_nationkey AS VARCHAR) AS service_zone
  FROM customer
)"""


def raw_batch(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    """A raw zone file made from customers: untidy spelling, some NULL attributes.

    The second delivery moves every tenth customer, changes only the spelling of
    the rest, loses some keys and brings new customers.
    """
    c = F.col("c_custkey")
    base = table(spark, sf_dir, "customer")
    if not second:
        return base.select(
            (c + 1).alias("location_id"),
            F.concat(F.lit("  "), F.lower("c_mktsegment")).alias("borough"),
            F.concat(F.col("c_name"), F.lit(" ")).alias("zone"),
            F.when(c % 11 != 0, F.concat(F.lit("Zone "), F.col("c_nationkey").cast("string")))
            .alias("service_zone"),
        )
    arrivals = F.when(c % 50 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    key = c + 1 + F.col("arrival") * 1_000_000_000_000
    return base.withColumn("arrival", F.explode(arrivals)).select(
        F.when((c % 401 != 0) | (F.col("arrival") == 1), key).alias("location_id"),
        F.when(c % 10 == 0, "moved").otherwise(F.upper("c_mktsegment")).alias("borough"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("zone"),
        F.when(c % 11 != 0, F.concat(F.lit("ZONE "), F.col("c_nationkey").cast("string")))
        .alias("service_zone"),
    )


BATCHES_SQL = """
batch1 AS (
  SELECT *, md5(concat_ws('|', CAST(location_id AS VARCHAR), coalesce(borough, ''),
                          coalesce(zone, ''), coalesce(service_zone, ''))) AS record_hash
  FROM (SELECT c_custkey + 1 AS location_id, upper(c_mktsegment) AS borough, upper(c_name) AS zone,
               CASE WHEN c_custkey % 11 <> 0
                    THEN 'ZONE ' || CAST(c_nationkey AS VARCHAR) END AS service_zone
        FROM customer)
),
batch2 AS (
  SELECT *, md5(concat_ws('|', CAST(location_id AS VARCHAR), coalesce(borough, ''),
                          coalesce(zone, ''), coalesce(service_zone, ''))) AS record_hash
  FROM (SELECT CASE WHEN c_custkey % 401 <> 0 OR arrival = 1
                    THEN c_custkey + 1 + arrival * 1000000000000 END AS location_id,
               CASE WHEN c_custkey % 10 = 0 THEN 'MOVED' ELSE upper(c_mktsegment) END AS borough,
               upper(c_name) AS zone,
               CASE WHEN c_custkey % 11 <> 0
                    THEN 'ZONE ' || CAST(c_nationkey AS VARCHAR) END AS service_zone
        FROM customer
        JOIN (VALUES (0), (1)) a(arrival) ON arrival = 0 OR c_custkey % 50 = 3)
),
judged AS (
  SELECT b.*, CASE WHEN b.location_id IS NULL THEN 'ERROR'
                   WHEN f.location_id IS NULL THEN 'INSERTED'
                   WHEN f.record_hash = b.record_hash THEN 'NO_CHANGE' ELSE 'UPDATED' END AS status
  FROM batch2 b LEFT JOIN batch1 f ON f.location_id = b.location_id
),
versions AS (
  SELECT f.location_id, f.borough, f.zone, f.service_zone, f.record_hash, 1 AS version,
         j.location_id IS NULL AS is_current, TIMESTAMP '2024-01-01' AS effective_date,
         CASE WHEN j.location_id IS NOT NULL THEN TIMESTAMP '2024-02-01' END AS end_date
  FROM batch1 f LEFT JOIN judged j ON j.location_id = f.location_id AND j.status = 'UPDATED'
  UNION ALL
  SELECT location_id, borough, zone, service_zone, record_hash,
         CASE status WHEN 'UPDATED' THEN 2 ELSE 1 END, TRUE, TIMESTAMP '2024-02-01', NULL
  FROM judged WHERE status IN ('INSERTED', 'UPDATED')
)"""


def customer_golden(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master versions of customer zones: every tenth one has moved in June 1998."""
    moved = F.col("location_id") % 10 == 0
    versions = F.when(moved, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    turn = F.lit("1998-06-01").cast("timestamp_ntz")
    return (
        customer_zones(spark, sf_dir)
        .withColumn("version", F.explode(versions))
        .select(
            F.col("location_id").alias("golden_id"),
            "location_id",
            F.when(F.col("version") == 2, "MOVED").otherwise(F.col("borough")).alias("borough"),
            "zone",
            "service_zone",
            (F.col("location_id") * 10 + F.col("version")).alias("golden_zone_row_id"),
            "version",
            ((F.col("version") == 2) | ~moved).alias("is_current"),
            F.when(F.col("version") == 2, turn)
            .otherwise(F.lit("1990-01-01").cast("timestamp_ntz")).alias("effective_date"),
            F.when(moved & (F.col("version") == 1), turn).alias("end_date"),
        )
    )


def customer_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rows of every third customer zone: the pairs already present when matching runs."""
    return every_match(spark, sf_dir).filter(F.col("source_zone_id") % 3 == 0)


def every_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match rows of every customer zone, made before any of them moved."""
    return customer_zones(spark, sf_dir).select(
        F.col("location_id").alias("match_id"),
        F.col("location_id").alias("golden_zone_id"),
        F.col("location_id").alias("source_zone_id"),
        (F.col("location_id") * 10 + 1).alias("golden_zone_row_id"),
        F.lit("1.0000").cast("decimal(5,4)").alias("confidence_score"),
        F.lit("confirmed").alias("status"),
        F.lit("insert").alias("operation"),
    )


GOLDEN_SQL = CUSTOMER_ZONES_SQL + """,
golden AS (
  SELECT location_id AS golden_id, location_id,
         CASE WHEN version = 2 THEN 'MOVED' ELSE borough END AS borough, zone, service_zone,
         location_id * 10 + version AS golden_zone_row_id, version,
         version = 2 OR location_id % 10 <> 0 AS is_current,
         CASE WHEN version = 2 THEN TIMESTAMP '1998-06-01' ELSE TIMESTAMP '1990-01-01' END
           AS effective_date,
         CASE WHEN version = 1 AND location_id % 10 = 0 THEN TIMESTAMP '1998-06-01' END AS end_date
  FROM customer_zones
  JOIN (VALUES (1), (2)) v(version) ON version = 1 OR location_id % 10 = 0
),
matches AS (
  SELECT location_id AS match_id, location_id AS golden_zone_id, location_id AS source_zone_id,
         location_id * 10 + 1 AS golden_zone_row_id, CAST(1.0 AS DECIMAL(5,4)) AS confidence_score,
         'confirmed' AS status, 'insert' AS operation
  FROM customer_zones WHERE location_id % 3 = 0
)"""

EVERY_MATCH_SQL = GOLDEN_SQL + """,
every_match AS (
  SELECT location_id AS match_id, location_id AS golden_zone_id, location_id AS source_zone_id,
         location_id * 10 + 1 AS golden_zone_row_id, CAST(1.0 AS DECIMAL(5,4)) AS confidence_score,
         'confirmed' AS status, 'insert' AS operation
  FROM customer_zones
)"""


def vendor_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as a raw vendor file under its alternative headings, with repeats and blanks."""
    k = F.col("s_suppkey")
    copies = F.when(k % 7 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return table(spark, sf_dir, "supplier").withColumn("copy", F.explode(copies)).select(
        (k + 1).cast("string").alias("vendor_id"),
        F.when(k % 13 == 0, F.lit("   "))
        .when(F.col("copy") == 1, F.lower("s_name"))
        .otherwise(F.concat(F.lit(" "), F.col("s_name"))).alias("VendorName"),
    )


# ---------------------------------------------------------------- runs and metrics


def run_status() -> Column:
    kind = F.col("event_type")
    return (
        F.when(kind.isin("purchase", "view"), "SUCCEEDED")
        .when(kind == "signup", "RUNNING")
        .when(kind == "click", "TIMEOUT")
        .otherwise("FAILED")
    )


def as_runs(events: DataFrame) -> DataFrame:
    """Events as run records; works on static and streaming frames."""
    spent = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("value").cast("decimal(18,6)"))
    return events.select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.concat(F.lit("job-"), (F.col("user_id") % 6).cast("string")).alias("job_name"),
        run_status().alias("status"),
        F.lit(None).cast("long").alias("records_processed"),
        F.col("ts").alias("started_at"),
        F.when(F.col("event_type") != "signup", F.col("ts") + spent).alias("completed_at"),
        F.floor("value").cast("long").alias("execution_seconds"),
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_runs(table(spark, sf_dir, "events"))


RUNS_SQL = """
runs AS (
  SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id,
         'job-' || CAST(user_id % 6 AS VARCHAR) AS job_name,
         CASE WHEN event_type IN ('purchase', 'view') THEN 'SUCCEEDED'
              WHEN event_type = 'signup' THEN 'RUNNING'
              WHEN event_type = 'click' THEN 'TIMEOUT' ELSE 'FAILED' END AS status,
         CAST(NULL AS BIGINT) AS records_processed,
         ts AS started_at,
         CASE WHEN event_type <> 'signup'
              THEN ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) END AS completed_at,
         CAST(floor(value) AS BIGINT) AS execution_seconds,
         event_id, event_type, user_id
  FROM events
)"""


def run_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Driver log lines of the runs, with good, partial and broken summaries."""
    k = F.get_json_object("props", "$.k")
    good = F.concat(
        F.lit('INFO Final job summary: {"job_name":"zones","status":"SUCCEEDED",'
              '"execution_summary":{"inserted":'), k,
        F.lit(',"updated":'), F.col("user_id").cast("string"),
        F.lit(',"no_change":1,"errors":5}}'),
    )
    failed = F.lit('INFO Final job summary: {"status":"FAILED","execution_summary":{"error":"lost"}}')
    later = F.lit('INFO Final job summary: {"execution_summary":{"inserted":999999}}')
    broken = F.lit("INFO Final job summary: {oops")
    summary = (
        F.when(F.col("event_type") == "error", failed)
        .when(F.col("event_type") == "click", broken)
        .otherwise(good)
    )
    lines = F.when(
        F.col("event_type") == "view", F.array(F.lit("INFO start"), F.lit("WARN no summary"))
    ).when(
        F.col("event_type") == "click", F.array(F.lit("INFO start"), summary)
    ).otherwise(F.array(F.lit("INFO start"), summary, later))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("run-"), F.col("event_id").cast("string")).alias("run_id"),
        F.posexplode(lines).alias("line_no", "message"),
    )


PROCESSED_SQL = """
processed AS (
  SELECT run_id, CASE WHEN event_type = 'error' THEN CAST(0 AS BIGINT)
                      ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) + user_id + 1
                 END AS records_processed
  FROM (SELECT 'run-' || CAST(event_id AS VARCHAR) AS run_id, * FROM events)
  WHERE event_type NOT IN ('view', 'click')
)"""


def as_points(events: DataFrame) -> DataFrame:
    """Events as metric points of all four alarm metrics."""
    def point(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("metric"), value.alias("value"))

    value, kind = F.col("value"), F.col("event_type")
    spent = point("compute_seconds", value * 5)
    entries = (
        F.when(kind == "error", F.array(spent, point("failed", F.lit(1.0))))
        .when(kind == "click", F.array(spent, point("timed_out", F.lit(1.0))))
        .when(kind.isin("purchase", "view"), F.array(spent, point("duration_ms", value * 10000)))
        .otherwise(F.array(spent))
    )
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), F.explode(entries).alias("p")
    ).select("ts", "p.metric", "p.value")


POINTS_SQL = """
points AS (
  SELECT ts, 'compute_seconds' AS metric, value * 5 AS value FROM events
  UNION ALL SELECT ts, 'failed', 1.0 FROM events WHERE event_type = 'error'
  UNION ALL SELECT ts, 'timed_out', 1.0 FROM events WHERE event_type = 'click'
  UNION ALL SELECT ts, 'duration_ms', value * 10000 FROM events
            WHERE event_type IN ('purchase', 'view')
)"""


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a file stream."""
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
