"""Queries over master records: cleaning, hashing, versions, matching, backfills, duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from fareloom.operators import backfill as bf, dedupe as dd, history as hs, matching as mt, merge as mg
from fareloom.operators.asof import as_of
from fareloom.operators.audit import audit_rows
from fareloom.operators.contract import duplicate_key_rows, type_recommendations, validation_report
from fareloom.operators.keys import assign_ids
from fareloom.operators.profile import RECOMMENDED_TYPES
from fareloom.operators.reference import (
    ZONE_ATTRIBUTES, clean_reference, clean_vendors, hash_vendors, standardise_and_hash,
)
from fareloom.plans.inputs import (
    BATCHES_SQL, CUSTOMER_ZONES_SQL, EVERY_MATCH_SQL, GOLDEN_SQL, TRIPS_SQL, bronze, customer_golden,
    customer_matches, customer_zones, every_match, portable, raw_batch, table, vendor_rows,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None, with_sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: portable(fn(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = (f"WITH {with_sql.strip()}\n" if with_sql else "") + sql.strip()
        return fn

    return add


# ---------------------------------------------------------------- cleaning and hashing


def standard_batch(spark: SparkSession, sf_dir: str, second: bool) -> DataFrame:
    return standardise_and_hash(raw_batch(spark, sf_dir, second), key_type="bigint")


register("zone_standardise_hash", "SELECT * FROM batch1", BATCHES_SQL)(
    lambda s, d: standard_batch(s, d, False)
)

register(
    "reference_clean",
    """
    SELECT location_id, trim(borough) AS borough, trim(zone) AS zone,
           CASE WHEN service_zone IS NULL OR trim(service_zone) = '' THEN 'Unknown'
                ELSE trim(service_zone) END AS service_zone
    FROM (SELECT DISTINCT c_custkey + 1 AS location_id, '  ' || lower(c_mktsegment) AS borough,
                 c_name || ' ' AS zone,
                 CASE WHEN c_custkey % 11 <> 0 THEN 'Zone ' || CAST(c_nationkey AS VARCHAR) END
                   AS service_zone
          FROM customer)
    """,
)(
    lambda s, d: clean_reference(
        raw_batch(s, d, False)
        .unionAll(raw_batch(s, d, False).filter("location_id % 5 = 0"))
        .withColumnsRenamed({"location_id": "LocationID", "borough": "Borough", "zone": "Zone"}),
        {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"},
    )
)

register(
    "vendor_clean_hash",
    """
    SELECT "VendorID", vendor_name,
           sha256(CAST("VendorID" AS VARCHAR) || '|' || lower(vendor_name)) AS record_hash
    FROM (SELECT CAST(s_suppkey + 1 AS INTEGER) AS "VendorID", min(s_name) AS vendor_name
          FROM supplier WHERE s_suppkey % 13 <> 0 OR s_suppkey % 7 = 0 AND s_suppkey % 13 <> 0
          GROUP BY 1)
    """,
)(lambda s, d: hash_vendors(clean_vendors(vendor_rows(s, d))))

# Type of each proxy trip column as the files hold it.
PROXY_TYPES = {
    "VendorID": "int", "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz", "passenger_count": "int", "trip_distance": "double",
    "PULocationID": "int", "DOLocationID": "int", "payment_type": "int", "fare_amount": "double",
    "tip_amount": "double", "total_amount": "double", "RatecodeID": "int",
    "store_and_fwd_flag": "string", "extra": "double", "tolls_amount": "double",
    "l_orderkey": "bigint", "l_linenumber": "int",
}
register(
    "type_recommendations",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, '{kind}' AS current_type,
                   {f"'{RECOMMENDED_TYPES[c]}'" if c in RECOMMENDED_TYPES else 'NULL'} AS recommended,
                   CAST(0 AS BIGINT) AS unconvertible, COUNT("{c}") AS non_null FROM bronze"""
        for c, kind in PROXY_TYPES.items()
    ),
    TRIPS_SQL,
)(lambda s, d: type_recommendations(bronze(s, d), RECOMMENDED_TYPES))

# ---------------------------------------------------------------- SCD type 2

FIRST_TIME, SECOND_TIME = "2024-01-01", "2024-02-01"
VERSION_COLUMNS = [
    "location_id", *ZONE_ATTRIBUTES, "record_hash", "version", "is_current", "effective_date",
    "end_date",
]


def first_load(spark: SparkSession, sf_dir: str) -> hs.MergeResult:
    batch = standard_batch(spark, sf_dir, False)
    empty = hs.empty_history(batch, "location_id", ZONE_ATTRIBUTES, "golden_zone_row_id")
    return hs.scd2_merge(empty, batch, "location_id", ZONE_ATTRIBUTES, FIRST_TIME)


def second_load(spark: SparkSession, sf_dir: str) -> hs.MergeResult:
    return hs.scd2_merge(
        first_load(spark, sf_dir).history,
        standard_batch(spark, sf_dir, True),
        "location_id",
        ZONE_ATTRIBUTES,
        SECOND_TIME,
    )


register(
    "scd2_first_load",
    """SELECT location_id, borough, zone, service_zone, record_hash, 1 AS version,
              TRUE AS is_current, TIMESTAMP '2024-01-01' AS effective_date,
              CAST(NULL AS TIMESTAMP) AS end_date FROM batch1""",
    BATCHES_SQL,
)(lambda s, d: first_load(s, d).history.select(*VERSION_COLUMNS))

register("scd2_change", "SELECT * FROM versions", BATCHES_SQL)(
    lambda s, d: second_load(s, d).history.select(*VERSION_COLUMNS)
)

register(
    "scd2_statuses", "SELECT status, COUNT(*) AS rows FROM judged GROUP BY 1", BATCHES_SQL
)(lambda s, d: second_load(s, d).statuses)

register(
    "scd2_no_change",
    "SELECT 'NO_CHANGE' AS status, COUNT(*) AS rows FROM batch1",
    BATCHES_SQL,
)(
    lambda s, d: hs.scd2_merge(
        first_load(s, d).history, standard_batch(s, d, False), "location_id", ZONE_ATTRIBUTES,
        SECOND_TIME,
    ).statuses
)


def wide_merge(spark: SparkSession, sf_dir: str) -> hs.MergeResult:
    """The second of two batches merged into a history with ids, times and a remark of its own."""
    first, second = (standard_batch(spark, sf_dir, later) for later in (False, True))
    history = hs.empty_history(first, "location_id", ZONE_ATTRIBUTES, "golden_zone_row_id").withColumns({
        "golden_id": F.lit(None).cast("int"),
        "created_at": F.lit(None).cast("timestamp_ntz"),
        "updated_at": F.lit(None).cast("timestamp_ntz"),
        "remark": F.lit(None).cast("string"),
        "origin": F.lit(None).cast("string"),
    })
    for batch, when in ((first, FIRST_TIME), (second, SECOND_TIME)):
        merged = hs.scd2_merge(
            history, batch, "location_id", ZONE_ATTRIBUTES, when, recorded=when,
            numbered=["golden_id"], defaults={"origin": F.lit("batch")},
        )
        history = merged.history
    return merged


def wide_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_merge(spark, sf_dir).history


def with_id_order(history: DataFrame) -> DataFrame:
    """What SQL can tell of ids: their order within a key, and the highest one."""
    highest = history.agg(F.max("golden_id").cast("long")).scalar()
    order = F.row_number().over(Window.partitionBy("location_id").orderBy("golden_id"))
    return history.withColumns({"id_order": order, "highest": highest})


register(
    "scd2_wide_history",
    """SELECT *, effective_date AS created_at, COALESCE(end_date, effective_date) AS updated_at,
              CAST(NULL AS VARCHAR) AS remark, 'batch' AS origin, version AS id_order,
              (SELECT COUNT(*) FROM versions) AS highest
       FROM versions""",
    BATCHES_SQL,
)(
    lambda s, d: with_id_order(wide_load(s, d)).select(
        *VERSION_COLUMNS, "created_at", "updated_at", "remark", "origin", "id_order", "highest"
    )
)


def event_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a row of its user, without an order."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("vendor_id"), F.col("event_type").alias("vendor_name"),
        F.md5("event_type").alias("record_hash"), "event_id",
    )


register(
    "scd2_ambiguous_rejects",
    """SELECT user_id AS vendor_id, event_type AS vendor_name, event_id FROM events
       WHERE user_id IN (SELECT user_id FROM events GROUP BY 1 HAVING COUNT(DISTINCT event_type) > 1)""",
)(
    lambda s, d: hs.scd2_merge(
        hs.empty_history(event_types(s, d), "vendor_id", ["vendor_name"], "vendor_row_id"),
        event_types(s, d), "vendor_id", ["vendor_name"], FIRST_TIME, row_id="vendor_row_id",
    ).rejects.select("vendor_id", "vendor_name", "event_id")
)

register(
    "scd2_rejects",
    """SELECT borough, zone, service_zone, 'location_id must not be null' AS reason
       FROM judged WHERE status = 'ERROR'""",
    BATCHES_SQL,
)(lambda s, d: second_load(s, d).rejects.select(*ZONE_ATTRIBUTES, "reason"))

JSON_FIELDS = ("location_id", "borough", "version", "is_current")


def json_sql(version: str, current: str, borough: str = "borough") -> str:
    return (
        f"""'{{"location_id":' || CAST(location_id AS VARCHAR) || ',"borough":"' || {borough} || """
        f"""'","version":{version},"is_current":{current}}}'"""
    )


register(
    "scd2_audit",
    f"""
    SELECT 'golden_zones' AS table_name, CAST(location_id AS VARCHAR) AS record_id,
           'UPDATE' AS operation, 'loader' AS changed_by, end_date AS changed_at,
           {json_sql('1', 'true')} AS old_values, {json_sql('1', 'false')} AS new_values
    FROM versions WHERE end_date IS NOT NULL
    UNION ALL
    SELECT 'golden_zones', CAST(location_id AS VARCHAR), 'INSERT', 'loader', effective_date, NULL,
           CASE version WHEN 1 THEN {json_sql('1', 'true')} ELSE {json_sql('2', 'true')} END
    FROM versions WHERE effective_date = TIMESTAMP '2024-02-01'
    """,
    BATCHES_SQL,
)(
    lambda s, d: audit_rows(
        second_load(s, d), "location_id", "golden_zones", "loader", JSON_FIELDS
    )
)


WIDE_FIELDS = ("location_id", "version", "is_current", "end_date", "created_at", "updated_at", "origin")


def wide_json_sql(version: str, closed: bool, created: str, updated: str) -> str:
    stamp = lambda t: f"""'"{t}T00:00:00.000"'"""
    end = stamp(SECOND_TIME) if closed else "'null'"
    return (
        f"""'{{"location_id":' || CAST(location_id AS VARCHAR) || ',"version":{version},"is_current":"""
        f"""{'false' if closed else 'true'},"end_date":' || {end} || ',"created_at":' || {stamp(created)}"""
        f""" || ',"updated_at":' || {stamp(updated)} || ',"origin":"batch"}}'"""
    )


register(
    "scd2_audit_wide",
    f"""
    SELECT CAST(location_id AS VARCHAR) AS record_id, 'UPDATE' AS operation, end_date AS changed_at,
           {wide_json_sql('1', False, FIRST_TIME, FIRST_TIME)} AS old_values,
           {wide_json_sql('1', True, FIRST_TIME, SECOND_TIME)} AS new_values
    FROM versions WHERE end_date IS NOT NULL
    UNION ALL
    SELECT CAST(location_id AS VARCHAR), 'INSERT', effective_date, NULL,
           CASE version WHEN 1 THEN {wide_json_sql('1', False, SECOND_TIME, SECOND_TIME)}
                        ELSE {wide_json_sql('2', False, SECOND_TIME, SECOND_TIME)} END
    FROM versions WHERE effective_date = TIMESTAMP '{SECOND_TIME}'
    """,
    BATCHES_SQL,
)(
    lambda s, d: audit_rows(
        wide_merge(s, d), "location_id", "golden_zones", "loader", WIDE_FIELDS
    ).select("record_id", "operation", "changed_at", "old_values", "new_values")
)

# The images of closed versions, held against the history's own rows: none differs.
register(
    "scd2_audit_images",
    "SELECT COUNT(*) AS closed_versions, CAST(0 AS BIGINT) AS differing FROM versions WHERE end_date IS NOT NULL",
    BATCHES_SQL,
)(lambda s, d: audit_differences(wide_merge(s, d)))


def audit_differences(merged: hs.MergeResult) -> DataFrame:
    """Closed versions, and how many of them have an audit image that is not the history's row."""
    names = list(merged.expired.columns)
    images = audit_rows(merged, "location_id", "golden_zones", "loader", names).filter("operation = 'UPDATE'")
    rows = merged.expired.select(F.to_json(F.struct(*names), {"ignoreNullFields": "false"}).alias("row"))
    return images.join(rows, F.col("new_values") == F.col("row"), "left").agg(
        F.count(F.lit(1)).alias("closed_versions"), F.count_if(F.col("row").isNull()).alias("differing")
    )


def event_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of its user's state; one user may change very often."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("vendor_id"),
        F.col("event_type").alias("vendor_name"),
        F.md5("event_type").alias("record_hash"),
        F.col("ts").alias("changed_at"),
        "event_id",
    )


def event_chain(spark: SparkSession, sf_dir: str) -> hs.MergeResult:
    batch = event_batch(spark, sf_dir)
    seed = batch.groupBy("vendor_id").agg(F.min("event_id").alias("event_id")).filter(
        "vendor_id % 2 = 0"
    ).select(
        F.col("vendor_id").alias("vendor_row_id"),
        "vendor_id",
        F.lit("signup").alias("vendor_name"),
        F.md5(F.lit("signup")).alias("record_hash"),
        F.lit(1).alias("version"),
        F.lit(True).alias("is_current"),
        F.lit("2000-01-01").cast("timestamp_ntz").alias("effective_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
    )
    return hs.scd2_merge(
        seed, batch, "vendor_id", ["vendor_name"], F.col("changed_at"), arrival="event_id",
        row_id="vendor_row_id",
    )


CHAIN_SQL = """
seeded AS (
  SELECT DISTINCT user_id AS vendor_id, 'signup' AS vendor_name, TIMESTAMP '2000-01-01' AS since,
         CAST(-1 AS BIGINT) AS event_id FROM events WHERE user_id % 2 = 0
  UNION ALL SELECT user_id, event_type, ts, event_id FROM events
),
changed AS (
  SELECT * FROM (SELECT *, lag(vendor_name) OVER (PARTITION BY vendor_id ORDER BY event_id) AS before
                 FROM seeded)
  WHERE before IS NULL OR before <> vendor_name
),
chain AS (
  SELECT vendor_id, vendor_name, md5(vendor_name) AS record_hash,
         CAST(row_number() OVER w AS INTEGER) AS version,
         lead(since) OVER w IS NULL AS is_current, since AS effective_date,
         lead(since) OVER w AS end_date
  FROM changed WINDOW w AS (PARTITION BY vendor_id ORDER BY event_id)
)"""
register("scd2_chain", "SELECT * FROM chain", CHAIN_SQL)(
    lambda s, d: event_chain(s, d).history.drop("vendor_row_id")
)
register(
    "scd2_chain_statuses",
    """SELECT status, COUNT(*) AS rows FROM (
         SELECT CASE WHEN c.event_id IS NULL THEN 'NO_CHANGE' WHEN c.before IS NULL THEN 'INSERTED'
                     ELSE 'UPDATED' END AS status
         FROM seeded s LEFT JOIN changed c USING (vendor_id, event_id) WHERE s.event_id >= 0)
       GROUP BY 1""",
    CHAIN_SQL,
)(lambda s, d: event_chain(s, d).statuses)

register(
    "scd2_invariants",
    """SELECT rule, CAST(0 AS BIGINT) AS violations
       FROM (VALUES ('missing_columns'), ('version_below_one'), ('empty_interval'),
                    ('closed_but_current'), ('several_current'), ('version_gap')) v(rule)""",
)(lambda s, d: hs.history_violations(event_chain(s, d).history, "vendor_id"))

FAULTY_SQL = BATCHES_SQL + """,
faulty AS (
  SELECT location_id, CASE WHEN location_id % 11 = 0 AND version = 1 THEN 5 ELSE version END AS version,
         is_current OR (location_id % 7 = 0 AND version = 1) AS is_current,
         CASE WHEN location_id % 17 <> 0 THEN effective_date END AS effective_date,
         CASE WHEN location_id % 13 = 0 AND is_current THEN effective_date ELSE end_date END AS end_date
  FROM versions),
per_key AS (
  SELECT COUNT(*) FILTER (WHERE is_current) AS currents, COUNT(*) AS n, min(version) AS low, max(version) AS high,
         COUNT(DISTINCT version) AS versions
  FROM faulty GROUP BY location_id)"""

register(
    "scd2_invariants_faulty",
    """SELECT 'missing_columns' AS rule,
              COUNT(*) FILTER (WHERE version IS NULL OR is_current IS NULL OR effective_date IS NULL) AS violations FROM faulty
       UNION ALL SELECT 'version_below_one', COUNT(*) FILTER (WHERE version < 1) FROM faulty
       UNION ALL SELECT 'empty_interval', COUNT(*) FILTER (WHERE end_date <= effective_date) FROM faulty
       UNION ALL SELECT 'closed_but_current', COUNT(*) FILTER (WHERE is_current AND end_date IS NOT NULL) FROM faulty
       UNION ALL SELECT 'several_current', COUNT(*) FILTER (WHERE currents > 1) FROM per_key
       UNION ALL SELECT 'version_gap', COUNT(*) FILTER (WHERE versions <> n OR high - low + 1 <> n) FROM per_key""",
    FAULTY_SQL,
)(lambda s, d: hs.history_violations(faulty_history(s, d), "location_id"))


def faulty_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history with gaps, several current rows, closed current rows and missing times."""
    key, history = F.col("location_id"), second_load(spark, sf_dir).history
    ended = F.when((key % 13 == 0) & F.col("is_current"), F.col("effective_date")).otherwise(F.col("end_date"))
    return history.select(
        "location_id",
        F.when((key % 11 == 0) & (F.col("version") == 1), 5).otherwise(F.col("version")).alias("version"),
        (F.col("is_current") | ((key % 7 == 0) & (F.col("version") == 1))).alias("is_current"),
        F.when(key % 17 != 0, F.col("effective_date")).alias("effective_date"),
        ended.alias("end_date"),
    )


register(
    "surrogate_ids",
    """SELECT COUNT(*) AS n, COUNT(*) AS distinct_ids, CAST(1 AS BIGINT) AS lowest,
              COUNT(*) AS highest FROM orders""",
)(
    lambda s, d: assign_ids(table(s, d, "orders"), ["o_orderkey"], "row_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row_id").alias("distinct_ids"),
        F.min("row_id").alias("lowest"),
        F.max("row_id").alias("highest"),
    )
)

# ---------------------------------------------------------------- matching and resolution

MATCH_SQL = """
SELECT g.golden_id AS golden_zone_id, z.location_id AS source_zone_id, g.golden_zone_row_id,
       CAST(1.0 AS DOUBLE) AS confidence_score, 'confirmed' AS status, 'insert' AS operation
FROM customer_zones z JOIN golden g ON g.location_id = z.location_id AND g.is_current
WHERE NOT EXISTS (SELECT 1 FROM matches m WHERE m.source_zone_id = z.location_id
                  AND m.golden_zone_row_id = g.golden_zone_row_id)"""
register("zone_match", MATCH_SQL, GOLDEN_SQL)(
    lambda s, d: mt.match_zones(
        customer_zones(s, d), customer_golden(s, d), customer_matches(s, d)
    ).drop("match_id")
)


def all_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing matches and the new ones: a moved zone then has two rows."""
    old = customer_matches(spark, sf_dir)
    return old.unionByName(
        mt.match_zones(customer_zones(spark, sf_dir), customer_golden(spark, sf_dir), old)
    )


register(
    "match_summary",
    f"""SELECT COUNT(*) AS total_matches, COUNT(DISTINCT source_zone_id) AS distinct_source_zones,
               COUNT(*) FILTER (WHERE status = 'confirmed') AS confirmed,
               COUNT(*) FILTER (WHERE confidence_score = 1) AS exact_matches,
               COUNT(*) FILTER (WHERE golden_zone_row_id IS NULL) AS orphans
        FROM ({MATCH_SQL} UNION ALL SELECT golden_zone_id, source_zone_id, golden_zone_row_id,
              confidence_score, status, operation FROM matches)""",
    GOLDEN_SQL,
)(lambda s, d: mt.match_summary(all_matches(s, d)))

ID_LIMIT = 2**62
register(
    "resolve_current",
    """SELECT g.location_id, g.borough, g.zone, g.service_zone, g.golden_zone_row_id, g.version
       FROM golden g WHERE g.is_current
         AND g.location_id IN (SELECT location_id FROM customer_zones)""",
    GOLDEN_SQL,
)(
    lambda s, d: mt.resolve_current(
        all_matches(s, d), customer_zones(s, d), customer_golden(s, d), 1, ID_LIMIT
    )
)

register(
    "stale_pointer",
    """SELECT g.location_id, g.golden_zone_row_id, g.version
       FROM every_match m JOIN golden g ON g.location_id = m.source_zone_id AND g.is_current
       WHERE m.golden_zone_row_id <> g.golden_zone_row_id""",
    EVERY_MATCH_SQL,
)(
    lambda s, d: mt.stale_pointers(
        every_match(s, d), customer_zones(s, d), customer_golden(s, d), 1, ID_LIMIT
    )
)

register(
    "match_details",
    """SELECT m.match_id, m.status, CAST(m.confidence_score AS DOUBLE) AS confidence_score,
              g.golden_id, g.borough AS golden_borough, g.zone AS golden_zone,
              g.service_zone AS golden_service_zone, z.location_id AS source_location_id,
              z.borough AS source_borough, z.zone AS source_zone,
              z.service_zone AS source_service_zone
       FROM every_match m JOIN golden g ON m.golden_zone_id = g.golden_id
       JOIN customer_zones z ON m.source_zone_id = z.location_id""",
    EVERY_MATCH_SQL,
)(lambda s, d: mt.match_details(every_match(s, d), customer_golden(s, d), customer_zones(s, d)))

register(
    "match_domains",
    """SELECT COUNT(*) FILTER (WHERE source_zone_id % 9 = 0) AS bad_score,
              COUNT(*) FILTER (WHERE source_zone_id % 12 = 0) AS bad_status,
              COUNT(*) FILTER (WHERE source_zone_id % 7 = 0) AS bad_operation
       FROM every_match""",
    EVERY_MATCH_SQL,
)(
    lambda s, d: mt.match_domain_violations(
        every_match(s, d).withColumns(
            {
                "confidence_score": F.when(
                    F.col("source_zone_id") % 9 == 0, F.lit("1.5").cast("decimal(5,4)")
                ).otherwise(F.col("confidence_score")),
                "status": F.when(F.col("source_zone_id") % 12 == 0, "odd").otherwise(F.col("status")),
                "operation": F.when(F.col("source_zone_id") % 7 == 0, "odd").otherwise(F.col("operation")),
            }
        )
    )
)

FAR = 10**15
register(
    "foreign_keys",
    f"""SELECT 'source_zone_id' AS rule, COUNT(*) AS violations
       FROM (SELECT CASE WHEN source_zone_id % 4 = 0 THEN source_zone_id + {FAR}
                         ELSE source_zone_id END AS source_zone_id FROM every_match) m
       WHERE NOT EXISTS (SELECT 1 FROM customer_zones z WHERE z.location_id = m.source_zone_id)
       UNION ALL
       SELECT 'golden_zone_row_id', COUNT(*) FROM every_match m
       WHERE NOT EXISTS (SELECT 1 FROM golden g
                         WHERE g.is_current AND g.golden_zone_row_id = m.golden_zone_row_id)""",
    EVERY_MATCH_SQL,
)(
    lambda s, d: mt.foreign_key_violations(
        every_match(s, d).withColumn(
            "source_zone_id",
            F.col("source_zone_id") + F.when(F.col("source_zone_id") % 4 == 0, FAR).otherwise(0),
        ),
        customer_zones(s, d),
        mt.current_version(customer_golden(s, d)),
    )
)

ASOF_SQL = """
SELECT o.o_orderkey, o.o_orderdate, g.version AS asof_version, g.borough AS asof_borough
FROM orders o LEFT JOIN golden g ON g.location_id = o.o_custkey + 1
  AND o.o_orderdate >= g.effective_date
  AND o.o_orderdate < coalesce(g.end_date, TIMESTAMP '9999-12-31')"""


def orders_as_of(spark: SparkSession, sf_dir: str, **limits) -> DataFrame:
    facts = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", (F.col("o_custkey") + 1).alias("_zone")
    )
    found = as_of(
        facts, customer_golden(spark, sf_dir), "_zone", "o_orderdate", "location_id",
        ["version", "borough"], **limits,
    )
    return found.drop("_zone")


register("as_of_zone", ASOF_SQL, GOLDEN_SQL)(orders_as_of)
register("as_of_zone_by_month", ASOF_SQL, GOLDEN_SQL)(
    lambda s, d: orders_as_of(s, d, slice_rows=500)
)

# ---------------------------------------------------------------- merges


def changed_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch overwriting every fifth zone and adding one for every eighth."""
    key = F.col("location_id")
    zones = customer_zones(spark, sf_dir)
    known = zones.filter(key % 5 == 0).withColumn("borough", F.lit("CHANGED"))
    fresh = zones.filter(key % 8 == 0).withColumn("location_id", -key)
    return known.unionByName(fresh)


CHANGED_SQL = CUSTOMER_ZONES_SQL + """,
changed AS (
  SELECT location_id, 'CHANGED' AS borough, zone, service_zone FROM customer_zones
  WHERE location_id % 5 = 0
  UNION ALL SELECT -location_id, borough, zone, service_zone FROM customer_zones
  WHERE location_id % 8 = 0
)"""
register(
    "scd1_upsert",
    """SELECT * FROM changed
       UNION ALL SELECT * FROM customer_zones
       WHERE location_id NOT IN (SELECT location_id FROM changed)""",
    CHANGED_SQL,
)(lambda s, d: mg.scd1_merge(customer_zones(s, d), changed_zones(s, d), ["location_id"]))

register(
    "scd1_touched",
    """SELECT z.location_id, c.location_id IS NOT NULL AS touched
       FROM (SELECT location_id FROM customer_zones UNION SELECT location_id FROM changed) z
       LEFT JOIN changed c ON c.location_id = z.location_id AND c.location_id > 0""",
    CHANGED_SQL,
)(
    lambda s, d: mg.scd1_merge(
        customer_zones(s, d).withColumn("updated_at", F.lit(None).cast("timestamp_ntz")),
        changed_zones(s, d),
        ["location_id"],
        ("updated_at", F.lit("2024-02-01").cast("timestamp_ntz")),
    ).select("location_id", F.col("updated_at").isNotNull().alias("touched"))
)

register(
    "insert_ignore",
    """SELECT * FROM customer_zones
       UNION ALL SELECT * FROM changed
       WHERE location_id NOT IN (SELECT location_id FROM customer_zones)""",
    CHANGED_SQL,
)(lambda s, d: mg.insert_ignore(customer_zones(s, d), changed_zones(s, d), ["location_id"]))

register(
    "seed_if_absent",
    """SELECT s_name AS vendor_name FROM supplier
       UNION ALL SELECT 'VeriFone Inc.' UNION ALL SELECT 'Creative Mobile Technologies'""",
)(
    lambda s, d: mg.seed_if_absent(
        table(s, d, "supplier").select(F.col("s_name").alias("vendor_name")),
        s.createDataFrame(
            [("Creative Mobile Technologies",), ("VeriFone Inc.",), ("Supplier#000000001",)],
            "vendor_name string",
        ),
        "vendor_name",
    )
)

register(
    "conditional_update",
    """SELECT location_id, borough, zone,
              CASE WHEN location_id = 1 THEN 'DEMO_UPDATED' ELSE service_zone END AS service_zone
       FROM customer_zones""",
    CUSTOMER_ZONES_SQL,
)(
    lambda s, d: mg.conditional_update(
        customer_zones(s, d), F.col("location_id") == 1, {"service_zone": F.lit("DEMO_UPDATED")}
    )
)

# ---------------------------------------------------------------- backfills


def keyless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones with every third key lost; zone names are cut so that some pairs repeat."""
    key = F.col("location_id")
    return pairs_of(spark, sf_dir).withColumn("location_id", F.when(key % 3 != 0, key))


def pairs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.when(F.col("location_id") % 4 == 0, F.substring("zone", 1, 16)).otherwise(F.col("zone"))
    return customer_zones(spark, sf_dir).withColumn("zone", short)


PAIRS_SQL = CUSTOMER_ZONES_SQL + """,
pairs AS (
  SELECT location_id, borough,
         CASE WHEN location_id % 4 = 0 THEN substr(zone, 1, 16) ELSE zone END AS zone, service_zone
  FROM customer_zones
),
filled AS (
  SELECT CASE WHEN p.location_id % 3 <> 0 THEN p.location_id ELSE u.found END AS location_id,
         p.borough, p.zone, p.service_zone
  FROM pairs p LEFT JOIN (SELECT borough, zone, min(location_id) AS found FROM pairs
                          GROUP BY 1, 2 HAVING COUNT(*) = 1) u
    ON u.borough = p.borough AND u.zone = p.zone
)"""
register("key_backfill", "SELECT * FROM filled", PAIRS_SQL)(
    lambda s, d: bf.backfill_key(keyless(s, d), pairs_of(s, d))
)
register(
    "key_backfill_report",
    """SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE location_id IS NULL) AS null_keys
       FROM filled""",
    PAIRS_SQL,
)(lambda s, d: bf.key_report(bf.backfill_key(keyless(s, d), pairs_of(s, d))))

register(
    "pointer_backfill",
    """SELECT match_id, golden_zone_id, golden_zone_row_id FROM every_match""",
    EVERY_MATCH_SQL,
)(
    lambda s, d: bf.backfill_pointer(
        every_match(s, d).withColumn(
            "golden_zone_row_id",
            F.when(F.col("match_id") % 2 == 0, F.col("golden_zone_row_id")),
        ),
        customer_golden(s, d),
    ).select("match_id", "golden_zone_id", "golden_zone_row_id")
)

register(
    "scd_column_backfill",
    """SELECT location_id, 1 AS version, TRUE AS is_current,
              CASE WHEN location_id % 2 = 0 THEN TIMESTAMP '2024-01-01'
                   ELSE TIMESTAMP '2020-01-01' END AS effective_date
       FROM customer_zones""",
    CUSTOMER_ZONES_SQL,
)(
    lambda s, d: bf.backfill_scd_columns(
        customer_zones(s, d).withColumns(
            {
                "version": F.when(F.col("location_id") % 2 == 0, F.lit(1)),
                "is_current": F.when(F.col("location_id") % 2 == 0, F.lit(True)),
                "effective_date": F.when(
                    F.col("location_id") % 2 == 0, F.lit("2024-01-01").cast("timestamp_ntz")
                ),
                "end_date": F.lit(None).cast("timestamp_ntz"),
                "created_at": F.lit("2020-01-01").cast("timestamp_ntz"),
            }
        )
    ).select("location_id", "version", "is_current", "effective_date")
)

register(
    "surrogate_backfill",
    """SELECT COUNT(*) AS n, COUNT(*) AS distinct_ids,
              max(c_custkey) FILTER (WHERE c_custkey % 3 <> 0)
                + COUNT(*) FILTER (WHERE c_custkey % 3 = 0) AS highest
       FROM customer""",
)(
    lambda s, d: bf.backfill_surrogate(
        table(s, d, "customer").select(
            "c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey")).alias("row_id")
        ),
        "row_id",
        ["c_custkey"],
    ).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("row_id").alias("distinct_ids"),
        F.max("row_id").alias("highest"),
    )
)

# ---------------------------------------------------------------- duplicates and validation

LINE_COLUMNS = [
    "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_quantity",
    "l_extendedprice",
]
LINE_KEY = ["l_orderkey", "l_linenumber"]


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)


LISTED = ", ".join(LINE_COLUMNS)
register(
    "dup_key_listing",
    f"""SELECT {LISTED} FROM lineitem
        QUALIFY COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)(lambda s, d: dd.repeated_keys(lines(s, d), LINE_KEY))

register(
    "dup_key_hot",
    """SELECT event_id, event_type, user_id FROM events
       QUALIFY COUNT(*) OVER (PARTITION BY event_type) > 1""",
)(
    lambda s, d: dd.repeated_keys(
        table(s, d, "events").select("event_id", "event_type", "user_id"), ["event_type"]
    )
)

for _keep, _order in (("first", "ASC"), ("last", "DESC")):
    _ordered = ", ".join(
        f"{c} {_order}" for c in ["l_shipdate", *[c for c in LINE_COLUMNS if c != "l_shipdate"]]
    )
    register(
        f"dedupe_keep_{_keep}",
        f"""SELECT {LISTED} FROM lineitem
            QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ordered}) = 1""",
    )(lambda s, d, k=_keep: dd.keep_one(lines(s, d), LINE_KEY, ["l_shipdate"], k))

register(
    "dedupe_keep_none",
    f"""SELECT {LISTED} FROM lineitem
        QUALIFY COUNT(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1""",
)(lambda s, d: dd.keep_one(lines(s, d), LINE_KEY, ["l_shipdate"], "none"))

register(
    "dup_keys",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
       GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)(lambda s, d: dd.duplicate_keys(lines(s, d), LINE_KEY))

register(
    "full_dup_listing",
    """SELECT l_orderkey, l_linenumber, COUNT(*) AS copies FROM lineitem
       GROUP BY 1, 2 HAVING COUNT(*) > 1""",
)(lambda s, d: dd.duplicated_rows(lines(s, d).select(*LINE_KEY)))

register(
    "validation_report",
    """SELECT FALSE AS is_valid, COUNT(*) AS row_count, 'zone' AS missing_columns,
              (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM lineitem
               GROUP BY l_orderkey HAVING COUNT(*) > 1)) AS duplicate_key_rows,
              'Validation failed: Missing required columns; Duplicate primary keys found.' AS summary
       FROM lineitem""",
)(
    lambda s, d: validation_report(
        lines(s, d), ["l_orderkey", "zone"], "order_key", {"l_orderkey": "order_key"}
    )
)

register(
    "validation_ok",
    """SELECT TRUE AS is_valid, COUNT(*) AS row_count, '' AS missing_columns,
              CAST(0 AS BIGINT) AS duplicate_key_rows, 'Validation successful.' AS summary
       FROM orders""",
)(lambda s, d: validation_report(table(s, d, "orders"), ["o_orderkey"], "o_orderkey"))

register(
    "duplicate_primary_keys",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
       QUALIFY COUNT(*) OVER (PARTITION BY l_orderkey) > 1""",
)(
    lambda s, d: duplicate_key_rows(
        table(s, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey"), "l_orderkey"
    )
)
