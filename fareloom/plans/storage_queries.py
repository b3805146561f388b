"""Queries that write given tables through the sinks and read them back, or read them by the readers."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fareloom.operators.audit import audit_rows, audit_view
from fareloom.operators.backfill import backfill_pointer
from fareloom.operators.contract import exists_in, require_columns, require_empty
from fareloom.operators.dedupe import duplicate_keys
from fareloom.operators.history import empty_history, scd2_merge
from fareloom.operators.keys import assign_ids
from fareloom.operators.reference import ZONE_ATTRIBUTES, vendor_accounts
from fareloom.plans.inputs import (
    BATCHES_SQL, EVERY_MATCH_SQL, RUNS_SQL, STAR_SQL, TRIPS_SQL, customer_golden, customer_zones,
    every_match, portable, runs, star, table, trips, vendor_rows,
)
from fareloom.plans.master_queries import second_load, standard_batch
from fareloom.plans.run_queries import (
    UPDATED_VALUE, VERSIONS_SQL, demo_facts, demo_history, demo_snapshots, evolved_rows,
)
from fareloom.plans.trip_queries import DAILY_SQL
from fareloom.session import shared_dir
from fareloom.sinks.ingest import ingest
from fareloom.sinks.loads import current_load, load_warehouse, publish_load, stage_load
from fareloom.sinks.versions import evidence, evolution_checks, keep_snapshot
from fareloom.sinks.writers import (
    RunSummary, append_run_summary, order_violations, publish_gold, publish_star, sorted_by_time,
    write_many, write_partitioned, write_snapshot,
)
from fareloom.sources import readers as rd
from fareloom.sources.catalog import register_table
from fareloom.sources.spec import landing_path, load_specs

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return add


def new_database(spark: SparkSession, purpose: str) -> str:
    """A database of its own in the shared folder."""
    name = f"{purpose}_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{name}` LOCATION '{shared_dir(spark, purpose)}'")
    return name


# ---------------------------------------------------------------- one load for all tables


@register(
    "load_moments",
    """
    WITH first AS (
      SELECT 'nation' AS table_name, COUNT(*) AS row_count, CAST(SUM(n_regionkey) AS BIGINT) AS total FROM nation
      UNION ALL SELECT 'orders', COUNT(*), CAST(SUM(o_custkey) AS BIGINT) FROM orders),
    second AS (
      SELECT 'nation' AS table_name, COUNT(*) AS row_count, CAST(SUM(n_regionkey + 100) AS BIGINT) AS total FROM nation
      UNION ALL SELECT 'orders', 2 * COUNT(*), 2 * CAST(SUM(o_custkey) AS BIGINT) FROM orders)
    SELECT moment, first.* FROM first,
      (VALUES ('first published'), ('second failed half-way'), ('second staged')) m(moment)
    UNION ALL SELECT 'second published', second.* FROM second""",
)
def load_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader sees while a second load of two tables fails, is staged again and published."""
    root, database = shared_dir(spark, "exports"), new_database(spark, "load")
    nation, orders = table(spark, sf_dir, "nation"), table(spark, sf_dir, "orders")
    exported = {
        "first/nation": nation,
        "first/orders": orders,
        "second/nation": nation.withColumn("n_regionkey", F.col("n_regionkey") + 100),
        "second/orders": orders.unionAll(orders),
    }
    for name, df in exported.items():
        write_snapshot(df, f"{root}/{name}")

    def seen(moment: str) -> DataFrame:
        tables = current_load(spark, database).frames(spark)
        sums = {"nation": "n_regionkey", "orders": "o_custkey"}
        return reduce(
            DataFrame.unionAll,
            [
                tables[name].agg(F.count(F.lit(1)).alias("row_count"), F.sum(column).cast("long").alias("total")).select(
                    F.lit(moment).alias("moment"), F.lit(name).alias("table_name"), "row_count", "total"
                )
                for name, column in sums.items()
            ],
        )

    load_warehouse(spark, {n: f"{root}/first/{n}" for n in ("orders", "nation")}, database)
    moments = [seen("first published")]
    try:
        stage_load(spark, {"orders": f"{root}/second/orders", "nation": f"{root}/second/absent"}, database)
    except PySparkException:
        moments.append(seen("second failed half-way"))
    second = stage_load(spark, {n: f"{root}/second/{n}" for n in ("orders", "nation")}, database)
    moments.append(seen("second staged"))
    publish_load(spark, second)
    moments.append(seen("second published"))
    return reduce(DataFrame.unionAll, moments)


@register(
    "load_statistics",
    """SELECT 'nation' AS table_name, COUNT(*) AS analysed_rows, COUNT(DISTINCT n_regionkey) AS distinct_values FROM nation
       UNION ALL SELECT 'region', COUNT(*), COUNT(DISTINCT r_regionkey) FROM region""",
)
def load_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics that the catalog holds for the tables of a load, analysed before it was let in."""
    root, database = shared_dir(spark, "exports"), new_database(spark, "load")
    columns = {"nation": "n_regionkey", "region": "r_regionkey"}
    for name in columns:
        write_snapshot(table(spark, sf_dir, name), f"{root}/{name}")
    load_warehouse(spark, {name: f"{root}/{name}" for name in columns}, database)
    load, found = current_load(spark, database), []
    for name, column in columns.items():
        told = {
            r.info_name: r.info_value
            for r in spark.sql(f"DESCRIBE EXTENDED {load.table_name(name)} {column}").collect()
        }
        size = next(
            r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {load.table_name(name)}").collect() if r.col_name == "Statistics"
        )
        found.append((name, int(size.split(",")[1].split()[0]), int(told["distinct_count"])))
    return spark.createDataFrame(found, "table_name string, analysed_rows bigint, distinct_values bigint")


# ---------------------------------------------------------------- snapshots and order

SNAPSHOT_BYTES = 512 * 1024


@register(
    "snapshot_files",
    """SELECT COUNT(*) AS row_count, CAST(SUM(o_custkey) AS BIGINT) AS total, 0 AS files_over_bound FROM orders""",
)
def snapshot_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders in files of a given size: all rows are there, and no file is twice the size aimed at."""
    path = shared_dir(spark, "snapshot")
    write_snapshot(table(spark, sf_dir, "orders"), path, target_bytes=SNAPSHOT_BYTES)
    stored = spark.read.parquet(path)
    sizes = stored.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"), "o_custkey"
    ).groupBy("file").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys"))
    return sizes.agg(
        F.sum("n").alias("row_count"),
        F.sum("keys").alias("total"),
        F.count_if(F.col("size") > 2 * SNAPSHOT_BYTES).cast("int").alias("files_over_bound"),
    )


@register(
    "sorted_layout_order",
    """SELECT layout, rule, violated, n AS row_count FROM (SELECT COUNT(*) AS n FROM events),
         (VALUES ('sorted', 'inside_files', FALSE), ('sorted', 'between_files', FALSE),
                 ('backwards', 'inside_files', TRUE), ('backwards', 'between_files', TRUE)) v(layout, rule, violated)""",
)
def sorted_layout_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order of events written by time, proved from the files; and of events dealt out by user, latest first, refuted."""
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    shapes = {
        "sorted": sorted_by_time(events, "ts"),
        "backwards": events.repartition(4, "user_id").sortWithinPartitions(F.desc("ts")),
    }
    found = []
    for layout, df in shapes.items():
        path = shared_dir(spark, "layout")
        df.write.parquet(path)
        stored = spark.read.parquet(path)
        found.append(
            order_violations(stored, "ts").select(
                F.lit(layout).alias("layout"), "rule", (F.col("violations") > 0).alias("violated"),
                stored.agg(F.count(F.lit(1))).scalar().alias("row_count"),
            )
        )
    return found[0].unionAll(found[1])


# ---------------------------------------------------------------- files of several shapes

SPLIT_DATE = "1995-06-01"


@register(
    "trips_widened",
    f"""SELECT l_orderkey, l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity,
               CASE WHEN l_shipdate >= DATE '{SPLIT_DATE}' THEN l_tax END AS l_tax FROM lineitem""",
)
def trips_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines from files of two shapes: int and long ids, int and double quantities, one without tax."""
    path = shared_dir(spark, "drifting")
    lines = table(spark, sf_dir, "lineitem")
    early = F.coalesce(F.col("l_shipdate") < F.lit(SPLIT_DATE).cast("date"), F.lit(True))
    lines.filter(early).select(
        F.col("l_orderkey").cast("int"), "l_linenumber", F.col("l_quantity").cast("int")
    ).write.parquet(f"{path}/part=1")
    lines.filter(~early).select(
        F.col("l_orderkey").cast("long"), "l_linenumber", F.col("l_quantity").cast("double"), "l_tax"
    ).write.parquet(f"{path}/part=2")
    return rd.read_trips(spark, path).select("l_orderkey", "l_linenumber", "l_quantity", "l_tax")


# ---------------------------------------------------------------- readers

ZONE_ROWS = """SELECT c_custkey + 1 AS location_id, upper(c_mktsegment) AS borough, upper(c_name) AS zone,
                      'ZONE ' || CAST(c_nationkey AS VARCHAR) AS service_zone FROM customer"""


def zone_file(spark: SparkSession, sf_dir: str, *headings: str) -> str:
    """Customer zones as a CSV file under the given headings; its path."""
    path = shared_dir(spark, "zone-file")
    named = {"location_id": "location_id", "locationid": "location_id", "servicezone": "service_zone"}
    columns = [F.col(named.get(h.lower(), h.lower())).alias(h) for h in headings]
    customer_zones(spark, sf_dir).select(*columns).write.option("header", "true").csv(path)
    return path


register(
    "zone_csv",
    f"""SELECT CAST(location_id AS INTEGER) AS "LocationID", borough AS "Borough", zone AS "Zone", service_zone FROM ({ZONE_ROWS})""",
)(lambda s, d: rd.read_zone_csv(s, zone_file(s, d, "LocationID", "Zone", "Borough", "service_zone")))

register("zone_seed", f"SELECT * REPLACE (CAST(location_id AS INTEGER) AS location_id) FROM ({ZONE_ROWS})")(
    lambda s, d: rd.read_zone_seed(s, zone_file(s, d, "Zone", "ServiceZone", "location_id", "Borough"))
)


@register(
    "csv_inferred",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal, 'int' AS key_type, 'double' AS balance_type FROM supplier""",
)
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers through a CSV file: values and the types found for them."""
    path = shared_dir(spark, "suppliers")
    table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal").write.option(
        "header", "true"
    ).csv(path)
    read = rd.read_csv_inferred(spark, path)
    kinds = dict(read.dtypes)
    return read.withColumns(
        {"key_type": F.lit(kinds["s_suppkey"]), "balance_type": F.lit(kinds["s_acctbal"])}
    )


def source_config(spark: SparkSession, sf_dir: str) -> dict:
    """A configuration of five sources: a zone file, one with repeated keys, an empty one, a missing one, and events."""
    root = shared_dir(spark, "sources")
    zones = customer_zones(spark, sf_dir)
    absent = F.when(F.col("location_id") % 11 == 0, "N/A").otherwise(F.col("service_zone"))
    files = {
        "zones": zones.withColumn("service_zone", absent),
        "repeated": zones.unionAll(zones.withColumn("zone", F.lit("AGAIN"))),
        "empty": zones.limit(0),
    }
    for name, df in files.items():
        df.withColumnRenamed("location_id", "LocationID").write.option("header", "true").csv(f"{root}/{name}")
    csv = {"type": "csv", "primary_key": "location_id", "column_mapping": {"LocationID": "location_id"}}
    entries = {name: csv | {"source": f"{root}/{name}"} for name in files}
    entries["zones"] |= {"required_columns": ["LocationID", "zone"], "destination_table": "taxi_zones"}
    entries["gone"] = csv | {"source": f"{root}/gone"}
    entries["events"] = {"type": "parquet", "source": f"{sf_dir}/events.parquet", "required_columns": ["event_id"]}
    return {"sources": entries}


@register(
    "fetched_sources",
    """SELECT 'zones' AS source, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE (c_custkey + 1) % 11 = 0) AS nulls,
              'bronze/reference/zones/zones' AS lands_at FROM customer
       UNION ALL SELECT 'events', COUNT(*), 0, 'bronze/transactions/events/events' FROM events""",
)
def fetched_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources read as their specs say: rows, values that the file marks as absent, and landing folder."""
    specs = load_specs(source_config(spark, sf_dir))
    probes = {"zones": "service_zone", "events": "event_id"}
    return reduce(
        DataFrame.unionAll,
        [
            rd.fetch(spark, specs[name]).agg(
                F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(column).isNull()).alias("nulls")
            ).select(F.lit(name).alias("source"), "row_count", "nulls", F.lit(landing_path(specs[name])).alias("lands_at"))
            for name, column in probes.items()
        ],
    )


@register(
    "ingest_status",
    """SELECT 'zones' AS source, 'LOADED' AS status, COUNT(*) AS row_count, COUNT(*) AS stored_rows,
              COUNT(*) FILTER (WHERE (c_custkey + 1) % 11 = 0) AS unknown_zones FROM customer
       UNION ALL SELECT 'repeated', 'INVALID', 2 * COUNT(*), NULL, NULL FROM customer
       UNION ALL SELECT 'empty', 'SKIPPED', 0, NULL, NULL
       UNION ALL SELECT 'gone', 'FAILED', NULL, NULL, NULL
       UNION ALL SELECT 'events', 'LANDED', COUNT(*), COUNT(*), NULL FROM events""",
)
def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five sources ingested, three of them faulty; what was landed and published is read back."""
    root, published = shared_dir(spark, "lake"), {}

    def publish(name: str, df: DataFrame) -> None:
        path = f"{root}/tables/{name}"
        df.write.parquet(path)
        published[name] = path

    status = ingest(spark, load_specs(source_config(spark, sf_dir)).values(), root, publish=publish)
    unknown = F.count_if(F.col("service_zone") == "Unknown").alias("unknown_zones")
    stored = [
        spark.read.parquet(published["taxi_zones"]).agg(F.count(F.lit(1)).alias("stored_rows"), unknown).select(
            F.lit("zones").alias("source"), "stored_rows", "unknown_zones"
        ),
        spark.read.parquet(f"{root}/bronze/transactions/events/events").agg(F.count(F.lit(1)).alias("stored_rows")).select(
            F.lit("events").alias("source"), "stored_rows", F.lit(None).cast("long").alias("unknown_zones")
        ),
    ]
    # One row for each source.
    return status.select("source", "status", "row_count").join(
        F.broadcast(reduce(DataFrame.unionAll, stored)), "source", "left"
    )


@register(
    "catalog_table",
    "SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users FROM events GROUP BY 1",
)
def catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitioned events registered as a table, and asked by SQL."""
    path, database = shared_dir(spark, "events-by-type"), new_database(spark, "catalog")
    write_partitioned(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), path, ["event_type"])
    name = register_table(spark, database, "events", path)
    return spark.sql(f"SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT user_id) AS users FROM {name} GROUP BY 1")


# ---------------------------------------------------------------- sinks and gates


@register("gold_published", f"WITH {TRIPS_SQL.strip()} {DAILY_SQL}")
def gold_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five summaries written under one root, and the daily one read back."""
    root = shared_dir(spark, "gold")
    publish_gold(trips(spark, sf_dir), root)
    return portable(spark.read.parquet(f"{root}/daily_summary"))


@register(
    "sinks_first_failure",
    """SELECT 'nation' AS dataset, COUNT(*) AS stored_rows FROM nation
       UNION ALL SELECT 'orders', NULL UNION ALL SELECT 'region', NULL""",
)
def sinks_first_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets of which the second cannot be computed: the first is stored, the third not begun."""
    root = shared_dir(spark, "sinks")
    broken = table(spark, sf_dir, "orders").withColumn("o_custkey", F.raise_error(F.lit("lost")).cast("long"))
    datasets = {"nation": table(spark, sf_dir, "nation"), "orders": broken, "region": table(spark, sf_dir, "region")}
    try:
        write_many({name: (df, f"{root}/{name}", ()) for name, df in datasets.items()})
    except PySparkException:
        pass
    found = []
    for name in datasets:
        try:
            rows = spark.read.parquet(f"{root}/{name}").count()
        except PySparkException:
            rows = None
        found.append((name, rows))
    return spark.createDataFrame(found, "dataset string, stored_rows bigint")


@register(
    "publish_gate",
    f"""WITH {STAR_SQL.strip()}
    SELECT 'refused' AS attempt, 'dim_zone has ' || COUNT(*) || ' rows, expected ' || (COUNT(*) + 1) AS outcome,
           CAST(NULL AS BIGINT) AS fact_rows FROM dim_zone
    UNION ALL SELECT 'accepted', (SELECT COUNT(*) FROM dim_zone) || ' zones', COUNT(*) FROM fact_trips""",
)
def publish_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The star refused where a dimension is a row short, and nothing written; then accepted and read back."""
    built, zones = star(spark, sf_dir), table(spark, sf_dir, "nation").count()
    refused, accepted = shared_dir(spark, "refused"), shared_dir(spark, "accepted")
    try:
        publish_star(built, refused, {"dim_payment": 7, "dim_zone": zones + 1})
        outcome = "accepted"
    except ValueError as error:
        outcome = str(error)
    paths = publish_star(built, accepted, {"dim_payment": 7, "dim_zone": zones})
    counts = {name: spark.read.parquet(path).count() for name, path in paths.items()}
    rows = [("refused", outcome, None), ("accepted", f"{counts['dim_zone']} zones", counts["fact_trips"])]
    return spark.createDataFrame(rows, "attempt string, outcome string, fact_rows bigint")


@register(
    "run_summary_log",
    f"""WITH {RUNS_SQL.strip()}
    SELECT job_name, 'SUCCEEDED' AS status, 90.5 AS duration_seconds, COUNT(*) FILTER (WHERE status = 'SUCCEEDED') AS inserted,
           COUNT(*) FILTER (WHERE status <> 'SUCCEEDED') AS errors FROM runs GROUP BY 1""",
)
def run_summary_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A summary of each job's runs appended to the run log, and the log read back."""
    path = shared_dir(spark, "run-log")
    good = F.col("status") == "SUCCEEDED"
    jobs = runs(spark, sf_dir).groupBy("job_name").agg(F.count_if(good).alias("ok"), F.count_if(~good).alias("bad"))
    start = datetime(2025, 1, 1)
    for job in jobs.collect():  # one row for each job
        end = start + timedelta(seconds=90.5)
        append_run_summary(spark, RunSummary(job.job_name, "SUCCEEDED", start, end, inserted=job.ok, errors=job.bad), path)
    return spark.read.json(path).select(
        "job_name", "status", "duration_seconds", "execution_summary.inserted", "execution_summary.errors"
    )


@register(
    "evidence_document",
    f"""WITH {VERSIONS_SQL.strip()}
    SELECT 'snapshot v0' AS part, CAST(COUNT(*) AS VARCHAR) AS value FROM customer_zones
    UNION ALL SELECT 'snapshot v1', CAST(COUNT(*) AS VARCHAR) FROM v1
    UNION ALL SELECT 'snapshot current', CAST(COUNT(*) AS VARCHAR) FROM v2
    UNION ALL SELECT 'operation APPEND', CAST(COUNT(*) AS VARCHAR) FROM v2
    UNION ALL SELECT 'passed', '8' UNION ALL SELECT 'verdict', 'true'""",
)
def evidence_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History, snapshots, checks and verdict of the demo written as JSON, and read back."""
    path, snapshots = shared_dir(spark, "evidence"), demo_snapshots(spark, sf_dir)
    facts, history = demo_facts(snapshots), demo_history(snapshots)
    added = evolved_rows(spark, sf_dir).agg(F.count(F.lit(1)))
    evidence(history, facts, evolution_checks(*facts, history, UPDATED_VALUE, added), path)

    def part(name: str, label: Column, value: Column, keep: Column | None = None) -> DataFrame:
        rows = spark.read.json(f"{path}/{name}")
        rows = rows if keep is None else rows.filter(keep)
        return rows.select(label.alias("part"), value.cast("string").alias("value"))

    passed = spark.read.json(f"{path}/checks").agg(F.count_if("passed").cast("string").alias("value"))
    return reduce(
        DataFrame.unionAll,
        [
            part("snapshots", F.concat(F.lit("snapshot "), "label"), F.col("row_count")),
            part("history", F.concat(F.lit("operation "), "operation"), F.col("row_count"), F.col("operation") == "APPEND"),
            passed.select(F.lit("passed").alias("part"), "value"),
            part("verdict", F.lit("verdict"), F.col("all_passed")),
        ],
    )


@register(
    "migration_gates",
    f"""WITH {EVERY_MATCH_SQL.strip()},
    unmapped AS (SELECT COUNT(*) AS n FROM every_match WHERE match_id % 2 = 0),
    doubled AS (SELECT COUNT(*) AS n FROM (SELECT location_id FROM golden GROUP BY 1 HAVING COUNT(*) > 1))
    SELECT 'unmapped pointers' AS gate, CASE WHEN n > 0 THEN 'refused' ELSE 'passed' END AS outcome FROM unmapped
    UNION ALL SELECT 'pointers after backfill', 'passed'
    UNION ALL SELECT 'several current versions', CASE WHEN n > 0 THEN 'refused' ELSE 'passed' END FROM doubled
    UNION ALL SELECT 'current versions', 'passed'
    UNION ALL SELECT 'required columns', 'refused'
    UNION ALL SELECT 'stacked duplicates', CASE WHEN n > 0 THEN 'found' ELSE 'none' END FROM doubled""",
)
def migration_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gates that refuse a faulty table and pass a sound one."""
    golden, matches = customer_golden(spark, sf_dir), every_match(spark, sf_dir)
    pointer = F.when(F.col("match_id") % 2 == 1, F.col("golden_zone_row_id"))
    loose = matches.withColumn("golden_zone_row_id", pointer)
    filled = backfill_pointer(loose, golden)
    all_current = golden.withColumn("is_current", F.lit(True))
    unmapped = lambda df: df.filter(F.col("golden_zone_row_id").isNull())
    doubled = lambda df: duplicate_keys(df.filter("is_current"), ["location_id"])

    def tried(gate) -> str:
        try:
            gate()
        except ValueError:
            return "refused"
        return "passed"

    stacked = exists_in(duplicate_keys(golden, ["golden_zone_row_id"]), duplicate_keys(golden, ["location_id"]))
    rows = [
        ("unmapped pointers", tried(lambda: require_empty(unmapped(loose), "pointers without a version"))),
        ("pointers after backfill", tried(lambda: require_empty(unmapped(filled), "pointers without a version"))),
        ("several current versions", tried(lambda: require_empty(doubled(all_current), "several current versions"))),
        ("current versions", tried(lambda: require_empty(doubled(golden), "several current versions"))),
        ("required columns", tried(lambda: require_columns(golden, ["location_id", "borough_code"]))),
        ("stacked duplicates", "found" if stacked else "none"),
    ]
    return spark.createDataFrame(rows, "gate string, outcome string")


@register(
    "default_effective_time",
    f"""WITH {BATCHES_SQL.strip()}
    SELECT COUNT(*) AS versions, CAST(1 AS BIGINT) AS times, TRUE AS in_the_run FROM batch1""",
)
def default_effective_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A merge without a given time: all versions get one, that of the run."""
    batch = standard_batch(spark, sf_dir, False)
    empty = empty_history(batch, "location_id", ZONE_ATTRIBUTES, "golden_zone_row_id")
    now = F.current_timestamp().cast("timestamp_ntz")
    before = spark.range(1).select(now.alias("t")).first().t
    history = scd2_merge(empty, batch, "location_id", ZONE_ATTRIBUTES).history
    late = F.lit(before + timedelta(hours=1)).cast("timestamp_ntz")
    return history.agg(
        F.count(F.lit(1)).alias("versions"),
        F.count_distinct("effective_date").alias("times"),
        ((F.min("effective_date") >= F.lit(before).cast("timestamp_ntz")) & (F.max("effective_date") < late)).alias("in_the_run"),
    )


@register(
    "vendor_accounts",
    """SELECT COUNT(*) AS records_read, COUNT(*) FILTER (WHERE s_suppkey % 13 = 0) AS invalid_removed,
              COUNT(*) FILTER (WHERE s_suppkey % 13 <> 0) - COUNT(DISTINCT s_suppkey) FILTER (WHERE s_suppkey % 13 <> 0)
                AS duplicates_removed,
              COUNT(DISTINCT s_suppkey) FILTER (WHERE s_suppkey % 13 <> 0) AS records_processed
       FROM supplier JOIN (VALUES (0), (1)) c(copy) ON copy = 0 OR s_suppkey % 7 = 0""",
)
def vendors_accounted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor rows read against those processed."""
    return vendor_accounts(vendor_rows(spark, sf_dir))


@register(
    "audit_log_view",
    f"""WITH {BATCHES_SQL.strip()},
    log AS (SELECT location_id, 'UPDATE' AS operation, end_date AS changed_at FROM versions WHERE end_date IS NOT NULL
            UNION ALL SELECT location_id, 'INSERT', effective_date FROM versions
            WHERE effective_date = TIMESTAMP '2024-02-01')
    SELECT 'golden_zones' AS table_name, CAST(location_id AS VARCHAR) AS record_id, operation,
           'loader' AS changed_by, changed_at, (SELECT COUNT(*) FROM log) AS highest_id FROM log""",
)
def audit_log_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit log of a merge stored, numbered, and shown in its reading order of columns."""
    log = audit_rows(second_load(spark, sf_dir), "location_id", "golden_zones", "loader", ["location_id", "version"])
    stored = keep_snapshot(log, shared_dir(spark, "audit-log"))
    view = audit_view(assign_ids(stored, ["record_id", "operation"], "audit_id"))
    highest = view.agg(F.max("audit_id")).scalar()
    return view.withColumn("highest_id", highest).drop("audit_id", "old_values", "new_values")
