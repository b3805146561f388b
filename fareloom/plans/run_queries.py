"""Queries over runs, logs, alarms, versioned tables and the streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fareloom.operators import runs as rn
from fareloom.operators.merge import conditional_update
from fareloom.operators.tieout import compare_manifests, row_count_manifest
from fareloom.plans.inputs import (
    CUSTOMER_ZONES_SQL, POINTS_SQL, PROCESSED_SQL, RUNS_SQL, as_points, as_runs, customer_zones,
    event_stream, run_lines, runs, table,
)
from fareloom.session import shared_dir
from fareloom.sinks import versions as vs
from fareloom.sinks.writers import sorted_by_time, write_partitioned
from fareloom.streaming import runs as srn
from fareloom.streaming.alarms import alarm_stream, alarms, late_points, read_windows, stored_alarms

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None, with_sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = (f"WITH {with_sql.strip()}\n" if with_sql else "") + sql.strip()
        return fn

    return add


# ---------------------------------------------------------------- run history

register(
    "runs_view",
    """SELECT run_id, job_name, status, records_processed, started_at, completed_at,
              (epoch_us(completed_at) - epoch_us(started_at)) / 1000000.0 AS execution_time_seconds
       FROM runs""",
    RUNS_SQL,
)(lambda s, d: rn.run_view(runs(s, d)))

register(
    "run_stats",
    """SELECT job_name, COUNT(*) AS runs, COUNT(*) FILTER (WHERE status = 'SUCCEEDED') AS succeeded,
              CAST(coalesce(floor(avg(execution_seconds) FILTER (WHERE status = 'SUCCEEDED')), 0)
                AS BIGINT) AS avg_seconds,
              coalesce(max(execution_seconds) FILTER (WHERE status = 'SUCCEEDED'), 0) AS max_seconds
       FROM runs GROUP BY 1""",
    RUNS_SQL,
)(lambda s, d: rn.runs_summary(runs(s, d)))

register("status_tally", "SELECT status, COUNT(*) AS runs FROM runs GROUP BY 1", RUNS_SQL)(
    lambda s, d: rn.status_tally(runs(s, d))
)

FAILURES_SQL = """SELECT run_id, job_name, status, started_at FROM runs
                  WHERE status IN ('FAILED', 'TIMEOUT', 'ERROR') AND job_name IN ('job-1', 'job-2')"""
WATCHED = ["job-1", "job-2"]
register("failure_filter", FAILURES_SQL, RUNS_SQL)(
    lambda s, d: rn.failed_runs(runs(s, d), WATCHED).select("run_id", "job_name", "status", "started_at")
)

register("log_summary", "SELECT * FROM processed", PROCESSED_SQL)(
    lambda s, d: rn.records_processed(run_lines(s, d))
)

register(
    "collect_runs",
    """SELECT r.run_id, r.job_name, r.status, p.records_processed, r.started_at, r.completed_at
       FROM runs r LEFT JOIN processed p USING (run_id) WHERE r.status <> 'RUNNING'""",
    RUNS_SQL + "," + PROCESSED_SQL,
)(lambda s, d: rn.collect_runs(runs(s, d), run_lines(s, d)))

HISTORY_COLUMNS = ["run_id", "job_name", "status", "started_at", "completed_at"]


def known_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A history that already holds every seventh run, under an older status."""
    return (
        rn.terminal_runs(runs(spark, sf_dir))
        .filter(F.expr("cast(substring(run_id, 5) as bigint)") % 7 == 0)
        .withColumn("status", F.lit("STOPPED"))
    )


def redelivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run records, a part of them delivered again later under another status."""
    every = runs(spark, sf_dir)
    later = every.filter(F.col("job_name") == "job-3").withColumn("status", F.lit("ERROR"))
    return every.withColumn("arrival", F.lit(1)).unionAll(later.withColumn("arrival", F.lit(2)))


register(
    "sync_runs",
    """SELECT run_id, job_name, CASE WHEN event_id % 7 = 0 THEN 'STOPPED' ELSE status END AS status,
              started_at, completed_at
       FROM runs WHERE status <> 'RUNNING'""",
    RUNS_SQL,
)(lambda s, d: rn.sync_runs(known_runs(s, d), redelivered(s, d), "arrival").select(*HISTORY_COLUMNS))

register(
    "sync_runs_added",
    "SELECT COUNT(*) AS rows_added FROM runs WHERE status <> 'RUNNING' AND event_id % 7 <> 0",
    RUNS_SQL,
)(lambda s, d: rn.added_runs(known_runs(s, d), redelivered(s, d), "arrival"))

# ---------------------------------------------------------------- alarms


def alarm_sql(rule: rn.Alarm) -> str:
    micros = int(rule.period.split()[0]) * 1_000_000
    value = (
        "CAST(SUM(CAST(round(value * 1000) AS BIGINT)) AS DOUBLE) / 1000.0"
        if rule.statistic == "sum" else "CAST(max(value) AS DOUBLE)"
    )
    compare = ">=" if rule.inclusive else ">"
    return f"""
    SELECT '{rule.name}' AS alarm, make_timestamp(w * {micros}) AS window_start,
           make_timestamp((w + 1) * {micros}) AS window_end, value
    FROM (SELECT epoch_us(ts) // {micros} AS w, {value} AS value FROM points
          WHERE metric = '{rule.metric}' GROUP BY 1)
    WHERE value {compare} {rule.threshold}"""


register("alarm_windows", " UNION ALL ".join(alarm_sql(a) for a in rn.ALARMS), POINTS_SQL)(
    lambda s, d: alarms(as_points(table(s, d, "events")))
)

# ---------------------------------------------------------------- streams


@register("stream_failures", FAILURES_SQL, RUNS_SQL)
def stream_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = shared_dir(spark, "stream-failures")
    stream = as_runs(event_stream(spark, sf_dir)).select("run_id", "job_name", "status", "started_at")
    srn.watch_failures(stream, f"{root}/out", f"{root}/checkpoint", WATCHED).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/out")


SYNC_SCHEMA = (
    "run_id string, job_name string, status string, started_at timestamp_ntz, "
    "completed_at timestamp_ntz"
)


@register(
    "stream_sync_runs",
    """SELECT run_id, job_name, status, started_at, completed_at FROM runs
       WHERE status <> 'RUNNING'""",
    RUNS_SQL,
)
def stream_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conflicting deliveries in one micro-batch, then all again under a new checkpoint.

    The first delivery of a run stays, and the second pass adds nothing.
    """
    root = shared_dir(spark, "stream-sync")
    redelivered(spark, sf_dir).select(*HISTORY_COLUMNS, "arrival").write.parquet(f"{root}/in")
    for checkpoint in ("first", "second"):
        stream = spark.readStream.schema(f"{SYNC_SCHEMA}, arrival int").parquet(f"{root}/in")
        srn.sync_stream(
            stream, f"{root}/history", f"{root}/checkpoint-{checkpoint}", SYNC_SCHEMA, "arrival"
        ).awaitTermination()
    return srn.read_history(spark, f"{root}/history", SYNC_SCHEMA).select(*HISTORY_COLUMNS)


DELIVERIES = 3


def delivered_alarm(spark: SparkSession, sf_dir: str, rule: rn.Alarm) -> str:
    """Follow an alarm while the events arrive in three parts, each over the whole time.

    Most points of the later parts are late. The path of the windows.
    """
    root = shared_dir(spark, "stream-alarm")
    events = table(spark, sf_dir, "events")
    for part in range(DELIVERIES):
        events.filter(F.col("event_id") % DELIVERIES == part).write.mode("append").parquet(f"{root}/in")
        points = as_points(spark.readStream.schema(events.schema).parquet(f"{root}/in"))
        alarm_stream(points, rule, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


for _rule in rn.ALARMS:
    register(f"stream_alarm_{_rule.name}", alarm_sql(_rule), POINTS_SQL)(
        lambda s, d, r=_rule: stored_alarms(read_windows(s, delivered_alarm(s, d, r)), r)
    )

LATE_SQL = f"""
WITH parts AS (SELECT ts, event_id % {DELIVERIES} AS part FROM events WHERE event_type = 'error'),
newest AS (SELECT part, max(ts) AS newest FROM parts GROUP BY 1),
judged AS (
  SELECT p.ts, coalesce(p.ts < (SELECT max(n.newest) FROM newest n WHERE n.part < p.part) - INTERVAL 1 HOUR, FALSE) AS late
  FROM parts p)
SELECT '{rn.ALARMS[0].name}' AS alarm, make_timestamp(epoch_us(ts) // 300000000 * 300000000) AS window_start,
       make_timestamp((epoch_us(ts) // 300000000 + 1) * 300000000) AS window_end,
       COUNT(*) FILTER (WHERE late) AS late, COUNT(*) AS points
FROM judged GROUP BY ALL HAVING COUNT(*) FILTER (WHERE late) > 0"""
register("stream_alarm_late", LATE_SQL)(
    lambda s, d: late_points(read_windows(s, delivered_alarm(s, d, rn.ALARMS[0])))
)

# ---------------------------------------------------------------- snapshots

UPDATED_VALUE = "DEMO_UPDATED"


def evolved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New rows carrying a column the table does not have yet."""
    zones = customer_zones(spark, sf_dir).filter("location_id % 20 = 0")
    return zones.select(
        (-F.col("location_id")).alias("location_id"), F.lit("DEMO").alias("borough"), "zone",
        "service_zone", F.concat(F.lit("category "), F.col("borough")).alias("zone_category"),
    )


def demo_snapshots(spark: SparkSession, sf_dir: str, faulty: bool = False) -> list[DataFrame]:
    """The zones as created, with one updated, and with rows added that have a further column.

    In the faulty ones the update was lost and old rows got the new column too.
    """
    root = shared_dir(spark, "snapshots")
    first = vs.keep_snapshot(customer_zones(spark, sf_dir), f"{root}/created")
    hit = F.lit(False) if faulty else F.col("location_id") == 1
    second = vs.keep_snapshot(
        conditional_update(first, hit, {"service_zone": F.lit(UPDATED_VALUE)}), f"{root}/updated"
    )
    third = vs.appended(second, evolved_rows(spark, sf_dir))
    if faulty:
        third = conditional_update(third, F.col("location_id") % 2 == 0, {"zone_category": F.lit("category")})
    return [first, second, vs.keep_snapshot(third, f"{root}/extended")]


VERSIONS_SQL = CUSTOMER_ZONES_SQL + """,
v1 AS (SELECT location_id, borough, zone,
              CASE WHEN location_id = 1 THEN 'DEMO_UPDATED' ELSE service_zone END AS service_zone
       FROM customer_zones),
evolved AS (SELECT -location_id AS location_id, 'DEMO' AS borough, zone, service_zone, 'category ' || borough AS zone_category
       FROM customer_zones WHERE location_id % 20 = 0),
v2 AS (SELECT *, CAST(NULL AS VARCHAR) AS zone_category FROM v1 UNION ALL SELECT * FROM evolved),
faulty2 AS (SELECT * REPLACE (CASE WHEN location_id % 2 = 0 THEN 'category' ELSE zone_category END AS zone_category)
       FROM (SELECT *, CAST(NULL AS VARCHAR) AS zone_category FROM customer_zones UNION ALL SELECT * FROM evolved))"""
for _number, _label, _source in ((0, "v0", "customer_zones"), (1, "v1", "v1"), (2, "current", "v2")):
    register(f"version_read_{_label}", f"SELECT * FROM {_source}", VERSIONS_SQL)(
        lambda s, d, n=_number: demo_snapshots(s, d)[n]
    )


def demo_history(snapshots: list[DataFrame]) -> DataFrame:
    return vs.operations(list(zip(range(3), ("CREATE", "UPDATE", "APPEND"), snapshots)))


register(
    "version_history",
    """SELECT 0 AS version, 'CREATE' AS operation, COUNT(*) AS row_count FROM customer_zones
       UNION ALL SELECT 1, 'UPDATE', COUNT(*) FROM v1 UNION ALL SELECT 2, 'APPEND', COUNT(*) FROM v2""",
    VERSIONS_SQL,
)(lambda s, d: demo_history(demo_snapshots(s, d)))


@register(
    "version_snapshots",
    """SELECT 'v0' AS label, COUNT(*) AS row_count, 4 AS column_count, FALSE AS has_evolved_column,
              min(service_zone) FILTER (WHERE location_id = 1) AS probe_value,
              CAST(NULL AS BIGINT) AS null_in_evolved_column FROM customer_zones
       UNION ALL SELECT 'v1', COUNT(*), 4, FALSE,
              min(service_zone) FILTER (WHERE location_id = 1), NULL FROM v1
       UNION ALL SELECT 'current', COUNT(*), 5, TRUE,
              min(service_zone) FILTER (WHERE location_id = 1),
              COUNT(*) FILTER (WHERE zone_category IS NULL) FROM v2""",
    VERSIONS_SQL,
)
def version_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = demo_facts(demo_snapshots(spark, sf_dir))
    return facts[0].unionByName(facts[1]).unionByName(facts[2]).drop("columns")


def demo_facts(snapshots: list[DataFrame]) -> list[DataFrame]:
    return [
        vs.snapshot_facts(df, label, F.col("location_id") == 1, "service_zone", "zone_category")
        for df, label in zip(snapshots, ("v0", "v1", "current"))
    ]


def evolution_sql(first: str, second: str, current: str) -> str:
    probe = "(SELECT coalesce(min(service_zone), '') FROM {} WHERE location_id = 1)"
    size = "(SELECT COUNT(*) FROM {})"
    return f"""
    SELECT * FROM (VALUES ('history_has_three_versions', TRUE), ('v0_has_original_schema', TRUE),
      ('v1_has_original_schema', TRUE), ('current_has_evolved_schema', TRUE),
      ('v0_retains_original_value', {probe.format(first)} <> '{UPDATED_VALUE}'),
      ('v1_shows_updated_value', {probe.format(second)} = '{UPDATED_VALUE}'),
      ('row_count_grew_by_appended_rows', {size.format(current)} = {size.format(first)} + {size.format("evolved")}),
      ('pre_evolution_rows_null_in_new_column',
       {size.format(current + " WHERE zone_category IS NULL")} = {size.format(first)})) v(check_name, passed)"""


def evolution(spark: SparkSession, sf_dir: str, faulty: bool) -> DataFrame:
    snapshots = demo_snapshots(spark, sf_dir, faulty)
    added = evolved_rows(spark, sf_dir).agg(F.count(F.lit(1)))
    return vs.evolution_checks(*demo_facts(snapshots), demo_history(snapshots), UPDATED_VALUE, added)


register("schema_evolution", evolution_sql("customer_zones", "v1", "v2"), VERSIONS_SQL)(
    lambda s, d: evolution(s, d, False)
)
register("schema_evolution_faulty", evolution_sql("customer_zones", "customer_zones", "faulty2"), VERSIONS_SQL)(
    lambda s, d: evolution(s, d, True)
)


@register(
    "version_diff",
    """SELECT location_id, 'changed' AS change, 'service_zone' AS changed_columns
       FROM v1 WHERE location_id = 1
       UNION ALL SELECT location_id, 'added', NULL FROM v2 WHERE location_id < 0""",
    VERSIONS_SQL,
)
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    first, _, current = demo_snapshots(spark, sf_dir)
    return vs.version_diff(first, current, ["location_id"])


# ---------------------------------------------------------------- layout and transfer


@register("sorted_layout", "SELECT event_id, ts, user_id FROM events")
def sorted_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written in time order and read back."""
    path = shared_dir(spark, "sorted")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    sorted_by_time(events, "ts").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@register(
    "partitioned_layout",
    "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error'",
)
def partitioned_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written by type and one type read back; the other folders are not opened."""
    path = shared_dir(spark, "partitioned")
    write_partitioned(
        table(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), path, ["event_type"]
    )
    return spark.read.parquet(path).filter("event_type = 'error'")


@register(
    "transfer_counts",
    """SELECT 'events' AS table_name, COUNT(*) AS left_value, COUNT(*) AS right_value,
              'PASS' AS verdict FROM events
       UNION ALL SELECT 'orders', COUNT(*), COUNT(*) FILTER (WHERE o_orderkey % 2 = 0), 'FAIL'
       FROM orders""",
)
def transfer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of two tables against a transfer that lost half of one of them."""
    events, orders = table(spark, sf_dir, "events"), table(spark, sf_dir, "orders")
    return compare_manifests(
        row_count_manifest({"events": events, "orders": orders}),
        row_count_manifest({"events": events, "orders": orders.filter("o_orderkey % 2 = 0")}),
    )
