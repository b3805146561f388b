"""Readers, specs, ingestion, writers, the warehouse load and versioned tables."""

import datetime as dt
import glob
import json
import os
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fareloom.operators import runs as rn
from fareloom.operators.merge import conditional_update
from fareloom.operators.star import build_star
from fareloom.operators.clean import silver
from fareloom.session import broadcast_if_small, shared_dir
from fareloom.sinks import loads as ld, versions as vs, writers as wr
from fareloom.sinks.ingest import ingest
from fareloom.sources import readers as rd
from fareloom.sources.catalog import register_table, register_views
from fareloom.sources.spec import SourceSpec, landing_path, load_spec_file, load_specs


def write(path, text):
    path.write_text(text)
    return str(path)


def test_two_row_files(spark, tmp_path):
    csv = write(tmp_path / "people.csv", "id,name\n1,Alice\n2,Bob\n")
    df = rd.fetch(spark, SourceSpec("people", "csv", csv))
    assert df.columns == ["id", "name"] and df.count() == 2 and df.orderBy("id").first().name == "Alice"
    df.write.parquet(str(tmp_path / "people"))
    back = rd.fetch(spark, SourceSpec("people", "parquet", str(tmp_path / "people")))
    assert sorted(tuple(r) for r in back.collect()) == [(1, "Alice"), (2, "Bob")]


def test_csv_na_reads_as_null(spark, tmp_path):
    csv = write(tmp_path / "z.csv", "id,service_zone\n1,N/A\n")
    assert rd.fetch(spark, SourceSpec("z", "csv", csv)).first().service_zone is None


@pytest.mark.parametrize("text", [
    "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,Air\n",
    "LocationID,Zone,Borough,service_zone\n1,Newark,EWR,Air\n",
    "location_id,borough,zone,service_zone\n1,EWR,Newark,Air\n",
])
def test_zone_csv_goes_by_heading(spark, tmp_path, text):
    zones = rd.read_zone_csv(spark, write(tmp_path / "z.csv", text))
    assert zones.columns == ["LocationID", "Borough", "Zone", "service_zone"]
    assert tuple(zones.first()) == (1, "EWR", "Newark", "Air")


def test_zone_csv_without_a_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "z.csv", "LocationID,Borough,service_zone\n1,EWR,Air\n")
    with pytest.raises(ValueError, match="Zone"):
        rd.read_zone_csv(spark, path)


def test_zone_seed_takes_either_heading(spark, tmp_path):
    for name, head in (("a", "LocationID,Borough,Zone,service_zone"), ("b", "location_id,borough,zone,service_zone")):
        path = write(tmp_path / f"{name}.csv", f"{head}\n2,Q,J,B\n1,EWR,N,E\n")
        assert [r.location_id for r in rd.read_zone_seed(spark, path).collect()] == [1, 2]
    other = write(tmp_path / "c.csv", "id,borough,zone,service_zone\n1,a,b,c\n")
    with pytest.raises(ValueError, match="LocationID"):
        rd.read_zone_seed(spark, other)


def test_empty_inferred_csv_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="no rows"):
        rd.read_csv_inferred(spark, write(tmp_path / "e.csv", "a,b\n"))


def test_trips_merge_columns_over_files(spark, tmp_path):
    root = str(tmp_path / "t")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{root}/x=1")
    spark.createDataFrame([(2, "n")], "a int, b string").write.parquet(f"{root}/x=2")
    assert {(r.a, r.b) for r in rd.read_trips(spark, root).collect()} == {(1, None), (2, "n")}


def test_specs(tmp_path):
    config = {"sources": {
        "taxi_zones": {"type": "csv", "source": "z.csv", "primary_key": "location_id",
                       "column_mapping": {"LocationID": "location_id"}},
        "yellow": {"type": "parquet", "source": "t", "destination_path": "bronze/transactions/yellow/"}}}
    specs = load_specs(config)
    assert landing_path(specs["taxi_zones"]) == "bronze/reference/taxi_zones/taxi_zones"
    assert landing_path(specs["yellow"]) == "bronze/transactions/yellow/yellow"
    path = write(tmp_path / "s.json", json.dumps(config))
    assert load_spec_file(path) == specs
    with pytest.raises(ValueError, match="unknown kind"):
        load_specs({"sources": {"x": {"type": "xml", "source": "a"}}})


def test_ingest_reports_each_source(spark, tmp_path):
    zones = write(tmp_path / "zones.csv", "LocationID,Borough,Zone\n1, EWR ,Newark\n1, EWR ,Newark\n2,N/A,Soho\n")
    double = write(tmp_path / "double.csv", "LocationID,Borough\n1,a\n1,b\n")
    empty = write(tmp_path / "empty.csv", "LocationID,Borough\n")
    spark.range(3).write.parquet(str(tmp_path / "trips"))
    renames = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    clean = write(tmp_path / "clean.csv", "LocationID,Borough,Zone\n1, EWR ,Newark\n2,N/A,Soho\n")
    specs = [
        SourceSpec("zones", "csv", clean, ("LocationID",), "location_id", renames, "taxi_zones"),
        SourceSpec("copies", "csv", zones, ("LocationID",), "location_id", renames, "taxi_zones"),
        SourceSpec("double", "csv", double, (), "location_id", renames, "taxi_zones"),
        SourceSpec("short", "csv", double, ("Zone",), None, renames),
        SourceSpec("empty", "csv", empty),
        SourceSpec("gone", "csv", str(tmp_path / "no.csv")),
        SourceSpec("trips", "parquet", str(tmp_path / "trips"), ("id",)),
    ]
    published = {}
    target = spark.createDataFrame([(2, "old", "old"), (9, "k", "k")], "location_id int, borough string, zone string")
    status = ingest(spark, specs, str(tmp_path / "lake"), {"taxi_zones": target},
                    lambda name, df: published.update({name: df.collect()}))
    assert {r.source: r.status for r in status.collect()} == {
        "zones": "LOADED", "copies": "INVALID", "double": "INVALID", "short": "INVALID",
        "empty": "SKIPPED", "gone": "FAILED", "trips": "LANDED"}
    assert sorted(tuple(r) for r in published["taxi_zones"]) == [
        (1, "EWR", "Newark"), (2, "Unknown", "Soho"), (9, "k", "k")]
    assert spark.read.parquet(str(tmp_path / "lake/bronze/transactions/trips/trips")).count() == 3


def test_logs_and_records(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    write(logs / "jr_1-driver.log", 'start\nFinal job summary: none here\n'
          'x Final job summary: {"execution_summary":{"inserted":1,"updated":2,"no_change":3,"errors":9}}\n'
          'Final job summary: {"execution_summary":{"inserted":50}}\n')
    write(logs / "jr_2-driver.log", 'Final job summary: {"execution_summary":{"error":"boom"}}\n')
    write(logs / "jr_3-driver.log", 'Final job summary: {bad\n')
    found = {r.run_id: r.records_processed for r in rn.records_processed(rd.read_run_logs(spark, str(logs))).collect()}
    assert found == {"jr_1": 6, "jr_2": 0}
    records = write(tmp_path / "runs.json", "\n".join(json.dumps(r) for r in [
        {"run_id": "jr_1", "job_name": "a", "status": "SUCCEEDED", "started_at": "2025-01-01T00:00:00Z",
         "completed_at": "2025-01-01T00:02:00Z", "execution_seconds": 120},
        {"run_id": "jr_9", "job_name": "a", "status": "RUNNING", "started_at": "2025-01-01T00:00:00Z"}]))
    runs = rd.read_run_records(spark, records)
    collected = rn.collect_runs(runs, rd.read_run_logs(spark, str(logs))).collect()
    assert [(r.run_id, r.records_processed) for r in collected] == [("jr_1", 6)]
    views = {r.run_id: r.execution_time_seconds
             for r in rn.run_view(runs.withColumn("records_processed", F.lit(None).cast("long"))).collect()}
    assert views == {"jr_1": 120.0, "jr_9": None}
    stats = rn.runs_summary(runs).first()
    assert (stats.runs, stats.succeeded, stats.avg_seconds, stats.max_seconds) == (2, 1, 120, 120)


def test_run_without_success_has_zero_seconds(spark):
    runs = spark.createDataFrame([("a", "FAILED", 7)], "job_name string, status string, execution_seconds long")
    assert tuple(rn.runs_summary(runs).first()) == ("a", 1, 0, 0, 0)


def small_star(spark):
    trips = spark.createDataFrame(
        [(1, dt.datetime(2025, 1, d, 9), dt.datetime(2025, 1, d, 10), 1, 2, 1.0, 5.0 + d, 1, 1, 0.5, 6.0)
         for d in (1, 3, 3)],
        "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
        "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, "
        "passenger_count int, payment_type int, tip_amount double, total_amount double")
    zones = spark.createDataFrame(
        [(1, "A", "x", "s", 10, 1), (2, "B", "y", "s", 11, 1)],
        "location_id int, borough string, zone string, service_zone string, golden_zone_row_id long, version int")
    return silver(trips), build_star(silver(trips), zones)


def test_silver_gold_star_and_warehouse(spark, tmp_path):
    cleaned, star = small_star(spark)
    wr.write_silver(cleaned, str(tmp_path / "silver"))
    assert os.path.isdir(tmp_path / "silver/pickup_year=2025/pickup_month=1")
    assert wr.publish_gold(cleaned, str(tmp_path / "gold")) == [
        "daily_summary", "vendor_summary", "borough_summary", "payment_summary", "hourly_summary"]
    daily = spark.read.parquet(str(tmp_path / "gold/daily_summary")).orderBy("trip_date").collect()
    assert [(str(r.trip_date), r.total_trips, r.total_revenue) for r in daily] == [
        ("2025-01-01", 1, 6.0), ("2025-01-03", 1, 8.0)]
    with pytest.raises(ValueError, match="dim_zone"):
        wr.publish_star(star, str(tmp_path / "no"), {"dim_zone": 265})
    assert not (tmp_path / "no").exists()
    paths = wr.publish_star(star, str(tmp_path / "star"), {"dim_zone": 2, "dim_payment": 7}, fact_files=2)
    assert len(glob.glob(f"{paths['dim_zone']}/*.parquet")) == 1
    view = register_views({"dim_zone": spark.read.parquet(paths["dim_zone"])}, "gold_")[0]
    assert spark.sql(f"SELECT count(*) FROM {view}").first()[0] == 2


def test_warehouse_load_and_catalog(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS wh LOCATION '{tmp_path}/wh'")
    cleaned, star = small_star(spark)
    paths = wr.publish_star(star, str(tmp_path / "star"), {})
    assert ld.current_load(spark, "wh") is None
    for _ in range(2):
        counts = {r.table_name: r.row_count for r in ld.load_warehouse(spark, paths, "wh").collect()}
        assert counts == {"dim_date": 3, "dim_payment": 7, "dim_zone": 2, "fact_trips": 2}
    load = ld.current_load(spark, "wh")
    stats = spark.sql(f"DESCRIBE EXTENDED {load.table_name('fact_trips')}").filter("col_name = 'Statistics'").first()
    assert "2 rows" in stats.data_type
    with pytest.raises(ValueError, match="no table dim_vendor"):
        load.table_name("dim_vendor")
    wr.write_silver(cleaned, str(tmp_path / "silver"))
    name = register_table(spark, "wh", "silver", str(tmp_path / "silver"))
    assert spark.sql(f"SELECT count(*) FROM {name} WHERE pickup_year = 2025").first()[0] == 2
    # The first load's tables go; those of the current one and others in the database stay.
    assert ld.drop_other_loads(spark, "wh") == ["dim_date", "dim_payment", "dim_zone", "fact_trips"]
    assert load.read(spark, "fact_trips").count() == 2 and spark.sql(f"SELECT count(*) FROM {name}").first()[0] == 2
    load.attach(spark)
    assert spark.sql("SELECT count(*) FROM fact_trips JOIN dim_zone ON location_id = pickup_location_id").first()[0] == 2
    spark.sql("DROP DATABASE wh CASCADE")


def test_a_failing_load_is_never_seen(spark, tmp_path):
    spark.sql(f"CREATE DATABASE half LOCATION '{tmp_path}/half'")
    for side in ("old", "new"):
        for name in ("a", "b"):
            spark.createDataFrame([(f"{side} {name}",)], "v string").write.parquet(f"{tmp_path}/{side}/{name}")
    paths = lambda side: {name: f"{tmp_path}/{side}/{name}" for name in ("a", "b")}
    ld.load_warehouse(spark, paths("old"), "half")
    before = ld.current_load(spark, "half")
    with pytest.raises(PySparkException):
        ld.load_warehouse(spark, paths("new") | {"b": f"{tmp_path}/new/absent"}, "half")
    assert ld.current_load(spark, "half") == before
    staged = ld.stage_load(spark, paths("new"), "half")
    reader = ld.current_load(spark, "half").frames(spark)
    ld.publish_load(spark, staged)
    # A reader that opened the old load still has both of its tables; the next one has both new ones.
    assert [reader[n].first().v for n in ("a", "b")] == ["old a", "old b"]
    now = ld.current_load(spark, "half").frames(spark)
    assert [now[n].first().v for n in ("a", "b")] == ["new a", "new b"]
    assert ld.drop_other_loads(spark, "half", keep=(before,)) == ["a"]  # what the failed load left
    spark.sql("DROP DATABASE half CASCADE")


def test_snapshot_files_follow_the_bytes(spark, tmp_path):
    rows = spark.range(200_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    for target, least, most in ((1 << 20, 10, 40), (1 << 30, 1, 1)):
        path = str(tmp_path / str(target))
        wr.write_snapshot(rows, path, target_bytes=target)
        sizes = [os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet")]
        assert least <= len(sizes) <= most and max(sizes) < 2 * target
        assert spark.read.parquet(path).agg(F.sum("id")).first()[0] == sum(range(200_000))


def test_order_proof_finds_planted_rows(spark, tmp_path):
    rows = spark.range(5000).select(F.timestamp_seconds(F.col("id") * 17 % 5000).alias("ts"), "id")

    def found(df, name):
        df.write.parquet(f"{tmp_path}/{name}")
        stored = spark.read.parquet(f"{tmp_path}/{name}")
        return {r.rule: r.violations for r in wr.order_violations(stored, "ts").collect()}

    ordered = wr.sorted_by_time(rows, "ts", 4)
    assert found(ordered, "ordered") == {"inside_files": 0, "between_files": 0}
    # One row moved to the start of the first file's order, as an appended file of its own.
    spark.createDataFrame([(dt.datetime(1970, 1, 1, 0, 30), 1)], "ts timestamp, id long").write.mode("append").parquet(f"{tmp_path}/ordered")
    stored = spark.read.parquet(f"{tmp_path}/ordered")
    assert {r.rule: r.violations for r in wr.order_violations(stored, "ts").collect()} == {"inside_files": 0, "between_files": 1}
    backwards = rows.repartitionByRange(3, "ts").sortWithinPartitions(F.desc("ts"))
    bad = found(backwards, "backwards")
    assert bad["inside_files"] > 4000 and bad["between_files"] == 0
    nulls = rows.withColumn("ts", F.lit(None).cast("timestamp"))
    assert found(nulls, "nulls") == {"inside_files": 0, "between_files": 0}


def test_files_of_different_types_are_widened(spark, tmp_path):
    root = str(tmp_path / "t")
    shapes = [
        ("a int, b float, c date, d decimal(5,2), e int", (1, 0.5, dt.date(2025, 1, 1), Decimal("1.25"), 7)),
        ("a long, b double, c timestamp_ntz, d decimal(9,4), e string", (1 << 40, 0.1, dt.datetime(2025, 1, 2, 3), Decimal("2.5001"), "x")),
        ("a int, b int, d int", (3, 4, 5)),
        ("a long, f string", (4, "only here")),
    ]
    for part, (schema, row) in enumerate(shapes):
        spark.createDataFrame([row], schema).write.parquet(f"{root}/part={part}")
    got = rd.read_trips(spark, root)
    kinds = dict(got.dtypes)
    assert kinds == {"a": "bigint", "b": "double", "c": "timestamp_ntz", "d": "decimal(14,4)", "e": "string", "f": "string", "part": "int"}
    rows = {r.part: r for r in got.collect()}
    assert [rows[p].a for p in range(4)] == [1, 1 << 40, 3, 4]
    assert [rows[p].b for p in range(4)] == [0.5, 0.1, 4.0, None]
    assert rows[0].c == dt.datetime(2025, 1, 1) and rows[1].c == dt.datetime(2025, 1, 2, 3) and rows[2].c is None
    assert [rows[p].d for p in range(4)] == [Decimal("1.2500"), Decimal("2.5001"), Decimal("5.0000"), None]
    assert [rows[p].e for p in range(4)] == ["7", "x", None, None] and rows[3].f == "only here"


def test_run_summary_row(spark, tmp_path):
    summary = wr.RunSummary("zones", "SUCCEEDED", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 0, 1), 3, 2, 1)
    wr.append_run_summary(spark, summary, str(tmp_path / "log"))
    row = spark.read.json(str(tmp_path / "log")).first()
    assert row.duration_seconds == 60.0 and row.execution_summary.inserted == 3


def test_hot_timestamp_is_spread(spark):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, F.lit("2025-01-01")).otherwise(
            F.concat(F.lit("2025-02-"), F.lpad((F.col("id") % 28 + 1).cast("string"), 2, "0")))
        .cast("timestamp_ntz").alias("ts"), "id")
    sizes = (wr.sorted_by_time(rows, "ts", 8).groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert max(r["count"] for r in sizes) < 20000 / 4


def zone_rows(spark, n=20):
    return spark.range(1, n + 1).select(
        F.col("id").cast("int").alias("location_id"), F.lit("B").alias("borough"), F.lit("S").alias("service_zone"))


def test_snapshots_and_their_difference(spark, tmp_path):
    first = vs.keep_snapshot(zone_rows(spark), f"{tmp_path}/a")
    with pytest.raises(PySparkException, match="ALREADY_EXISTS"):
        vs.keep_snapshot(zone_rows(spark), f"{tmp_path}/a")
    extra = spark.createDataFrame([(900, "DEMO", "Demo", "airport")],
                                  "location_id int, borough string, service_zone string, zone_category string")
    second = vs.keep_snapshot(
        vs.appended(conditional_update(first, F.col("location_id") == 1, {"service_zone": F.lit("NEW")}), extra), f"{tmp_path}/b")
    assert [tuple(r) for r in vs.operations([(0, "CREATE", first), (1, "APPEND", second)]).collect()] == [
        (0, "CREATE", 20), (1, "APPEND", 21)]
    now = {r.location_id: r for r in second.collect()}
    assert now[1].service_zone == "NEW" and now[2].zone_category is None and now[900].zone_category == "airport"
    diff = {r.location_id: (r.change, r.changed_columns)
            for r in vs.version_diff(first, second, ["location_id"]).collect()}
    assert diff == {1: ("changed", "service_zone"), 900: ("added", None)}
    back = vs.version_diff(second, first, ["location_id"]).filter("location_id = 900").first()
    assert back.change == "removed"


def test_evidence_document(spark, tmp_path):
    facts = vs.snapshot_facts(zone_rows(spark), "v0", F.col("location_id") == 1, "service_zone", "zone_category")
    checks = spark.createDataFrame([("x", True), ("y", False)], "check_name string, passed boolean")
    vs.evidence(vs.operations([(0, "CREATE", zone_rows(spark))]), [facts], checks, str(tmp_path / "e"))
    assert spark.read.json(str(tmp_path / "e/verdict")).first().all_passed is False


def test_shared_dir_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    try:
        spark.conf.set("spark.checkpoint.dir", str(tmp_path))
        assert shared_dir(spark, "x").startswith(f"{tmp_path}/x-")
    except PySparkException:
        assert before is not None and shared_dir(spark, "x").startswith(before)
    finally:
        if before is not None:
            try:
                spark.conf.set("spark.checkpoint.dir", before)
            except PySparkException:
                pass


def test_broadcast_only_when_small(spark):
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan(broadcast_if_small(spark.range(5), 5)).lower()
    assert "broadcast" not in plan(broadcast_if_small(spark.range(6), 5)).lower()
