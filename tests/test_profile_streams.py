"""Quantiles and profile against pandas; streams against batch."""

import datetime as dt
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.functions.numeric import exact_avg, weighted_sum
from fareloom.operators import profile as pf, runs as rn
from fareloom.operators.quantiles import exact_quantiles, melt, value_counts
from fareloom.streaming import runs as srn
from fareloom.streaming.alarms import alarm_stream, alarms, late_points, partial_windows, read_windows, stored_alarms


def shapes():
    rng = random.Random(3)
    return {
        "few": [1.0],
        "two": [1.0, 2.0],
        "ties": [5.0] * 400 + [6.0],
        "hot": [0.0] * 700 + [rng.gauss(0, 1) for _ in range(300)],
        "outlier": [rng.random() for _ in range(999)] + [1e15],
        "negative": [-rng.expovariate(1) * 1e3 for _ in range(500)],
        "tiny": [1 + i * 1e-12 for i in range(300)],
        "mixed": [rng.choice([-1e9, 0.0, 1e-9, 3.5, 1e9]) for _ in range(777)],
    }


@pytest.mark.parametrize("name", sorted(shapes()))
def test_quantiles_like_numpy(spark, name):
    values = shapes()[name]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double").repartition(5)
    probabilities = [0.0, 0.25, 0.5, 0.95, 0.99, 1.0]
    rows = exact_quantiles(value_counts(melt(df, ["v"])), probabilities).collect()
    got = {r.probability: r.value for r in rows}
    want = np.quantile(values, probabilities)
    assert [got[p] for p in probabilities] == pytest.approx(list(want), rel=1e-15, abs=1e-15)


def selected(spark, values, probabilities, bound):
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    rows = exact_quantiles(value_counts(melt(df, ["v"])), probabilities, task_values=bound).collect()
    return {r.probability: r.value for r in rows}


@pytest.mark.parametrize("bound", [40, 150])
def test_quantiles_in_rounds_of_bounded_tasks(spark, monkeypatch, bound):
    """Two scales and very large outliers: many rounds, and no task orders more than the bound."""
    from fareloom.operators import quantiles as qt

    rng = random.Random(8)
    values = [rng.random() * 1e-9 for _ in range(1500)] + [1e12 + rng.random() * 1e12 for _ in range(500)] + [-1e300, 1e308]
    sizes, real = [], qt._picked

    def picked(part, targets):
        sizes.extend(r["_rows"] for r in targets.collect())
        return real(part, targets)

    monkeypatch.setattr(qt, "_picked", picked)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 0.999, 1.0]
    got = selected(spark, values, probabilities, bound)
    assert [got[p] for p in probabilities] == pytest.approx(list(np.quantile(values, probabilities)), rel=1e-12)
    assert max(sizes) <= bound and len(sizes) >= 2 * len(probabilities) - 2


def test_quantiles_of_several_measures_in_rounds(spark):
    rng = random.Random(4)
    rows = [(rng.gauss(0, 1), float(rng.randint(0, 5)), 1e6 * rng.random()) for _ in range(900)]
    counts = value_counts(melt(spark.createDataFrame(rows, "a double, b double, c double"), ["a", "b", "c"]))
    got = {(r.measure, r.probability): r.value for r in exact_quantiles(counts, [0.1, 0.5, 0.99], task_values=50).collect()}
    for place, column in enumerate(zip(*rows)):
        for p in (0.1, 0.5, 0.99):
            assert got[place, p] == pytest.approx(np.quantile(column, p), rel=1e-12)


@pytest.mark.parametrize("bound", [5, 1000])
def test_quantiles_with_infinities(spark, bound):
    inf = float("inf")
    values = [-inf] * 3 + [float(i) for i in range(94)] + [inf] * 4
    got = selected(spark, values, [0.0, 0.5, 0.965, 1.0], bound)
    assert (got[0.0], got[0.5], got[0.965], got[1.0]) == (-inf, 47.0, inf, inf)
    assert selected(spark, [-inf, inf], [0.0, 1.0], bound) == {0.0: -inf, 1.0: inf}
    assert np.isnan(selected(spark, [-inf, inf], [0.5], bound)[0.5])
    assert selected(spark, [], [0.5], bound) == {}


def test_describe_like_pandas(spark):
    rng = random.Random(6)
    rows = [(rng.randint(0, 50), rng.gauss(5, 2), rng.choice(["x", "y", "z", None]), rng.choice([True, False]),
             dt.datetime(2025, 1, rng.randint(1, 28))) for _ in range(300)]
    rows += [(None, float("nan"), "y", None, None)]
    df = spark.createDataFrame(rows, "n int, v double, t string, f boolean, at timestamp_ntz")
    got = {r.column_name: r for r in pf.describe(df).collect()}
    pdf = df.toPandas()
    for name in ("n", "v"):
        want = pdf[name].describe()
        r = got[name]
        found = (r["count"], r["mean"], r["std"], r["minimum"], r["q25"], r["median"], r["q75"], r["maximum"])
        assert found == pytest.approx(tuple(want), rel=1e-12) and r["top"] is None
    want = pdf["t"].describe()
    r = got["t"]
    assert (r["count"], r["unique"], r["top"], r["freq"]) == (want["count"], want["unique"], want["top"], want["freq"])
    assert got["f"]["unique"] == 2 and got["f"]["count"] == 300
    stamps = pdf["at"].dropna()
    assert got["at"]["median"] == pytest.approx(stamps.median().timestamp()) and got["at"]["count"] == 300
    empty = {r.column_name: r for r in pf.describe(df.limit(0)).collect()}
    assert {n: r["count"] for n, r in empty.items()} == dict.fromkeys(got, 0)
    assert empty["t"]["top"] is None and empty["n"]["mean"] is None


def test_describe_adds_up_counted_values(spark, tmp_path):
    """Once the values are counted, the rows are not read again."""
    path = str(tmp_path / "rows")
    spark.range(1000).select((F.col("id") % 7).alias("n"), (F.col("id") / 8).alias("v")).write.parquet(path)
    described = pf.describe(spark.read.parquet(path))
    assert not [f for f in described.inputFiles() if path in f]
    got = {r.column_name: r for r in described.collect()}
    assert got["n"]["count"] == 1000 and got["v"]["mean"] == 999 / 16


def test_describe_odd_columns(spark):
    inf = float("inf")
    rows = [(1.5, inf, None, 2.0**60, 0.1), (None, 1.0, float("nan"), 1.0, 0.2), (None, 2.0, None, 1.0, 0.3)]
    df = spark.createDataFrame(rows, "one double, endless double, none double, large double, tenth double")
    got = {r.column_name: r for r in pf.describe(df).collect()}
    assert (got["one"]["count"], got["one"]["mean"], got["one"]["std"]) == (1, 1.5, None)
    assert got["endless"]["mean"] == inf and np.isnan(got["endless"]["std"])
    assert (got["none"]["count"], got["none"]["mean"], got["none"]["median"]) == (0, None, None)
    assert got["large"]["mean"] == pytest.approx((2.0**60 + 2) / 3) and got["large"]["median"] == 1.0
    assert got["tenth"]["mean"] == df.agg(exact_avg("tenth")).first()[0]


def test_weighted_sums_like_sums(spark):
    values = [(0.1, 3), (9999999.875, 10**11), (-0.25, 7), (1e300, 2), (None, 4)]
    counted = spark.createDataFrame(values, "v double, n long")
    got = counted.filter("v < 1e7").agg(weighted_sum("v", "n")).first()[0]
    assert got == float(Decimal("0.1") * 3 + Decimal("9999999.875") * 10**11 - Decimal("0.25") * 7)
    assert counted.agg(weighted_sum("v", "n")).first()[0] == 2e300


def test_schema_rows(spark):
    df = spark.createDataFrame([(1, "ab", None), (None, "é", 2.0)], "a int, b string, c double")
    assert [tuple(r) for r in pf.schema_rows(df).orderBy("position").collect()] == [
        (0, "a", "int", 1, 4), (1, "b", "string", 2, 4), (2, "c", "double", 1, 8)]


def test_distinct_lists_order_numbers_and_text(spark):
    df = spark.range(2000).select(
        (F.col("id") % 120 - 10).alias("n"), F.concat(F.lit("k"), F.col("id") % 30).alias("t"), F.lit(None).cast("int").alias("none"))
    got = {r.column_name: r for r in pf.distinct_values(df, ["n", "t", "none"], 5).collect()}
    assert (got["n"].first_values, got["n"].distinct_count) == ("-10,-9,-8,-7,-6", 120)
    assert (got["t"].first_values, got["t"].distinct_count) == ("k0,k1,k10,k11,k12", 30)
    assert (got["none"].first_values, got["none"].distinct_count) == ("", 0)
    plan = pf.distinct_values(df, ["n", "t"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_missing_values_only_where_missing(spark):
    df = spark.createDataFrame([(1, None), (2, None), (None, "x")], "a int, b string").withColumn("c", F.lit(1))
    assert [tuple(r) for r in pf.missing_values(df).collect()] == [("b", 2, 66.67), ("a", 1, 33.33)]


def test_distinct_lists_the_first_twenty(spark):
    df = spark.range(100).select((F.col("id") % 30).cast("int").alias("c"))
    row = pf.distinct_values(df, ["c"]).first()
    assert row.distinct_count == 30 and row.first_values == ",".join(str(i) for i in range(20))


def test_histogram_counts_every_value_once(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "v double")
    rows = pf.histogram(df, ["v"], 10).collect()
    assert sum(r.rows for r in rows) == 101 and len(rows) == 10
    assert {r.bin: r.rows for r in rows}[9] == 11
    flat = pf.histogram(spark.createDataFrame([(2.0,)] * 4, "v double"), ["v"], 10).collect()
    assert [(r.bin, r.rows) for r in flat] == [(0, 4)]


POINT = "ts timestamp, metric string, value double"
RULE = rn.ALARMS[0]


def at(minute, second=0):
    return dt.datetime(2025, 1, 1, 0, 0) + dt.timedelta(minutes=minute, seconds=second)


def test_alarm_thresholds(spark):
    failed, _, slow, cost = rn.ALARMS
    points = spark.createDataFrame(
        [(at(1), "failed", 1.0), (at(6), "failed", 0.5), (at(6, 30), "failed", 0.4),
         (at(1), "duration_ms", 2_700_000.0), (at(7), "duration_ms", 2_700_001.0),
         (at(1), "compute_seconds", 43_200.0), (at(60 * 25), "compute_seconds", 43_200.5)], POINT)
    fired = sorted((r.alarm, r.window_start) for r in alarms(points).collect())
    assert fired == [(cost.name, at(60 * 24)), (slow.name, at(5)), (failed.name, at(0))]


def stream_of(spark, folder, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))


def add_file(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def test_alarm_stream_over_several_batches(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    parts = [[(at(1), "failed", 0.6)], [(at(2), "failed", 0.6), (at(11), "failed", 0.2)], [(at(12), "failed", 0.9)]]
    for rows in parts:
        add_file(spark, source, rows, POINT)
    alarm_stream(stream_of(spark, source, POINT), RULE, out, str(tmp_path / "cp")).awaitTermination()
    windows = read_windows(spark, out)
    assert windows.filter("batch >= 0").select("batch").distinct().count() == 3
    streamed = sorted(tuple(r) for r in stored_alarms(windows, RULE).collect())
    batch = spark.createDataFrame([r for p in parts for r in p], POINT)
    assert streamed == sorted(tuple(r) for r in alarms(batch, [RULE]).collect()) and len(streamed) == 2


def test_late_points_enter_their_window_and_are_reported(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    add_file(spark, source, [(at(0), "failed", 1.0), (None, "failed", 5.0), (at(0), "other", 7.0)], POINT)
    query = lambda: alarm_stream(
        stream_of(spark, source, POINT), RULE, out, str(tmp_path / "cp"), "10 minutes").awaitTermination()
    query()
    add_file(spark, source, [(at(300), "failed", 1.0), (at(299), "failed", 1.0)], POINT)
    query()
    add_file(spark, source, [(at(1), "failed", 1.0), (at(290), "failed", 0.5), (at(289, 59), "failed", 0.5)], POINT)
    query()
    query()  # nothing new
    windows = read_windows(spark, out)
    first = stored_alarms(windows, RULE).filter(F.col("window_start") == F.lit(at(0)).cast("timestamp_ntz"))
    assert first.first().value == 2.0
    late = sorted((r.window_start, r.late, r.points) for r in late_points(windows).collect())
    assert late == [(at(0), 1, 2), (at(285), 1, 1)]


def test_a_retried_batch_replaces_its_windows(spark):
    """Partial windows of parts add up to those of the whole, whatever the parts."""
    rows = [(at(i % 17), "failed", 0.1 * i) for i in range(100)] + [(at(3), "failed", float("inf")), (at(4), "failed", 1e-30)]
    whole = alarms(spark.createDataFrame(rows, POINT), [RULE])
    for parts in (1, 3, 8):
        windows = None
        for part in range(parts):
            one = partial_windows(spark.createDataFrame(rows[part::parts], POINT), RULE, None, "1 hour").withColumn("batch", F.lit(part))
            windows = one if windows is None else windows.unionAll(one)
        assert sorted(stored_alarms(windows, RULE).collect()) == sorted(whole.collect())


RUN = "run_id string, job_name string, status string, started_at timestamp_ntz, completed_at timestamp_ntz"


def test_sync_stream_is_idempotent_and_picks_up_late_finishers(spark, tmp_path):
    source, out, cp = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    add_file(spark, source, [("a", "j", "SUCCEEDED", at(0), at(1)), ("b", "j", "RUNNING", at(0), None)], RUN)
    run = lambda checkpoint: srn.sync_stream(
        stream_of(spark, source, RUN), out, checkpoint, RUN).awaitTermination()
    run(cp)
    assert {r.run_id for r in srn.read_history(spark, out, RUN).collect()} == {"a"}
    add_file(spark, source, [("a", "j", "SUCCEEDED", at(0), at(1)), ("b", "j", "FAILED", at(0), at(9))], RUN)
    run(cp)
    run(str(tmp_path / "cp2"))
    rows = sorted((r.run_id, r.status) for r in srn.read_history(spark, out, RUN).collect())
    assert rows == [("a", "SUCCEEDED"), ("b", "FAILED")]


def test_sync_stream_keeps_the_first_delivery_of_a_batch(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    rows = [("a", "j", "SUCCEEDED", at(0), at(1), 2), ("a", "j", "FAILED", at(0), at(1), 1), ("b", "j", "ERROR", at(0), at(1), 3)]
    add_file(spark, source, rows, RUN + ", n int")
    srn.sync_stream(stream_of(spark, source, RUN + ", n int"), out, str(tmp_path / "cp"), RUN, "n").awaitTermination()
    assert sorted((r.run_id, r.status) for r in srn.read_history(spark, out, RUN).collect()) == [("a", "FAILED"), ("b", "ERROR")]


def test_sync_stream_reads_only_the_buckets_it_needs(spark, tmp_path):
    """A history file of another bucket that cannot be read does not stop the sync."""
    source, out, cp = tmp_path / "in", tmp_path / "out", str(tmp_path / "cp")
    add_file(spark, source, [("a", "j", "FAILED", at(0), at(1))], RUN)
    run = lambda: srn.sync_stream(stream_of(spark, source, RUN), str(out), cp, RUN).awaitTermination()
    run()
    mine = srn.read_history(spark, str(out), RUN).filter("run_id = 'a'").first().bucket
    other = out / "origin=x" / "batch=0" / f"bucket={(mine + 1) % srn.BUCKETS}"
    other.mkdir(parents=True)
    (other / "part-0.parquet").write_bytes(b"not a parquet file")
    add_file(spark, source, [("a", "j", "ERROR", at(5), at(6))], RUN)
    run()
    kept = srn.read_history(spark, str(out), RUN).filter(F.col("bucket") == mine).collect()
    assert [(r.run_id, r.status) for r in kept] == [("a", "FAILED")]


def test_failure_stream(spark, tmp_path):
    source = tmp_path / "in"
    add_file(spark, source, [("a", "j", "FAILED", at(0), at(1)), ("b", "k", "ERROR", at(0), at(1)),
                             ("c", "j", "SUCCEEDED", at(0), at(1))], RUN)
    srn.watch_failures(stream_of(spark, source, RUN), str(tmp_path / "out"), str(tmp_path / "cp"), ["j"]).awaitTermination()
    assert [r.run_id for r in spark.read.schema(RUN).parquet(str(tmp_path / "out")).collect()] == ["a"]
