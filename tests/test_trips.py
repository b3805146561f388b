"""Cleaning rules, summaries, star, checks, tie-outs and bands on small frames."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fareloom.functions.bands import distance_band, fare_band
from fareloom.functions.numeric import exact_avg, exact_sum
from fareloom.operators import checks as ck, gold
from fareloom.operators.bi import bi_dataset
from fareloom.operators.clean import clean_trips, cleaning_accounts, silver
from fareloom.operators.contract import has_columns, require_columns, require_row_count
from fareloom.operators.star import Star, build_star, dim_date, dim_payment, fact_trips, star_totals
from fareloom.operators.tieout import tie_out

SCHEMA = (
    "VendorID int, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
    "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, "
    "passenger_count double, payment_type int, tip_amount double, total_amount double"
)
T0, T1 = dt.datetime(2025, 1, 1, 10), dt.datetime(2025, 1, 1, 10, 30)


def trip(**changes):
    row = dict(
        VendorID=1, tpep_pickup_datetime=T0, tpep_dropoff_datetime=T1, PULocationID=1, DOLocationID=2,
        trip_distance=1.5, fare_amount=10.0, passenger_count=1.0, payment_type=1, tip_amount=1.0,
        total_amount=11.0,
    )
    row.update(changes)
    return tuple(row.values())


@pytest.fixture()
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


@pytest.mark.parametrize(
    "changes",
    [
        {"VendorID": None}, {"tpep_pickup_datetime": None}, {"tpep_dropoff_datetime": None},
        {"PULocationID": None}, {"DOLocationID": None}, {"trip_distance": None},
        {"fare_amount": None}, {"passenger_count": None}, {"trip_distance": -0.1},
        {"fare_amount": -1.0}, {"passenger_count": 0.0},
        {"tpep_pickup_datetime": T1, "tpep_dropoff_datetime": T0},
    ],
)
def test_invalid_rows_are_dropped(frame, changes):
    assert clean_trips(frame(trip(**changes))).count() == 0


@pytest.mark.parametrize(
    "changes",
    [
        {}, {"tpep_dropoff_datetime": T0}, {"trip_distance": float("nan")}, {"total_amount": -5.0},
        {"passenger_count": 0.5}, {"payment_type": 9}, {"VendorID": 7},
    ],
)
def test_valid_rows_are_kept(frame, changes):
    assert clean_trips(frame(trip(**changes))).count() == 1


def test_filter_precedes_cast_and_duplicates_go(frame):
    rows = frame(trip(passenger_count=0.5), trip(), trip(), trip(passenger_count=1.2))
    cleaned = clean_trips(rows)
    # 1.0 and 1.2 become equal only by the cast, so both stay.
    assert sorted(r.passenger_count for r in cleaned.collect()) == [0, 1, 1]
    account = cleaning_accounts(frame(trip(), trip(), trip(), trip(fare_amount=-1.0), trip(VendorID=2))).first()
    assert tuple(account) == (5, 2, 1, 2)


def test_missing_columns_are_named(frame):
    short = frame(trip()).drop("fare_amount", "VendorID")
    assert has_columns(short, ["VendorID", "trip_distance"]) == (False, ["VendorID"])
    with pytest.raises(ValueError, match="VendorID.*fare_amount"):
        clean_trips(short)
    assert require_columns(short, ["trip_distance"]) is short


def test_sums_do_not_depend_on_order_and_keep_odd_values(spark):
    values = [(0.1,)] * 1000 + [(1e9,), (-1e9,)]
    one = spark.createDataFrame(values, "v double").repartition(7)
    assert one.agg(exact_sum("v")).first()[0] == 100.0
    nan = spark.createDataFrame([(1.0,), (float("nan"),)], "v double")
    assert str(nan.agg(exact_avg("v")).first()[0]) == "nan"
    none = spark.createDataFrame([(None,)], "v double").agg(exact_sum("v"), exact_avg("v")).first()
    assert tuple(none) == (None, None)


def test_sums_neither_cut_nor_overflow(spark):
    tiny = spark.range(1_000_000).select(F.lit(0.00004).alias("v"))
    assert tiny.agg(exact_sum("v")).first()[0] == 40.0
    large = spark.range(20_000).select(F.lit(9e10).alias("v"))
    assert large.agg(exact_sum("v")).first()[0] == 1.8e15
    fine = spark.range(4).select(F.lit(2.0**-60).alias("v"))
    assert fine.agg(exact_sum("v")).first()[0] == 2.0**-58


def test_cube_gives_the_same_summaries(frame):
    rows = silver(
        frame(*[trip(VendorID=i % 3, fare_amount=i + 0.1, payment_type=i % 2,
                     tip_amount=None if i % 5 == 0 else 0.7) for i in range(40)])
    )
    by_cube = gold.gold_summaries(rows)
    direct = {
        "daily_summary": gold.daily_summary(rows), "vendor_summary": gold.vendor_summary(rows),
        "borough_summary": gold.borough_summary(rows), "payment_summary": gold.payment_summary(rows),
        "hourly_summary": gold.hourly_summary(rows),
    }
    for name, df in direct.items():
        order = gold.sort_order(name)
        assert df.orderBy(*order).collect() == by_cube[name].orderBy(*order).collect()


def make_star(spark, frame, days=3, zones=((1, "A", "Z1"), (2, "B", "Z2"))):
    rows = [trip(tpep_pickup_datetime=T0 + dt.timedelta(days=2 * i),
                 tpep_dropoff_datetime=T1 + dt.timedelta(days=2 * i)) for i in range(days)]
    zone = spark.createDataFrame(
        [(i, b, z, "S", 100 + i, 1) for i, b, z in zones],
        "location_id int, borough string, zone string, service_zone string, "
        "golden_zone_row_id long, version int",
    )
    return build_star(silver(frame(*rows)), zone, zone_bound=265)


def test_calendar_has_no_gaps_and_empty_fact_no_calendar(spark, frame):
    star = make_star(spark, frame)
    days = [r.full_date for r in star.dim_date.orderBy("date_key").collect()]
    assert days == [dt.date(2025, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    weekend = {r.day_name: r.is_weekend for r in star.dim_date.collect()}
    assert weekend["Saturday"] and weekend["Sunday"] and not weekend["Friday"]
    assert dim_date(fact_trips(silver(frame()))).count() == 0


EXPECTED = {"fact_trips": 3, "dim_zone": 2, "dim_date": 5, "dim_payment": 7}


def failing(star, expected=EXPECTED):
    rows = ck.run_checks(star, expected).collect()
    assert len(rows) == 18
    return {r.check_name.split(".")[0] for r in rows if r.verdict == "FAIL"}


def test_all_checks_pass(spark, frame):
    star = make_star(spark, frame)
    assert failing(star) == set()
    tally = {r.verdict: r.checks for r in ck.tally(ck.run_checks(star, EXPECTED)).collect()}
    assert tally == {"PASS": 18}


def test_each_fault_flips_its_check(spark, frame):
    star = make_star(spark, frame)
    fact, zone, day, pay = star.fact_trips, star.dim_zone, star.dim_date, star.dim_payment

    def with_fact(column, value):
        return replace(star, fact_trips=fact.withColumn(column, F.lit(value).cast(fact.schema[column].dataType)))

    def with_zone(**columns):
        return replace(star, dim_zone=zone.withColumns({k: F.lit(v).cast(zone.schema[k].dataType) for k, v in columns.items()}))

    assert failing(with_fact("pickup_location_id", 77)) == {"E", "I"}
    assert failing(with_fact("dropoff_location_id", 77)) == {"F", "I"}
    assert failing(with_fact("payment_type", 12)) == {"F2", "I"}
    assert failing(with_fact("date_key", 19000101)) == {"F3", "I"}
    assert failing(with_fact("passenger_count", None)) == {"H"}
    assert failing(with_fact("payment_type", None)) == {"F2", "H", "I"}
    assert failing(replace(star, fact_trips=fact.limit(2))) == {"A", "I", "C"} - {"C"}
    assert failing(replace(star, dim_zone=zone.unionAll(zone.filter("location_id = 1")))) == {"B", "G", "P2", "I"}
    assert failing(replace(star, dim_date=day.unionAll(day.limit(1)))) >= {"C", "G2", "P3"}
    assert failing(replace(star, dim_payment=pay.unionAll(pay.filter("payment_type = 3")))) == {"D", "G3"}
    assert failing(replace(star, dim_date=day.filter("date_key <> 20250102"))) == {"C", "P3"}
    assert failing(with_zone(borough="test borough")) == {"O"}
    assert failing(with_zone(service_zone="  ")) == {"P"}
    assert failing(with_zone(golden_zone_row_id=5)) == {"P2"}
    extra = zone.limit(1).withColumns({"location_id": F.lit(300).cast("short"), "golden_zone_row_id": F.lit(9).cast("long")})
    assert failing(replace(star, dim_zone=zone.unionAll(extra))) == {"B", "O2"}


def test_bi_dataset_keeps_unresolved_rows(spark, frame):
    star = make_star(spark, frame, zones=((1, "A", "Z1"),))
    rows = bi_dataset(star)
    assert len(rows.columns) == 37 and rows.count() == 3
    assert {r.dropoff_borough for r in rows.collect()} == {None}


def test_bands_send_null_to_the_last(spark):
    df = spark.createDataFrame([(0.99, 9.99), (1.0, 10.0), (19.99, 99.99), (20.0, 100.0), (None, None)],
                               "trip_distance double, fare_amount double")
    rows = df.select(distance_band(), fare_band()).collect()
    assert [tuple(r) for r in rows] == [
        ("1. 0-1 mi", "1. $0-10"), ("2. 1-2 mi", "2. $10-20"), ("5. 10-20 mi", "5. $50-100"),
        ("6. 20+ mi", "6. $100+"), ("6. 20+ mi", "6. $100+"),
    ]


def test_tie_out_needs_both_sides_and_respects_tolerance(spark):
    left = spark.createDataFrame([(1, 10.00), (2, 5.0), (3, 7.0), (5, None)], "k int, v double")
    right = spark.createDataFrame([(1, 10.014), (2, 5.02), (4, 1.0), (5, None)], "k int, v double")
    rows = {r.k: r.verdict for r in tie_out(left, right, ["k"], "v", tolerance=0.01, digits=2).collect()}
    assert rows == {1: "PASS", 2: "FAIL", 3: "FAIL", 4: "FAIL", 5: "FAIL"}


def test_values_that_do_not_fit_become_null(frame):
    wide = fact_trips(silver(frame(trip(fare_amount=1e12, PULocationID=70000)))).first()
    assert wide.fare_amount is None and wide.pickup_location_id is None


def test_totals_are_weighted(frame):
    rows = frame(trip(fare_amount=1.0), trip(fare_amount=2.0), trip(fare_amount=2.01))
    total = star_totals(fact_trips(silver(rows))).first()
    assert str(total.weighted_average_fare) == "1.6700000000"


def test_gate_refuses_a_wrong_count(spark):
    with pytest.raises(ValueError, match="dim_payment has 7 rows, expected 8"):
        require_row_count(dim_payment(spark), 8, "dim_payment")
