"""Hashes, SCD merges against a row-at-a-time simulation, matching, merges, backfills."""

import datetime as dt
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from fareloom.operators import history as hs, matching as mt, merge as mg
from fareloom.operators.asof import as_of
from fareloom.operators.audit import audit_rows
from fareloom.operators.backfill import backfill_key
from fareloom.operators.contract import require_empty, validation_report
from fareloom.operators.dedupe import keep_one, repeated_keys
from fareloom.operators.keys import assign_ids
from fareloom.operators.slices import cut_slices, with_slices
from fareloom.operators.reference import (
    clean_reference, clean_vendors, hash_vendors, standardise_and_hash, trim_strings, vendor_accounts,
)

ZONE = "location_id int, borough string, zone string, service_zone string"


# Known record hashes.
@pytest.mark.parametrize(
    ("row", "digest"),
    [
        ((1, " EWR", "Newark Airport", "ewr"), "98ff61ce16f9e45c726d8a4d5568d422"),
        ((1, "EWR", "NEWARK AIRPORT", "AIRPORT"), "985c64b330521741ee56f8043a6ada71"),
        ((2, "Queens", "Jamaica Bay ", "Boro Zone"), "02e8e4f8cf0806ae86ec1ed919f82f37"),
    ],
)
def test_known_hashes(spark, row, digest):
    assert standardise_and_hash(spark.createDataFrame([row], ZONE)).first().record_hash == digest


def test_reference_cleaning_order(spark):
    rows = [(1, " A", "Z", None), (1, " A", "Z", None), (1, "A", "Z", ""), (2, "", "Y ", "S")]
    cleaned = clean_reference(
        spark.createDataFrame(rows, "LocationID int, Borough string, Zone string, service_zone string"),
        {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"},
    )
    # The two spellings of row 1 are distinct before trimming, so both stay.
    assert sorted(tuple(r) for r in cleaned.collect()) == [
        (1, "A", "Z", "Unknown"), (1, "A", "Z", "Unknown"), (2, "Unknown", "Y", "S")]


def test_vendor_cleaning(spark):
    rows = [("1", " Acme "), ("1", "Beta"), ("x", "Bad id"), ("2", "  "), ("3", "Gamma")]
    cleaned = hash_vendors(clean_vendors(spark.createDataFrame(rows, "vendor_id string, name string")))
    found = {r.VendorID: r.vendor_name for r in cleaned.collect()}
    assert found == {1: "Acme", 3: "Gamma"}
    upper = hash_vendors(spark.createDataFrame([(3, "GAMMA")], "VendorID int, vendor_name string"))
    assert upper.first().record_hash == cleaned.filter("VendorID = 3").first().record_hash
    with pytest.raises(ValueError, match="vendor_name"):
        clean_vendors(spark.createDataFrame([(1,)], "VendorID int"))


def test_trimming_warns_of_unknown_names(spark):
    df = spark.createDataFrame([(" a ", " b ")], "x string, y string")
    with pytest.warns(UserWarning, match="absent"):
        assert tuple(trim_strings(df, ["x", "absent"]).first()) == ("a", " b ")


def test_vendor_accounts_add_up(spark):
    rows = [("1", " Acme "), ("1", "Beta"), ("x", "Bad id"), ("2", "  "), ("3", "Gamma"), (None, None)]
    told = vendor_accounts(spark.createDataFrame(rows, "vendor_id string, name string")).first()
    assert tuple(told) == (6, 3, 1, 2)
    assert tuple(vendor_accounts(spark.createDataFrame([], "vendor_id string, name string")).first()) == (0, 0, 0, 0)


def one_zone(spark, text, key=99999):
    df = spark.createDataFrame([(key, "B", text, "S")], ZONE)
    return df.withColumn("record_hash", F.md5("zone"))


def merge(history, batch, when="2024-01-01"):
    return hs.scd2_merge(history, batch, "location_id", ["borough", "zone", "service_zone"], when)


def test_three_transitions(spark):
    batch = one_zone(spark, "v1")
    empty = hs.empty_history(batch, "location_id", ["borough", "zone", "service_zone"], "golden_zone_row_id")
    first = merge(empty, batch)
    assert [tuple(r) for r in first.statuses.collect()] == [("INSERTED", 1)]
    again = merge(first.history, batch, "2024-02-01")
    assert [tuple(r) for r in again.statuses.collect()] == [("NO_CHANGE", 1)]
    assert again.history.count() == 1 and again.history.first().version == 1
    changed = merge(again.history, one_zone(spark, "v2"), "2024-03-01")
    assert [tuple(r) for r in changed.statuses.collect()] == [("UPDATED", 1)]
    old, new = changed.history.orderBy("version").collect()
    assert (old.is_current, new.is_current, new.version) == (False, True, 2)
    assert old.end_date == new.effective_date == dt.datetime(2024, 3, 1)
    assert new.golden_zone_row_id > old.golden_zone_row_id
    assert {r.violations for r in hs.history_violations(changed.history, "location_id").collect()} == {0}


def test_nulls_and_ambiguous_rows_are_rejected(spark):
    batch = (
        one_zone(spark, "a", None).unionAll(one_zone(spark, "a", 1)).unionAll(one_zone(spark, "b", 1))
        .unionAll(one_zone(spark, "c", 2)).unionAll(one_zone(spark, "c", 2))
    )
    empty = hs.empty_history(batch, "location_id", ["borough", "zone", "service_zone"], "golden_zone_row_id")
    result = merge(empty, batch)
    assert {r.status: r.rows for r in result.statuses.collect()} == {"INSERTED": 1, "NO_CHANGE": 1, "ERROR": 3}
    assert result.rejects.count() == 3
    assert [r.location_id for r in result.history.collect()] == [2]
    # The rejects are the batch's own rows, not copies of one of them.
    assert sorted((r.location_id or 0, r.zone) for r in result.rejects.collect()) == [(0, "a"), (1, "a"), (1, "b")]


def test_histories_with_further_columns(spark):
    batch = one_zone(spark, "a", 1)
    empty = hs.empty_history(batch, "location_id", ["borough", "zone", "service_zone"], "golden_zone_row_id")
    wide = empty.withColumns({"golden_id": F.lit(None).cast("int"), "created_at": F.lit(None).cast("timestamp"),
                              "updated_at": F.lit(None).cast("timestamp"), "remark": F.lit(None).cast("string")})
    history = wide
    for zone, day in (("a", "2024-01-01"), ("b", "2024-01-02")):
        history = hs.scd2_merge(history, one_zone(spark, zone, 1), "location_id", ["borough", "zone", "service_zone"],
                                day, recorded=day, numbered=["golden_id"]).history
    assert history.schema.simpleString() == wide.schema.simpleString()
    rows = history.orderBy("version").collect()
    assert [(r.golden_id, r.created_at.day, r.updated_at.day, r.remark) for r in rows] == [(1, 1, 2, None), (2, 2, 2, None)]


def test_ids_follow_the_order_within_a_key(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("k"), F.expr("id div 7 + 1").cast("int").alias("version"))
    got = assign_ids(rows, ["k"], "row_id", 10, in_order="version", step=50, buckets=4).collect()
    assert sorted(r.row_id for r in got) == list(range(11, 3011))
    for k in range(7):
        own = sorted((r.version, r.row_id) for r in got if r.k == k)
        assert [x[1] for x in own] == sorted(x[1] for x in own)


def test_audit_tells_versions_that_one_batch_opens_and_closes(spark):
    rows = [(1, "a", "2024-01-01", 1), (1, "b", "2024-01-02", 2), (1, "c", "2024-01-03", 3)]
    batch = spark.createDataFrame(rows, "vendor_id int, vendor_name string, at string, n long").select(
        "vendor_id", "vendor_name", F.md5("vendor_name").alias("record_hash"),
        F.col("at").cast("timestamp_ntz").alias("at"), "n",
    )
    empty = hs.empty_history(batch, "vendor_id", ["vendor_name"], "row_id")
    result = hs.scd2_merge(empty, batch, "vendor_id", ["vendor_name"], F.col("at"), arrival="n", row_id="row_id")
    log = audit_rows(result, "vendor_id", "vendors", "loader", ["version", "is_current", "end_date"]).collect()
    assert sorted((r.operation, r.changed_at.day) for r in log) == [
        ("INSERT", 1), ("INSERT", 2), ("INSERT", 3), ("UPDATE", 2), ("UPDATE", 3)]
    assert all('"is_current":true,"end_date":null' in (r.old_values or r.new_values) for r in log)
    assert all('"is_current":false,"end_date":"' in r.new_values for r in log if r.operation == "UPDATE")


def test_insert_ignore_keeps_the_first_delivery(spark):
    target = spark.createDataFrame([], "id string, state string")
    batch = spark.createDataFrame([("r", "SUCCEEDED", 1), ("r", "FAILED", 2)], "id string, state string, n int")
    assert [tuple(r) for r in mg.insert_ignore(target, batch, ["id"], "n").collect()] == [("r", "SUCCEEDED")]


def simulate(history, batch):
    """Row at a time, in arrival order."""
    rows = [dict(r) for r in history]
    for key, name, digest, at, _ in sorted(batch, key=lambda r: r[4]):
        current = next((r for r in rows if r["vendor_id"] == key and r["is_current"]), None)
        if current and current["record_hash"] == digest:
            continue
        if current:
            current.update(is_current=False, end_date=at)
        rows.append(dict(vendor_id=key, vendor_name=name, record_hash=digest,
                         version=(current["version"] if current else 0) + 1, is_current=True,
                         effective_date=at, end_date=None))
    return rows


@pytest.mark.parametrize(("seed", "slice_rows", "stored"), [(1, 7, True), (2, 50, False), (3, 1_000_000, True)])
def test_chained_merge_equals_row_at_a_time(spark, seed, slice_rows, stored):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1)
    # One key holds about half of all rows.
    batch = []
    for i in range(400):
        key = 1 if rng.random() < 0.5 else rng.randint(2, 12)
        name = rng.choice("abc")
        batch.append((key, name, f"h{name}", start + dt.timedelta(minutes=i), i))
    before = [dict(vendor_id=k, vendor_name="a", record_hash="ha", version=1, is_current=True,
                   effective_date=dt.datetime(2000, 1, 1), end_date=None) for k in (1, 3, 5, 40)]
    history = spark.createDataFrame(
        [(100 + i, *r.values()) for i, r in enumerate(before)],
        "vendor_row_id long, vendor_id int, vendor_name string, record_hash string, version int, "
        "is_current boolean, effective_date timestamp_ntz, end_date timestamp_ntz",
    )
    frame = spark.createDataFrame(
        rng.sample(batch, len(batch)),
        "vendor_id int, vendor_name string, record_hash string, at timestamp_ntz, seq long")
    result = hs.scd2_merge(history, frame, "vendor_id", ["vendor_name"], F.col("at"), arrival="seq",
                           row_id="vendor_row_id", store_changes=stored, slice_rows=slice_rows)
    names = list(before[0])
    key = lambda r: (r["vendor_id"], r["version"])
    want = sorted(simulate(before, batch), key=key)
    got = sorted((r.asDict() for r in result.history.collect()), key=key)
    assert [tuple(r[n] for n in names) for r in got] == [tuple(r[n] for n in names) for r in want]
    assert len({r["vendor_row_id"] for r in got}) == len(got)
    counts = {r.status: r.rows for r in result.statuses.collect()}
    assert sum(counts.values()) == len(batch)
    assert counts["INSERTED"] + counts["UPDATED"] == len(want) - len(before)
    assert {r.violations for r in hs.history_violations(result.history, "vendor_id").collect()} == {0}


def test_ids_are_dense_and_repeatable(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 3)
    first = assign_ids(df, ["id"], "row_id", 10, buckets=16)
    assert first.agg(F.min("row_id"), F.max("row_id"), F.count_distinct("row_id")).first() == (11, 5010, 5000)
    again = assign_ids(df.repartition(13), ["id"], "row_id", 10, buckets=16)
    assert first.exceptAll(again).isEmpty()


def golden(spark, rows):
    return spark.createDataFrame(
        rows, "golden_id int, location_id int, borough string, zone string, service_zone string, "
              "golden_zone_row_id long, version int, is_current boolean")


def test_resolution_by_key_not_by_pointer(spark):
    master = golden(spark, [
        (1, 1, "B", "Z", "S", 10, 1, False), (1, 1, "B", "Z", "T", 11, 2, True),
        (2, 2, "B", "Y", "S", 12, 1, True), (9, 99999, "Test", "Test", "S", 13, 1, True)])
    sources = spark.createDataFrame([(1,), (2,)], "location_id int")
    old = spark.createDataFrame(
        [(1, 1, 1, 10), (2, 2, 2, 12)],
        "match_id int, golden_zone_id int, source_zone_id int, golden_zone_row_id long")
    fresh = mt.match_zones(sources, master, old)
    assert [(r.source_zone_id, r.golden_zone_row_id, r.match_id) for r in fresh.collect()] == [(1, 11, 3)]
    both = old.unionByName(fresh.select(*old.columns))
    assert mt.match_zones(sources, master, both).isEmpty()
    resolved = mt.resolve_current(both, sources, master)
    assert sorted((r.location_id, r.version) for r in resolved.collect()) == [(1, 2), (2, 1)]
    assert [r.location_id for r in mt.stale_pointers(old, sources, master).collect()] == [1]


def test_key_backfill_skips_shared_pairs(spark):
    sources = spark.createDataFrame([(56, "Q", "Corona"), (57, "Q", "Corona"), (3, "M", "Soho")],
                                    "location_id int, borough string, zone string")
    master = spark.createDataFrame([(None, "Q", "Corona"), (None, "M", "Soho"), (8, "M", "Soho")],
                                   "location_id int, borough string, zone string")
    rows = sorted((str(r.location_id), r.zone) for r in backfill_key(master, sources).collect())
    assert rows == [("3", "Soho"), ("8", "Soho"), ("None", "Corona")]


def test_merges(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    batch = spark.createDataFrame([(2, None), (3, "c")], "id int, v string")
    merged = mg.scd1_merge(target, batch, ["id"])
    assert sorted((r.id, str(r.v)) for r in merged.collect()) == [(1, "a"), (2, "None"), (3, "c")]
    kept = mg.insert_ignore(target, batch.unionAll(batch), ["id"])
    assert sorted((r.id, str(r.v)) for r in kept.collect()) == [(1, "a"), (2, "b"), (3, "c")]
    with pytest.raises(PySparkException, match="must not hold a key twice"):
        mg.scd1_merge(target, batch.unionAll(batch), ["id"]).collect()
    with pytest.raises(ValueError, match="stop"):
        require_empty(target, "stop")


@pytest.mark.parametrize("slice_rows", [1, 3, 1000])
def test_as_of_is_half_open(spark, slice_rows):
    t = lambda m: dt.datetime(2024, m, 1)
    history = spark.createDataFrame(
        [(1, "old", t(1), t(3)), (1, "new", t(3), None), (2, "only", t(2), None)],
        "k int, name string, effective_date timestamp_ntz, end_date timestamp_ntz")
    facts = spark.createDataFrame(
        [(1, t(1)), (1, t(2)), (1, t(3)), (1, t(9)), (2, t(1)), (2, t(2)), (3, t(5)), (None, t(5))],
        "z int, at timestamp_ntz")
    rows = as_of(facts, history, "z", "at", "k", ["name"], slice_rows=slice_rows).collect()
    assert sorted((str(r.z), r["at"].month, str(r.asof_name)) for r in rows) == [
        ("1", 1, "old"), ("1", 2, "old"), ("1", 3, "new"), ("1", 9, "new"), ("2", 1, "None"),
        ("2", 2, "only"), ("3", 5, "None"), ("None", 5, "None")]


def test_as_of_splits_a_hot_key_and_moment(spark):
    """A third of the facts has one key and month, a quarter one key and moment; some have no key or time."""
    rng = random.Random(3)
    start = dt.datetime(2024, 5, 1)
    times = [start + dt.timedelta(hours=i) for i in range(0, 700, 7)]
    history = []
    for k in (1, 2, 3):
        cuts = sorted(rng.sample(times, 20))
        history += [(k, f"{k}-{i}", a, b) for i, (a, b) in enumerate(zip(cuts, [*cuts[1:], None])) if i % 5 != 3]
    facts = [(rng.choice([1, 1, 1, 2, 3, 4, None]), start + dt.timedelta(hours=rng.randint(0, 720)), i) for i in range(2000)]
    facts += [(1, times[50], i) for i in range(2000, 2700)] + [(2, None, 2700)]
    want = sorted(
        (i, next((name for k, name, a, b in history if k == z and at and a <= at and (b is None or at < b)), None))
        for z, at, i in facts)
    frame = spark.createDataFrame(facts, "z int, at timestamp_ntz, i int")
    versions = spark.createDataFrame(history, "k int, name string, effective_date timestamp_ntz, end_date timestamp_ntz")
    for slice_rows in (50, 300, 100_000):
        got = as_of(frame, versions, "z", "at", "k", ["name"], slice_rows=slice_rows).collect()
        assert sorted((r.i, r.asof_name) for r in got) == want
    # The hot key, and the hot moment in it, are spread over slices of bounded depth.
    spread = frame.filter("z = 1").withColumn("o", F.struct("at", F.xxhash64("i")))
    cuts = cut_slices(spread, "z", "o", 100)
    sizes = [r["count"] for r in with_slices(spread, cuts, "z", F.col("o")).groupBy("_slice").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 300


def test_slices_do_not_depend_on_the_scale_of_the_order(spark):
    """Arrivals in epoch microseconds give as many slices as dense ones, of the same depth."""
    dense = spark.range(10_000).select(F.when(F.col("id") % 5 < 4, 1).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    sparse = dense.withColumn("n", F.col("n") * 86_400_000_000 + 1_700_000_000_000_000)
    depths = []
    for frame in (dense, sparse):
        cuts = cut_slices(frame, "k", "n", 500)
        rows = with_slices(frame, cuts, "k", F.col("n")).filter("k = 1").groupBy("_slice").agg(
            F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("_slice").collect()
        assert [r["_slice"] for r in rows] == list(range(len(rows)))
        assert all(a.high < b.low for a, b in zip(rows, rows[1:]))
        depths.append([r.rows for r in rows])
    assert abs(len(depths[0]) - len(depths[1])) <= 2 and len(depths[1]) > 10
    assert max(map(max, depths)) < 1500
    assert cut_slices(dense, "k", "n", 1_000_000) is None


def test_small_slices_need_few_parts(spark, monkeypatch):
    """Tasks follow the usual number of parts; slices, also of values that repeat, stay of bounded depth."""
    frame = spark.range(9000).select(
        F.when(F.col("id") % 9 < 7, 1).otherwise(F.col("id")).alias("k"), F.floor(F.rand(3) * 300).alias("n"))
    frame = frame.localCheckpoint()
    parts, real = [], type(frame).repartitionByRange
    monkeypatch.setattr(type(frame), "repartitionByRange", lambda df, n, *by: parts.append(n) or real(df, n, *by))
    cuts = cut_slices(frame, "k", "n", 15)
    assert max(parts) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = with_slices(frame, cuts, "k", F.col("n")).filter("k = 1").groupBy("_slice").agg(
        F.count(F.lit(1)).alias("rows"), F.min("n").alias("low"), F.max("n").alias("high")).orderBy("_slice").collect()
    assert sum(r["rows"] for r in rows) == 7000 and max(r["rows"] for r in rows) < 100
    assert all(a.high < b.low for a, b in zip(rows, rows[1:]))


def test_repeated_keys_with_a_hot_and_a_null_key(spark):
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).when(F.col("id") % 1000 == 1, F.lit(None))
        .when(F.col("id") % 50 == 2, F.col("id") % 100).otherwise(F.col("id")).alias("k"), "id")
    found = sorted(r.id for r in repeated_keys(rows, ["k"]).collect())
    pdf = rows.toPandas()
    assert found == sorted(pdf[pdf.duplicated("k", keep=False)]["id"])


@pytest.mark.parametrize("keep", ["first", "last", "none"])
def test_keep_one_like_pandas(spark, keep):
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3, 4, 5, None]), i, rng.random()) for i in range(200)] + [(77, 500, 0.5)]
    df = spark.createDataFrame(data, "k int, seq int, v double").repartition(5)
    got = sorted((r.seq, r.v) for r in keep_one(df, ["k"], ["seq"], keep).collect())
    pdf = df.toPandas().sort_values("seq")
    want = pdf.drop_duplicates("k", keep={"none": False}.get(keep, keep))
    assert got == sorted(zip(want.seq, want.v))


@pytest.mark.parametrize(
    ("rows", "required", "key", "valid", "part"),
    [
        ([(1, "a"), (2, "b")], ["LocationID"], "location_id", True, "successful"),
        ([(1, "a")], ["LocationID", "Zone"], "location_id", False, "Missing required columns"),
        ([(1, "a"), (1, "b")], ["LocationID"], "location_id", False, "Duplicate primary keys"),
        ([(1, "a")], ["LocationID"], "absent", False, "Primary key column absent"),
        ([], ["LocationID"], "location_id", False, "empty"),
    ],
)
def test_validation_report(spark, rows, required, key, valid, part):
    df = spark.createDataFrame(rows, "LocationID int, Borough string")
    report = validation_report(df, required, key, {"LocationID": "location_id"}, refuse_empty=True).first()
    assert report.is_valid is valid and part in report.summary


def test_match_queries_read_every_customer(spark, sf_dir):
    from fareloom.plans import registry

    queries = registry.queries()
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select((F.col("c_custkey") + 1).alias("id"))
    want = {r.id for r in customers.collect()}
    details = queries["match_details"](spark, sf_dir)
    assert {r.match_id for r in details.select("match_id").collect()} == want
    assert {r.match_id for r in queries["pointer_backfill"](spark, sf_dir).select("match_id").collect()} == want
    stale = {r.location_id for r in queries["stale_pointer"](spark, sf_dir).collect()}
    assert stale == {i for i in want if i % 10 == 0}
    violations = {r.rule: r.violations for r in queries["foreign_keys"](spark, sf_dir).collect()}
    assert violations == {"source_zone_id": sum(i % 4 == 0 for i in want), "golden_zone_row_id": len(stale)}
    odd = queries["match_domains"](spark, sf_dir).first()
    assert (odd.bad_score, odd.bad_status, odd.bad_operation) == tuple(sum(i % k == 0 for i in want) for k in (9, 12, 7))
