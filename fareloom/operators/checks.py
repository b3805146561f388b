"""Reconciliation checks: rows of (check_name, actual, expected, verdict).

The fact is read once. One pass counts its rows, its NULL keys and the rows that
miss each dimension; the eleven other checks read only the small dimensions.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from fareloom.functions.text import blank
from fareloom.operators.dedupe import duplicate_keys
from fareloom.operators.star import Star

REQUIRED_KEYS = (
    "vendorid", "pickup_datetime", "dropoff_datetime", "date_key", "pickup_location_id",
    "dropoff_location_id", "payment_type", "passenger_count",
)

# Names of the eighteen checks.
NAMES = {
    "A": "A. fact_trips count",
    "B": "B. dim_zone count",
    "C": "C. dim_date count",
    "D": "D. dim_payment count",
    "E": "E. unresolved pickup locations",
    "F": "F. unresolved dropoff locations",
    "F2": "F2. unresolved payment types",
    "F3": "F3. unresolved date keys",
    "G": "G. duplicate dim_zone keys",
    "G2": "G2. duplicate dim_date keys",
    "G3": "G3. duplicate dim_payment keys",
    "H": "H. fact rows with NULL required keys",
    "I": "I. full star join resolves",
    "O": "O. dim_zone excludes fixture",
    "O2": "O2. dim_zone ids all within range",
    "P": "P. dim_zone rows fully populated",
    "P2": "P2. dim_zone golden_zone_row_id unique",
    "P3": "P3. dim_date has no calendar gaps",
}

Expected = Mapping[str, int | Column]


def verdict(rows: DataFrame) -> DataFrame:
    """PASS exactly when actual equals expected; a check that gave no number fails."""
    same = F.coalesce(F.col("actual") == F.col("expected"), F.lit(False))
    return rows.select(
        "check_name",
        F.col("actual").cast("long").alias("actual"),
        F.col("expected").cast("long").alias("expected"),
        F.when(same, "PASS").otherwise("FAIL").alias("verdict"),
    )


def check(df: DataFrame, name: str, expected: int | Column) -> DataFrame:
    """A check whose actual value is the row count of ``df``."""
    limit = expected if isinstance(expected, Column) else F.lit(expected)
    counted = df.agg(F.count(F.lit(1)).alias("actual"))
    return verdict(counted.select(F.lit(name).alias("check_name"), "actual", limit.alias("expected")))


def stack_checks(checks: Sequence[DataFrame]) -> DataFrame:
    """One frame from several check frames."""
    return reduce(DataFrame.unionAll, checks)


def orphans(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is NULL or absent from the dimension."""
    return fact.join(dim, F.col(fact_key) == F.col(dim_key), "left_anti")


def _key_counts(dim: DataFrame, key: str, name: str) -> DataFrame:
    return dim.groupBy(F.col(key).alias(f"_{name}")).agg(F.count(F.lit(1)).alias(f"{name}_n"))


def fact_measurements(star: Star) -> DataFrame:
    """One row: fact count, NULL-key rows, rows missing each dimension, star-join rows.

    The fact is first summed over its four foreign keys, so the joins see one row
    per key combination. Dimensions enter as one row per key with its number of
    copies, which keeps duplicate dimension keys from multiplying orphan counts
    while the star join still counts them.
    """
    null_key = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED_KEYS])
    keys = ["pickup_location_id", "dropoff_location_id", "date_key", "payment_type"]
    cells = star.fact_trips.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(null_key).alias("null_rows")
    )
    zp = star.hint_zones(_key_counts(star.dim_zone, "location_id", "zp"))
    zd = zp.withColumnsRenamed({"_zp": "_zd", "zp_n": "zd_n"})
    d = _key_counts(star.dim_date, "date_key", "d")
    p = _key_counts(star.dim_payment, "payment_type", "p")
    joined = (
        cells.join(zp, F.col("pickup_location_id") == F.col("_zp"), "left")
        .join(zd, F.col("dropoff_location_id") == F.col("_zd"), "left")
        .join(d, F.col("date_key") == F.col("_d"), "left")
        .join(p, F.col("payment_type") == F.col("_p"), "left")
    )

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    def missing(name: str) -> Column:
        return total(F.when(F.col(f"{name}_n").isNull(), F.col("rows")))

    product = F.col("rows") * F.col("zp_n") * F.col("zd_n") * F.col("d_n") * F.col("p_n")
    return joined.agg(
        total(F.col("rows")).alias("A"),
        missing("zp").alias("E"),
        missing("zd").alias("F"),
        missing("p").alias("F2"),
        missing("d").alias("F3"),
        total(F.col("null_rows")).alias("H"),
        total(product).alias("I"),
    )


def fact_checks(star: Star, expected_rows: int | Column) -> DataFrame:
    """Checks A, E, F, F2, F3, H and I from one pass over the fact."""
    limit = expected_rows if isinstance(expected_rows, Column) else F.lit(expected_rows)
    ids = ["A", "E", "F", "F2", "F3", "H", "I"]
    # A and I are held against the expected row count, the others against zero.
    entries = [
        F.struct(
            F.lit(NAMES[i]).alias("check_name"),
            F.col(i).cast("long").alias("actual"),
            (F.col("_limit") if i in ("A", "I") else F.lit(0)).cast("long").alias("expected"),
        )
        for i in ids
    ]
    measured = fact_measurements(star).withColumn("_limit", limit.cast("long"))
    return verdict(measured.select(F.explode(F.array(*entries)).alias("e")).select("e.*"))


def zone_checks(
    zones: DataFrame, expected: int | Column, lo: int, hi: int, fixture_id: int = 99999
) -> DataFrame:
    """Checks B, G, O, O2, P and P2 on the zone dimension."""
    fixture = (
        (F.col("location_id") == fixture_id)
        | F.col("borough").ilike("Test%")
        | F.col("zone").ilike("Test%")
    )
    incomplete = (
        F.col("golden_zone_row_id").isNull()
        | F.col("version").isNull()
        | blank("borough")
        | blank("zone")
        | blank("service_zone")
    )
    return stack_checks(
        [
            check(zones, NAMES["B"], expected),
            check(duplicate_keys(zones, ["location_id"]), NAMES["G"], 0),
            check(zones.filter(fixture), NAMES["O"], 0),
            check(zones.filter(~F.col("location_id").between(lo, hi)), NAMES["O2"], 0),
            check(zones.filter(incomplete), NAMES["P"], 0),
            check(duplicate_keys(zones, ["golden_zone_row_id"]), NAMES["P2"], 0),
        ]
    )


def calendar_checks(dates: DataFrame, expected: int | Column) -> DataFrame:
    """Checks C, G2 and P3 on the date dimension."""
    span = dates.agg(
        (F.datediff(F.max("full_date"), F.min("full_date")) + 1).alias("span"),
        F.count(F.lit(1)).alias("n_rows"),
    ).filter(F.col("span") != F.col("n_rows"))
    return stack_checks(
        [
            check(dates, NAMES["C"], expected),
            check(duplicate_keys(dates, ["date_key"]), NAMES["G2"], 0),
            check(span, NAMES["P3"], 0),
        ]
    )


def payment_checks(payments: DataFrame, expected: int | Column) -> DataFrame:
    """Checks D and G3 on the payment dimension."""
    return stack_checks(
        [
            check(payments, NAMES["D"], expected),
            check(duplicate_keys(payments, ["payment_type"]), NAMES["G3"], 0),
        ]
    )


def run_checks(star: Star, expected: Expected, *, lo: int = 1, hi: int = 265) -> DataFrame:
    """All eighteen checks. ``expected`` gives the row counts of ``fact_trips``,
    ``dim_zone``, ``dim_date`` and ``dim_payment``, each a number or a scalar column."""
    return stack_checks(
        [
            fact_checks(star, expected["fact_trips"]),
            zone_checks(star.dim_zone, expected["dim_zone"], lo, hi),
            calendar_checks(star.dim_date, expected["dim_date"]),
            payment_checks(star.dim_payment, expected["dim_payment"]),
        ]
    )


def run_checks_apart(
    spark: SparkSession, groups: Sequence[tuple[Sequence[str], Callable[[], DataFrame]]]
) -> DataFrame:
    """Check rows of every group, evaluated one by one: what cannot be evaluated fails.

    A group is the names of its checks and what makes their frame. Where a group raises, in
    planning or in a task, each of its checks is evaluated by itself, and one that raises
    again has no number and the verdict FAIL, with the error's first line as ``error``. A
    check that its group does not return fails too. The checks run at once, since only then
    errors show; their rows are as many as there are checks.
    """
    rows: list[tuple] = []
    for names, make in groups:
        try:
            got = {r["check_name"]: r for r in make().collect()}
        except Exception:  # noqa: BLE001 - whatever ends a check is its result
            got = None
        for name in names:
            error = None
            if got is None:
                found, error = _alone(name, make)
            else:
                found = got.get(name)
            if found is None:
                rows.append((name, None, None, "FAIL", error or "the check gave no row"))
            else:
                rows.append((name, found["actual"], found["expected"], found["verdict"], None))
    return spark.createDataFrame(
        rows, "check_name string, actual bigint, expected bigint, verdict string, error string"
    )


def _alone(name: str, make: Callable[[], DataFrame]) -> tuple[Row | None, str | None]:
    """One check of a group: unneeded parts of a stacked frame are pruned by its name."""
    try:
        return make().filter(F.col("check_name") == name).first(), None
    except Exception as error:  # noqa: BLE001
        return None, str(error).strip().split("\n")[0][:500]


def star_check_groups(
    star: Star, expected: Expected, *, lo: int = 1, hi: int = 265
) -> list[tuple[list[str], Callable[[], DataFrame]]]:
    """The eighteen checks in the groups that share a scan, for :func:`run_checks_apart`."""

    def named(*ids: str) -> list[str]:
        return [NAMES[i] for i in ids]

    return [
        (named("A", "E", "F", "F2", "F3", "H", "I"), lambda: fact_checks(star, expected["fact_trips"])),
        (named("B", "G", "O", "O2", "P", "P2"),
         lambda: zone_checks(star.dim_zone, expected["dim_zone"], lo, hi)),
        (named("C", "G2", "P3"), lambda: calendar_checks(star.dim_date, expected["dim_date"])),
        (named("D", "G3"), lambda: payment_checks(star.dim_payment, expected["dim_payment"])),
    ]


def tally(checks: DataFrame) -> DataFrame:
    """Number of checks by verdict."""
    return checks.groupBy("verdict").agg(F.count(F.lit(1)).alias("checks"))
