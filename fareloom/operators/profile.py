"""Data-quality profile of a trip table, as numbers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from fareloom.functions.numeric import exact_avg, weighted_sum
from fareloom.functions.temporal import elapsed_minutes, elapsed_seconds
from fareloom.operators.dedupe import duplicate_row_count
from fareloom.operators.quantiles import exact_quantiles, melt, named, stored_counts, value_counts

# Which columns each section looks at.
NEGATIVE_MEASURES = (
    "fare_amount", "trip_distance", "tip_amount", "tolls_amount", "total_amount", "extra",
)
DISTRIBUTION_MEASURES = ("trip_distance", "fare_amount", "passenger_count")
CATEGORIES = ("VendorID", "RatecodeID", "payment_type", "store_and_fwd_flag")
HISTOGRAM_BINS = 40
LONG_TRIP_MINUTES = 180
RECOMMENDED_TYPES = {
    **dict.fromkeys(
        ("VendorID", "PULocationID", "DOLocationID", "passenger_count", "RatecodeID",
         "payment_type"), "integer"),
    **dict.fromkeys(
        ("trip_distance", "fare_amount", "extra", "tip_amount", "tolls_amount", "total_amount",
         "mta_tax", "improvement_surcharge", "congestion_surcharge", "Airport_fee",
         "cbd_congestion_fee"), "float"),
    **dict.fromkeys(("tpep_pickup_datetime", "tpep_dropoff_datetime"), "timestamp"),
}


def unpivot(one_row: DataFrame, label: str, value: str) -> DataFrame:
    """A one-row frame of equally typed columns as (label, value) rows."""
    entries = [
        F.struct(F.lit(c).alias(label), F.col(f"`{c}`").alias(value)) for c in one_row.columns
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column that has any, most first; NaN is missing too."""

    kinds = dict(df.dtypes)

    def missing(name: str, kind: str) -> Column:
        absent = F.col(f"`{name}`").isNull()
        return absent | F.isnan(f"`{name}`") if kind in ("double", "float") else absent

    counts = df.agg(
        *[F.struct(F.count_if(missing(c, kinds[c])).alias("missing"),
                   F.count(F.lit(1)).alias("n")).alias(c) for c in df.columns]
    )
    return (
        unpivot(counts, "column_name", "s")
        .filter(F.col("s.missing") > 0)
        .select(
            "column_name",
            F.col("s.missing").alias("missing"),
            F.round(F.col("s.missing") * 100.0 / F.col("s.n"), 2).cast("double").alias("missing_pct"),
        )
        .orderBy(F.desc("missing"), "column_name")
    )


def negative_values(df: DataFrame, measures: Sequence[str] = NEGATIVE_MEASURES) -> DataFrame:
    """Number of negative values per measure."""
    present = [m for m in measures if m in df.columns]
    return unpivot(df.agg(*[F.count_if(F.col(m) < 0).alias(m) for m in present]),
                   "measure", "negatives")


def invalid_counts(df: DataFrame) -> DataFrame:
    """Passenger, timestamp and location faults, and unusual durations."""
    minutes = elapsed_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
    late = F.col("tpep_pickup_datetime") > F.col("tpep_dropoff_datetime")
    counts = df.agg(
        F.count_if(F.col("passenger_count") <= 0).alias("passenger_count_not_positive"),
        F.count_if(late).alias("pickup_after_dropoff"),
        F.count_if(F.col("PULocationID").isNull()).alias("missing_pickup_location"),
        F.count_if(F.col("DOLocationID").isNull()).alias("missing_dropoff_location"),
        F.count_if(minutes < 0).alias("negative_duration"),
        F.count_if(minutes > LONG_TRIP_MINUTES).alias("duration_over_180_minutes"),
    )
    return unpivot(counts, "check_name", "rows")


def _durations(df: DataFrame) -> DataFrame:
    """Whole microseconds stay exact in a double up to 285 years."""
    seconds = elapsed_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return df.select(seconds.alias("duration_seconds"))


def duration_quantiles(df: DataFrame) -> DataFrame:
    """95th and 99th percentile of the trip duration in minutes, two decimals."""
    quantiles = exact_quantiles(
        stored_counts(melt(_durations(df), ["duration_seconds"])), [0.95, 0.99]
    )
    return quantiles.select(
        "probability", F.round(F.col("value") / 60.0, 2).alias("duration_minutes")
    )


def histogram(
    df: DataFrame, measures: Sequence[str] = DISTRIBUTION_MEASURES, bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Equal-width bins between the smallest and largest value of each measure.

    Values are counted first, so the trips are scanned once for both the range and
    the bins. The last bin includes its upper edge; empty bins give no row.
    """
    counts = value_counts(melt(df.select(*measures), measures))
    ranges = counts.groupBy("measure").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    ranges = ranges.withColumnRenamed("measure", "_m")
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.floor((F.col("value") - F.col("lo")) / F.nullif(width, F.lit(0.0)))
    placed = counts.join(F.broadcast(ranges), F.col("measure") == F.col("_m"))
    binned = placed.withColumn("bin", F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int"))
    rows = binned.groupBy("measure", "bin", "lo", "hi").agg(F.sum("n").alias("rows"))
    return named(rows, measures).select(
        "measure",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("lower_edge"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("upper_edge"),
        "rows",
    )


def box_plot(
    df: DataFrame,
    measures: Sequence[str] = DISTRIBUTION_MEASURES,
    duration: bool = True,
) -> DataFrame:
    """Quartiles, whisker ends and outlier count per measure, and of the trip duration."""
    columns: list[Column] = [F.col(m).cast("double").alias(m) for m in measures]
    names = list(measures)
    if duration:
        seconds = elapsed_seconds("tpep_pickup_datetime", "tpep_dropoff_datetime")
        columns.append(seconds.alias("duration_seconds"))
        names.append("duration_seconds")
    counts = stored_counts(melt(df.select(*columns), names))

    def quartile(p: float) -> Column:
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    fences = (
        exact_quantiles(counts, [0.25, 0.5, 0.75])
        .groupBy(F.col("measure").alias("_m"))
        .agg(quartile(0.25).alias("q1"), quartile(0.5).alias("median"), quartile(0.75).alias("q3"))
        .withColumn("_reach", 1.5 * (F.col("q3") - F.col("q1")))
    )
    low, high = F.col("q1") - F.col("_reach"), F.col("q3") + F.col("_reach")
    inside = F.col("value").between(low, high)
    boxes = (
        counts.join(F.broadcast(fences), F.col("measure") == F.col("_m"))
        .groupBy("measure", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )
    return named(boxes, names)


def melt_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of any type as rows: position ``place``, ``text``, and ``number`` to order by.

    ``number`` is NULL for columns that are not numeric. NULL and NaN give no row.
    """
    kinds = {f.name: f.dataType for f in df.schema}

    def entry(place: int, name: str) -> Column:
        value = F.col(f"`{name}`")
        numeric = isinstance(kinds[name], T.NumericType)
        number = (value if numeric else F.lit(None)).cast("double")
        return F.struct(
            F.lit(place).alias("place"), number.alias("number"), value.cast("string").alias("text")
        )

    entries = F.array(*[entry(place, name) for place, name in enumerate(columns)])
    real = F.col("text").isNotNull() & ~F.coalesce(F.isnan("number"), F.lit(False))
    return df.select(F.explode(entries).alias("e")).select("e.*").filter(real)


def distinct_values(
    df: DataFrame, columns: Sequence[str] = CATEGORIES, first: int = 20
) -> DataFrame:
    """The ``first`` smallest distinct values of each column and how many there are.

    All columns are found in one scan and one shuffle of their distinct values. Before the
    few smallest of a column meet, every task has left no more than ``first`` of them, so a
    column with billions of values is never gathered.
    """
    values = melt_text(df, columns).groupBy("place", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    # A filter on row_number lets each task drop all but its first ones before the shuffle.
    order = Window.partitionBy("place").orderBy("number", "text")
    least = values.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= first)
    listed = least.groupBy("place").agg(
        F.array_join(F.sort_array(F.collect_list(F.struct("_at", "text"))).getField("text"), ",").alias("first_values")
    )
    counts = values.groupBy("place").agg(F.count(F.lit(1)).alias("distinct_count"))
    names = df.sparkSession.createDataFrame(list(enumerate(columns)), "place int, column_name string")
    # One row for each column.
    return names.join(F.broadcast(counts), "place", "left").join(F.broadcast(listed), "place", "left").select(
        "column_name",
        F.coalesce("first_values", F.lit("")).alias("first_values"),
        F.coalesce("distinct_count", F.lit(0)).alias("distinct_count"),
    )


DESCRIBED = ("count", "unique", "top", "freq", "mean", "std", "minimum", "q25", "median", "q75", "maximum")


def describe(df: DataFrame) -> DataFrame:
    """A row for each column, with what can be said of its kind.

    Numbers and times: count, mean, standard deviation (of a sample), smallest, quartiles,
    largest; times in seconds since 1970. All others: count, number of different values,
    the most frequent one (of several the least) and how often it comes. NaN is missing.

    Moments and quartiles come from the counts of the different values; those are counted in
    parallel, and the most frequent is the largest of their counts.
    """
    kinds = {f.name: f.dataType for f in df.schema}
    times = [n for n, k in kinds.items() if isinstance(k, (T.TimestampType, T.TimestampNTZType, T.DateType))]
    measured = [n for n, k in kinds.items() if isinstance(k, T.NumericType) or n in times]
    named_ = [n for n in df.columns if n not in measured]

    def number(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name in times:
            return F.unix_micros(value.cast("timestamp")).cast("double") / 1e6
        return F.nanvl(value.cast("double"), F.lit(None).cast("double"))

    parts = [_measured(df.select(*[number(n).alias(n) for n in measured]), measured)] if measured else []
    if named_:
        parts.append(_most_frequent(df, named_))
    found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    for name in DESCRIBED:
        if name not in found.columns:
            found = found.withColumn(name, F.lit(None).cast("string" if name == "top" else "double"))
    return found.select("column_name", *DESCRIBED)


def _measured(numbers: DataFrame, names: Sequence[str]) -> DataFrame:
    """All figures come from the counts of the different values, so the rows are read once and added up as few."""
    counts = stored_counts(melt(numbers, [f"`{n}`" for n in names]))
    n = F.sum("n")
    stats = counts.groupBy("measure").agg(
        n.alias("count"),
        (weighted_sum("value", "n") / n.cast("double")).alias("mean"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
    )
    means = stats.select(F.col("measure").alias("_m"), F.col("mean").alias("_mean"))
    away = F.col("value") - F.col("_mean")
    # Means, like all that follows, are a few rows: one for each column.
    squares = (
        counts.join(F.broadcast(means), F.col("measure") == F.col("_m"))
        .groupBy("measure")
        .agg(F.sqrt(F.sum(away * away * F.col("n")) / F.nullif(n - 1, F.lit(0))).alias("std"))
    )

    def quartile(p: float) -> Column:
        return F.max(F.when(F.col("probability") == p, F.col("value")))

    quartiles = (
        exact_quantiles(counts, [0.25, 0.5, 0.75])
        .groupBy("measure")
        .agg(quartile(0.25).alias("q25"), quartile(0.5).alias("median"), quartile(0.75).alias("q75"))
    )
    every = numbers.sparkSession.createDataFrame(list(enumerate(names)), "measure int, column_name string")
    for found in (stats, squares, quartiles):
        every = every.join(F.broadcast(found), "measure", "left")
    return every.withColumn("count", F.coalesce("count", F.lit(0))).drop("measure")


def _most_frequent(df: DataFrame, names: Sequence[str]) -> DataFrame:
    counts = melt_text(df, names).groupBy("place", "text").agg(F.count(F.lit(1)).alias("n"))
    per_column = counts.groupBy("place").agg(
        F.sum("n").alias("count"),
        F.count(F.lit(1)).cast("double").alias("unique"),
        F.min(F.struct((-F.col("n")).alias("n"), "text")).alias("_first"),
    )
    every = df.sparkSession.createDataFrame(list(enumerate(names)), "place int, column_name string")
    return every.join(F.broadcast(per_column), "place", "left").select(
        "column_name",
        F.coalesce("count", F.lit(0)).alias("count"),
        F.coalesce("unique", F.lit(0.0)).alias("unique"),
        F.col("_first.text").alias("top"),
        (-F.col("_first.n")).cast("double").alias("freq"),
    )


#: Bytes of a value of fixed width.
WIDTHS = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "float": 4, "date": 4}


def schema_rows(df: DataFrame) -> DataFrame:
    """Position, name, type, values and bytes of every column: text by its length, others by their width."""

    def size(name: str, kind: str) -> Column:
        value = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            return F.coalesce(F.sum(F.octet_length(value)), F.lit(0))
        return F.count(value) * WIDTHS.get(kind, 8)

    measured = df.agg(
        *[
            F.struct(
                F.lit(place).alias("position"),
                F.lit(name).alias("column_name"),
                F.lit(kind).alias("data_type"),
                F.count(F.col(f"`{name}`")).alias("non_null"),
                size(name, kind).cast("long").alias("data_bytes"),
            ).alias(f"_{place}")
            for place, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return measured.select(F.explode(F.array(*measured.columns)).alias("s")).select("s.*")


def numeric_summary(df: DataFrame, measures: Sequence[str] = DISTRIBUTION_MEASURES) -> DataFrame:
    """Count, mean, minimum and maximum of each measure."""
    stats = df.agg(
        *[
            F.struct(
                F.count(m).alias("n"),
                exact_avg(m).alias("mean"),
                F.min(F.col(m).cast("double")).alias("low"),
                F.max(F.col(m).cast("double")).alias("high"),
            ).alias(m)
            for m in measures
        ]
    )
    return unpivot(stats, "measure", "s").select(
        "measure",
        F.col("s.n").alias("non_null"),
        F.col("s.mean").alias("mean"),
        F.col("s.low").alias("minimum"),
        F.col("s.high").alias("maximum"),
    )


def quality_report(df: DataFrame) -> DataFrame:
    """Nine findings with affected rows, recommended action and priority."""
    late = F.col("tpep_pickup_datetime") > F.col("tpep_dropoff_datetime")
    findings = [
        ("Negative Fare", F.count_if(F.col("fare_amount") < 0), "Remove", "High"),
        ("Negative Trip Distance", F.count_if(F.col("trip_distance") < 0), "Remove", "High"),
        ("Invalid Passenger Count", F.count_if(F.col("passenger_count") <= 0), "Remove", "High"),
        ("Pickup After Dropoff", F.count_if(late), "Remove", "High"),
        ("Missing Passenger Count", F.count_if(F.col("passenger_count").isNull()),
         "Review/Replace", "Medium"),
        ("Missing RatecodeID", F.count_if(F.col("RatecodeID").isNull()),
         "Review/Replace", "Medium"),
        ("Missing Store and Forward Flag", F.count_if(F.col("store_and_fwd_flag").isNull()),
         "Review/Replace", "Medium"),
        ("Missing Location IDs",
         F.count_if(F.col("PULocationID").isNull()) + F.count_if(F.col("DOLocationID").isNull()),
         "Remove/Review", "Medium"),
    ]
    measured = df.agg(*[value.alias(name) for name, value, _, _ in findings])
    entries = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.col(f"`{name}`").cast("long").alias("records_affected"),
            F.lit(action).alias("recommended_action"),
            F.lit(priority).alias("priority"),
        )
        for name, _, action, priority in findings
    ]
    rows = measured.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
    copies = duplicate_row_count(df).select(
        F.lit("Duplicate Rows").alias("check_name"),
        F.col("duplicate_rows").alias("records_affected"),
        F.lit("Remove").alias("recommended_action"),
        F.lit("High").alias("priority"),
    )
    return copies.unionAll(rows)


def profile(df: DataFrame) -> dict[str, DataFrame]:
    """Every section of the profile, lazily."""
    return {
        "missing": missing_values(df),
        "negative": negative_values(df),
        "invalid": invalid_counts(df),
        "duration": duration_quantiles(df),
        "histogram": histogram(df),
        "box_plot": box_plot(df),
        "distinct": distinct_values(df),
        "numeric": numeric_summary(df),
        "schema": schema_rows(df),
        "describe": describe(df),
        "report": quality_report(df),
    }
