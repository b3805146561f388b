"""Scans: parquet, CSV, logs, run records and databases."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from fareloom.sources.spec import SourceSpec

# The zone file layout (column, accepted headings, type).
ZONE_COLUMNS = (
    ("LocationID", ("LocationID", "location_id"), "int"),
    ("Borough", ("Borough",), "string"),
    ("Zone", ("Zone",), "string"),
    ("service_zone", ("service_zone", "ServiceZone"), "string"),
)
RUN_SCHEMA = (
    "run_id string, job_name string, status string, started_at timestamp, completed_at timestamp, "
    "execution_seconds bigint"
)


#: What Spark says when files disagree on a type.
UNMERGEABLE = "CANNOT_MERGE_SCHEMAS"


def read_trips(spark: SparkSession, path: str) -> DataFrame:
    """Raw trip files under a folder, columns merged over all files.

    Where files disagree on the type of a column, it is read as the type that holds both
    (:func:`wider_type`), one scan for each different schema.
    """
    try:
        return spark.read.option("mergeSchema", "true").parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        if UNMERGEABLE not in str(error):
            raise
    files = sorted(spark.read.parquet(path).inputFiles())
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, members in _schema_groups(spark, files, path):
        groups.setdefault(schema.json(), (schema, []))[1].extend(members)
    merged: dict[str, T.DataType] = {}
    for schema, _ in groups.values():
        for field in schema:
            known = merged.get(field.name)
            merged[field.name] = wider_type(known, field.dataType) if known else field.dataType
    scans = [
        spark.read.option("basePath", path).schema(schema).parquet(*members).select(
            *[
                (F.col(f"`{name}`") if name in schema.names else F.lit(None)).cast(kind).alias(name)
                for name, kind in merged.items()
            ]
        )
        for schema, members in groups.values()
    ]
    return reduce(DataFrame.unionAll, scans)


def _schema_groups(
    spark: SparkSession, files: list[str], base: str
) -> list[tuple[T.StructType, list[str]]]:
    """Files in groups that Spark can merge, with the merged schema.

    Halves are tried until they merge. Types usually change once or twice in the life of a
    source, so a few attempts do; footers are read in parallel by Spark.
    """
    reader = spark.read.option("basePath", base).option("mergeSchema", "true")
    try:
        return [(reader.parquet(*files).schema, files)]
    except (PySparkException, Py4JJavaError) as error:
        if len(files) == 1 or UNMERGEABLE not in str(error):
            raise
    middle = len(files) // 2
    return _schema_groups(spark, files[:middle], base) + _schema_groups(spark, files[middle:], base)


_WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


def wider_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that values of both are read as.

    The longer of two whole-number types; double for a whole number or decimal and a
    float or double; a decimal with room for both sides; a timestamp for a date and a
    timestamp; text for any other pair.
    """
    if a == b:
        return a
    if a in _WHOLE and b in _WHOLE:
        return max(a, b, key=_WHOLE.index)
    numeric = isinstance(a, T.NumericType) and isinstance(b, T.NumericType)
    if numeric and isinstance(a, T.FractionalType) | isinstance(b, T.FractionalType):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
            return T.DoubleType()
        p = [(_DIGITS[t], 0) if t in _DIGITS else (t.precision - t.scale, t.scale) for t in (a, b)]
        scale, whole = max(p[0][1], p[1][1]), max(p[0][0], p[1][0])
        return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()
    times = (T.TimestampNTZType, T.TimestampType)
    if isinstance(a, (T.DateType, *times)) and isinstance(b, (T.DateType, *times)):
        return next(t for t in (a, b) if isinstance(t, times))
    return T.StringType()


_KNOWN_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A parquet table whose files do not change shape while the program runs.

    The schema is taken from the files once per path; later reads start no job.
    """
    if path not in _KNOWN_SCHEMAS:
        _KNOWN_SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_KNOWN_SCHEMAS[path]).parquet(path)


def spread_if_narrow(df: DataFrame, key: str) -> DataFrame:
    """Deal rows out by ``key`` when the scan has fewer partitions than there are cores.

    A small table often is one file with one row group: one task reads it and would
    run everything up to the next shuffle alone. Filters and column pruning still
    reach the scan. A table with enough partitions is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_zone_csv(spark: SparkSession, path: str) -> DataFrame:
    """Zone file as ``LocationID, Borough, Zone, service_zone``, under either heading style.

    Columns are taken by heading, not by position, so a reordered file reads right
    and one that lacks a column is an error.
    """
    raw = spark.read.option("header", "true").csv(path)
    wanted = {name: (candidates, kind) for name, candidates, kind in ZONE_COLUMNS}
    return pick_columns(raw, wanted)


def read_csv_inferred(spark: SparkSession, path: str) -> DataFrame:
    """CSV with inferred types; an empty file is an error."""
    df = spark.read.options(header=True, inferSchema=True).csv(path)
    if df.isEmpty():
        raise ValueError(f"no rows in {path}")
    return df


def pick_columns(df: DataFrame, wanted: Mapping[str, tuple[Sequence[str], str]]) -> DataFrame:
    """Select target columns by candidate headings, ignoring case.

    ``wanted`` maps a target name to (candidates, type). The first candidate the
    header holds is taken; none is an error.
    """
    present = {c.lower(): c for c in df.columns}
    chosen: list[Column] = []
    for target, (candidates, kind) in wanted.items():
        found = next((present[c.lower()] for c in candidates if c.lower() in present), None)
        if found is None:
            raise ValueError(f"none of {list(candidates)} present in {df.columns}")
        chosen.append(F.col(f"`{found}`").try_cast(kind).alias(target))
    return df.select(*chosen)


def read_zone_seed(spark: SparkSession, path: str) -> DataFrame:
    """Zone file under either heading style, ordered by id."""
    zones = read_zone_csv(spark, path)
    return zones.withColumnsRenamed(
        {"LocationID": "location_id", "Borough": "borough", "Zone": "zone"}
    ).orderBy("location_id")


def fetch(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Read a source as its spec says. A CSV "N/A" reads as NULL unless the spec differs."""
    reader = spark.read
    if spec.kind == "csv":
        reader = reader.option("header", "true")
        if spec.null_value is not None:
            reader = reader.option("nullValue", spec.null_value)
        if spec.schema:
            reader = reader.option("enforceSchema", "false").schema(spec.schema)
        else:
            reader = reader.option("inferSchema", "true")
        return reader.csv(spec.source)
    return reader.option("mergeSchema", "true").parquet(spec.source)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame(list(rows), schema)


def read_run_records(spark: SparkSession, path: str) -> DataFrame:
    """Run records as JSON lines."""
    return spark.read.schema(RUN_SCHEMA).json(path)


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    """Driver log lines, one file per run named ``<run_id>-driver*``.

    Reading whole-file order through the file's own row positions keeps the first
    summary line of a run well defined.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("message"),
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
    )
    return lines.select(
        F.substring_index("_file", "-driver", 1).alias("run_id"),
        F.struct("_block", F.monotonically_increasing_id().alias("_line")).alias("line_no"),
        "message",
    )


def read_jdbc(
    spark: SparkSession,
    url: str,
    query: str,
    properties: Mapping[str, str] | None = None,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database query as a source; the database filters, and partitions read in parallel."""
    reader = spark.read.format("jdbc").option("url", url).options(**dict(properties or {}))
    if partition_column and bounds:
        return (
            reader.option("dbtable", f"({query}) q")
            .option("partitionColumn", partition_column)
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
            .load()
        )
    return reader.option("query", query).load()


def master_tables_jdbc(spark: SparkSession, url: str, properties: Mapping[str, str]) -> dict[str, DataFrame]:
    """The three tables zone resolution needs, read from a live database."""
    columns = {
        "zone_matches": "source_zone_id, golden_zone_row_id",
        "taxi_zones": "location_id",
        "golden_zones": "location_id, borough, zone, service_zone, golden_zone_row_id, version, is_current",
    }
    return {
        table: read_jdbc(spark, url, f"SELECT {names} FROM {table}", properties)
        for table, names in columns.items()
    }
