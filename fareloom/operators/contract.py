"""Column contracts, gates and the ingestion validation report."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from fareloom.operators.dedupe import repeated_keys


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required names the frame lacks, in the order asked for."""
    present = set(df.columns)
    return [name for name in required if name not in present]


def has_columns(df: DataFrame, required: Sequence[str]) -> tuple[bool, list[str]]:
    """Soft contract: a flag and the missing names."""
    missing = missing_columns(df, required)
    return not missing, missing


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Hard contract: the frame itself, or an error naming what is missing."""
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"required columns missing: {missing}; found {df.columns}")
    return df


def require_row_count(df: DataFrame, expected: int, name: str) -> DataFrame:
    """Publish gate: refuse a frame whose row count differs from ``expected``."""
    actual = df.count()
    if actual != expected:
        raise ValueError(f"{name} has {actual} rows, expected {expected}")
    return df


def exists_in(*frames: DataFrame) -> bool:
    """Whether any of the frames, stacked, has a row; the search ends at the first one."""
    stacked = [df.select(F.lit(1).alias("found")) for df in frames]
    return not reduce(DataFrame.unionAll, stacked).isEmpty()


def require_empty(df: DataFrame, reason: str) -> None:
    """Refuse to go on while ``df`` (violations) has a row."""
    if not df.isEmpty():
        raise ValueError(reason)


def type_recommendations(df: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """One row per column: its type, the recommended one if any, and how the values convert.

    ``unconvertible`` counts values that the recommended type would turn into NULL.
    All columns are measured in one scan.
    """
    measured = []
    for column in df.schema.fields:
        value, target = F.col(f"`{column.name}`"), wanted.get(column.name)
        lost = value.isNotNull() & value.try_cast(target).isNull() if target else F.lit(False)
        measured.append(
            F.struct(F.count_if(lost).alias("lost"), F.count(value).alias("n")).alias(column.name)
        )
    entries = [
        F.struct(
            F.lit(column.name).alias("column_name"),
            F.lit(column.dataType.simpleString()).alias("current_type"),
            F.lit(wanted.get(column.name)).cast("string").alias("recommended"),
            F.col(f"`{column.name}`.lost").alias("unconvertible"),
            F.col(f"`{column.name}`.n").alias("non_null"),
        )
        for column in df.schema.fields
    ]
    return df.agg(*measured).select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def validation_report(
    df: DataFrame,
    required: Sequence[str] = (),
    primary_key: str | None = None,
    renames: dict[str, str] | None = None,
    *,
    refuse_empty: bool = False,
) -> DataFrame:
    """One row saying whether a source may be loaded, and why not.

    ``primary_key`` is the target name, so ``renames`` is applied before the key
    is looked up; a key that is absent even then is itself a failure.
    """
    missing = missing_columns(df, required)
    named = df.withColumnsRenamed(renames or {})
    key_absent = primary_key is not None and primary_key not in named.columns
    # Column pruning turns a frame without needed columns into a pure row count.
    rows = named.agg(F.count(F.lit(1)).alias("row_count"))
    if primary_key and not key_absent:
        totals = (
            named.groupBy(primary_key)
            .agg(F.count(F.lit(1)).alias("copies"))
            .agg(
                F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(F.col("copies") > 1, F.col("copies"))), F.lit(0))
                .alias("duplicate_key_rows"),
            )
        )
    else:
        totals = rows.withColumn("duplicate_key_rows", F.lit(0).cast("long"))
    reasons = F.array_compact(
        F.array(
            F.when((F.col("row_count") == 0) & F.lit(refuse_empty), F.lit("Input data is empty")),
            F.lit("Missing required columns" if missing else None).cast("string"),
            F.lit(f"Primary key column absent: {primary_key}" if key_absent else None).cast("string"),
            F.when(F.col("duplicate_key_rows") > 0, F.lit("Duplicate primary keys found")),
        )
    )
    return (
        totals.withColumn("reasons", reasons)
        .select(
            (F.size("reasons") == 0).alias("is_valid"),
            "row_count",
            F.lit(",".join(missing)).alias("missing_columns"),
            "duplicate_key_rows",
            F.when(F.size("reasons") == 0, F.lit("Validation successful."))
            .otherwise(F.concat(F.lit("Validation failed: "), F.concat_ws("; ", "reasons"), F.lit(".")))
            .alias("summary"),
        )
    )


def duplicate_key_rows(df: DataFrame, primary_key: str) -> DataFrame:
    """Every copy of every row whose key occurs more than once."""
    return repeated_keys(require_columns(df, [primary_key]), [primary_key])
