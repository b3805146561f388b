"""Cleaning of reference files: zones and vendors."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fareloom.functions.text import blank_to_null, md5_hash, sha256_hash, upper_trim
from fareloom.operators.contract import require_columns
from fareloom.operators.dedupe import keep_one

# Zone columns, the filler text and accepted vendor headings.
ZONE_ATTRIBUTES = ("borough", "zone", "service_zone")
FILLER = "Unknown"
VENDOR_NAME_ALIASES = ("VendorName", "vendor", "name")


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def trim_strings(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim text columns (all of them, or the named ones that exist); blanks stay blank.

    A name that the frame lacks is left out with a warning.
    """
    wanted = string_columns(df) if columns is None else [c for c in columns if c in df.columns]
    unknown = [c for c in columns or () if c not in df.columns]
    if unknown:
        warnings.warn(f"columns to trim that are not there: {unknown}; found {df.columns}", stacklevel=2)
    return df.withColumns({c: F.trim(F.col(c)) for c in wanted})


def blank_strings_to_null(df: DataFrame) -> DataFrame:
    """Trim every text column and turn what is blank into NULL."""
    return df.withColumns({c: blank_to_null(c) for c in string_columns(df)})


def rename(df: DataFrame, mapping: dict[str, str] | None) -> DataFrame:
    """Rename by mapping; no mapping, no change."""
    return df.withColumnsRenamed(mapping) if mapping else df


def fill_unknown(df: DataFrame, columns: Sequence[str] = ZONE_ATTRIBUTES) -> DataFrame:
    """NULL or empty text becomes ``Unknown`` in the columns that exist."""
    return df.withColumns(
        {
            c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(FILLER))
            for c in columns
            if c in df.columns
        }
    )


def clean_reference(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """Distinct rows, then rename, trim and fill.

    The distinct comes first, so rows that differ only in whitespace survive.
    """
    return fill_unknown(trim_strings(rename(df.dropDuplicates(), mapping)))


def standardise_and_hash(
    df: DataFrame,
    key: str = "location_id",
    attributes: Sequence[str] = ZONE_ATTRIBUTES,
    key_type: str = "int",
) -> DataFrame:
    """Integer key, upper-cased trimmed attributes and an MD5 over all of them."""
    require_columns(df, [key, *attributes])
    standard = df.select(
        F.col(key).try_cast(key_type).alias(key), *[upper_trim(c).alias(c) for c in attributes]
    )
    return standard.withColumn("record_hash", md5_hash(key, attributes))


def _vendor_columns(df: DataFrame) -> DataFrame:
    """Vendor rows under standard headings, tidied, the id as a number."""
    if "VendorID" not in df.columns and "vendor_id" in df.columns:
        df = df.withColumnRenamed("vendor_id", "VendorID")
    if "vendor_name" not in df.columns:
        found = [alias for alias in VENDOR_NAME_ALIASES if alias in df.columns]
        if found:
            df = df.withColumnRenamed(found[0], "vendor_name")
    require_columns(df, ["VendorID", "vendor_name"])
    return blank_strings_to_null(df).withColumn("VendorID", F.col("VendorID").try_cast("int"))


def _is_vendor() -> Column:
    return F.col("VendorID").isNotNull() & F.col("vendor_name").isNotNull()


def clean_vendors(df: DataFrame) -> DataFrame:
    """Vendor rows under standard headings, one per id, with id and name present.

    Where an id is repeated the alphabetically first row wins, so the survivor is
    the same on every run.
    """
    return keep_one(_vendor_columns(df).filter(_is_vendor()), ["VendorID"], ["vendor_name"])


def vendor_accounts(df: DataFrame) -> DataFrame:
    """What :func:`clean_vendors` does with the rows: read, without id or name, repeated, processed."""
    rows = _vendor_columns(df).groupBy(F.when(_is_vendor(), F.col("VendorID")).alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    known = F.col("_id").isNotNull()

    def total(value: Column) -> Column:
        return F.coalesce(F.sum(value), F.lit(0))

    return rows.agg(
        total(F.col("_rows")).alias("records_read"),
        total(F.when(~known, F.col("_rows"))).alias("invalid_removed"),
        total(F.when(known, F.col("_rows") - 1)).alias("duplicates_removed"),
        F.count_if(known).alias("records_processed"),
    )


def hash_vendors(df: DataFrame) -> DataFrame:
    """Add the SHA-256 record hash; without a name column the name is NULL."""
    if "vendor_name" not in df.columns:
        df = df.withColumn("vendor_name", F.lit(None).cast("string"))
    return df.withColumn("record_hash", sha256_hash("VendorID", ["vendor_name"]))
