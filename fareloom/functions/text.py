"""Text normalisation, record hashes and JSON expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def upper_trim(value: str | Column) -> Column:
    """Standard spelling of a master attribute."""
    return F.upper(F.trim(_col(value)))


def blank_to_null(value: str | Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(_col(value)), F.lit(""))


def blank(value: str | Column) -> Column:
    """True for NULL or whitespace-only text."""
    return F.coalesce(F.trim(_col(value)) == "", F.lit(True))


def canonical(key: str, attributes: Sequence[str], *, fold_case: bool = False) -> Column:
    """``key|attr|attr`` with NULL attributes as empty text."""
    parts = []
    for name in attributes:
        text = F.col(name).cast("string")
        parts.append(F.coalesce(F.lower(text) if fold_case else text, F.lit("")))
    return F.concat_ws("|", F.col(key).cast("string"), *parts)


def md5_hash(key: str, attributes: Sequence[str]) -> Column:
    """Record hash of zone-like records."""
    return F.md5(canonical(key, attributes))


def sha256_hash(key: str, attributes: Sequence[str]) -> Column:
    """Record hash of vendor-like records; a change of case alone is no change."""
    return F.sha2(canonical(key, attributes, fold_case=True), 256)


def row_json(columns: Sequence[str], values: Mapping[str, Column] | None = None) -> Column:
    """The named columns as one JSON object; NULL fields are kept. ``values`` replaces some columns' values."""
    given = values or {}
    fields = [given.get(c, F.col(c)).alias(c) for c in columns]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
