"""Date and time expressions on wall-clock timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def wall_clock(value: str | Column) -> Column:
    """Any timestamp, date or text as a timestamp without zone; unparsable text is NULL."""
    return _col(value).try_cast("timestamp_ntz")


def date_key(value: str | Column) -> Column:
    """Calendar key as an integer, 2025-01-31 -> 20250131."""
    day = _col(value)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def elapsed_seconds(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in seconds as a double, with microseconds kept."""
    gap = _col(end) - _col(start)
    return gap.cast("interval second").cast("decimal(18,6)").cast("double")


def elapsed_minutes(start: str | Column, end: str | Column) -> Column:
    """``end - start`` in minutes as a double."""
    return elapsed_seconds(start, end) / F.lit(60.0)


def calendar_columns(day: str = "full_date") -> list[Column]:
    """The eight calendar attributes of a date column; Sunday is day 1."""
    d = F.col(day)
    return [
        date_key(d).alias("date_key"),
        d.alias("full_date"),
        F.year(d).cast("short").alias("year"),
        F.month(d).cast("short").alias("month"),
        F.dayofmonth(d).cast("short").alias("day"),
        F.dayofweek(d).cast("short").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    ]
