"""Sums and averages whose result does not depend on row order.

Adding doubles gives a different last digit for every partitioning. A value that
``decimal(38, 18)`` holds exactly is added as one; the total has room for 10**12
values of ``EXACT_LIMIT``. All others (finer, larger, infinite, NaN) are added as
doubles, so no value is rounded or left out.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT_TYPE = "decimal(38,18)"
EXACT_LIMIT = 1e7


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _is_exact(number: Column) -> Column:
    same = number.try_cast(EXACT_TYPE).cast("double") == number
    return F.coalesce((F.abs(number) < EXACT_LIMIT) & same, F.lit(False))


def exact_units(value: str | Column) -> Column:
    """The value as a decimal, or NULL when it is not exactly addable."""
    number = _col(value).cast("double")
    return F.when(_is_exact(number), number.try_cast(EXACT_TYPE))


def exact_rest(value: str | Column) -> Column:
    """The values :func:`exact_units` leaves out (finer ones, NaN, infinity, huge numbers)."""
    number = _col(value).cast("double")
    return F.when(number.isNotNull() & ~_is_exact(number), number)


def total_of(units: Column, rest: Column) -> Column:
    """Combine summed units and summed rest into one double."""
    exact = units.cast("double")
    return F.when(rest.isNull(), exact).otherwise(F.coalesce(exact, F.lit(0.0)) + rest)


def exact_sum(value: str | Column) -> Column:
    """``sum`` as a double, independent of row order."""
    return total_of(F.sum(exact_units(value)), F.sum(exact_rest(value)))


def exact_avg(value: str | Column) -> Column:
    """``avg`` as exact sum over the count of non-null values."""
    return exact_sum(value) / F.nullif(F.count(_col(value)), F.lit(0)).cast("double")


def weighted_sum(value: str | Column, times: str | Column) -> Column:
    """:func:`exact_sum` of values that each occur a number of times (below 10**12).

    Seven digits before the point, 18 after it and 12 of the number fit a decimal.
    """
    units = exact_units(value).cast("decimal(25,18)") * _col(times).cast("decimal(12,0)")
    return total_of(F.sum(units), F.sum(exact_rest(value) * _col(times)))


def money(value: str | Column) -> Column:
    """``decimal(10,2)``; a value that does not fit becomes NULL instead of failing."""
    return _col(value).try_cast("decimal(10,2)")


def money_sum(value: str | Column) -> Column:
    """Sum of a ``decimal(10,2)`` column as ``decimal(24,2)``: room for 10**14 rows of the largest amount.

    The sum itself has 38 digits, and a mean of it keeps 16 decimals.
    """
    return F.sum(_col(value).cast("decimal(28,2)")).cast("decimal(24,2)")


def money_mean(value: str | Column, digits: int) -> Column:
    """Weighted mean of a ``decimal(10,2)`` column: sum over row count, rounded half up."""
    return F.round(money_sum(value) / F.nullif(F.count(F.lit(1)), F.lit(0)), digits)
