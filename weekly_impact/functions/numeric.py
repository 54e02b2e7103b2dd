"""Numeric helpers shared by every query.

Money is summed as ``decimal(38,18)``: the last digit lies below a double's
own precision for any amount over 0.001, so no digit of a price is lost, and
decimal sums are exact whatever the partitioning and order.  Rounding goes
through one helper so that Spark and the DuckDB oracle round identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_TYPE = "decimal(38,18)"


def money_units(c: Column) -> Column:
    """Double amount -> wide decimal.

    Null stays null.  NaN, infinities and amounts of 1e20 and over are no
    money: they become null too, so they add nothing to a sum and do not count
    in a mean, instead of ending the query.
    """
    return c.try_cast(MONEY_TYPE)


def units_to_money(c: Column) -> Column:
    """Wide decimal -> the nearest double."""
    return c.cast("double")


def round_half_up(c: Column, digits: int) -> Column:
    """ROUND half away from zero on the decimal value of ``c``, as a double.

    Casting to decimal(38,10) first absorbs binary noise below 1e-10, so a
    value like 1.015 (stored as 1.01499999...) rounds to 1.02 in both Spark
    and DuckDB.
    """
    return F.round(c.cast("decimal(38,10)"), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """SAFE_DIVIDE: null when the divisor is zero or null (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def rate(num: Column, den: Column, digits: int, scale: float = 100.0) -> Column:
    """ROUND(SAFE_DIVIDE(num, den) * 100, digits)."""
    return round_half_up(safe_div(num, den) * F.lit(scale), digits)


def pct_change(after: Column, before: Column, digits: int = 1) -> Column:
    """ROUND(SAFE_DIVIDE(after - before, before) * 100, digits), on unrounded inputs."""
    return round_half_up(safe_div(after - before, before) * F.lit(100.0), digits)


def mean(c: Column) -> Column:
    """AVG as an exact SUM / COUNT: integer inputs are summed as longs, so the
    result does not depend on partitioning or summation order (null when no
    non-null value)."""
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))
