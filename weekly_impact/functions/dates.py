"""Date helpers: the Monday week of a ``YYYYMMDD`` string and Monday sequences."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_event_date(c: Column | str) -> Column:
    """``YYYYMMDD`` string -> DATE.

    Eight digits are split into integer parts for ``make_date``
    (codegen'd, no formatter per row, several times cheaper than a pattern
    parse on billions of item rows); anything else goes to the strict
    ``to_date`` parse.  Under ANSI both raise on text that is not a date.
    """
    c = F.col(c) if isinstance(c, str) else c
    parts = [F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2)]
    fast = F.make_date(*[x.cast("int") for x in parts])
    return F.when(c.rlike("^[0-9]{8}$"), fast).otherwise(F.to_date(c, "yyyyMMdd"))


def week_start(c: Column | str) -> Column:
    """Monday on or before the date (``trunc(d, 'week')`` starts weeks on Monday)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.trunc(c, "week")


def event_week(event_date: Column | str = "event_date") -> Column:
    """P-1: Monday week of a ``YYYYMMDD`` event date, as DATE."""
    return week_start(parse_event_date(event_date))


def yyyymmdd(c: Column | str) -> Column:
    """DATE/TIMESTAMP -> ``YYYYMMDD`` text (the event-shard suffix format)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyyMMdd")


def first_monday_on_or_after(d: Column) -> Column:
    """Smallest Monday >= d (``next_day`` is strictly after, hence the -1)."""
    return F.next_day(F.date_sub(d, 1), "Mon")


def mondays_in(start: Column, end_exclusive: Column) -> Column:
    """ARRAY<DATE> of the Mondays in [start, end_exclusive); empty when none."""
    first = first_monday_on_or_after(start)
    last = F.date_sub(end_exclusive, 1)
    return F.when(first > last, F.array().cast("array<date>")).otherwise(
        F.sequence(first, last, F.expr("INTERVAL 7 DAYS"))
    )


def closest_monday(d: Column) -> Column:
    """Monday nearest to d (distances are 0..3 days back or 1..3 ahead; no ties)."""
    back = week_start(d)
    return F.when(F.datediff(d, back) <= 3, back).otherwise(F.date_add(back, 7))
