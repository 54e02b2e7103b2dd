"""C-4 / R-5 / U-1: four-week averages before and after dated changes.

A change at date d compares the weeks starting in [d-28, d) with those in
[d, d+28).  Week keys are Mondays, and any 28-day half-open span holds
exactly four Mondays, so each change expands to eight (week, period) rows.
The range condition of the reference (a cross join plus a date test) thus
becomes an *equi*-join on ``week`` (and ``category`` once the affected list
is exploded): a broadcast hash join whose small side is bounded by the
argument list (changes x categories x 8), never a nested loop.

Averages run over the weeks present: a missing week is not zero.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import mondays_in
from ..functions.numeric import mean
from ..sources.dimensions import Change

BEFORE = "before"
AFTER = "after"


def window_shards(changes: Sequence[Change], days: int = 28) -> list[tuple[str, str]]:
    """First and last ``YYYYMMDD`` day of the weeks that start within ``days`` of a change; overlapping spans are merged.

    A week belongs to a window by its Monday, so a span runs from the first
    Monday on or after date - days to the Sunday after the last Monday before
    date + days.
    """
    week = _dt.timedelta(days=7)
    spans = []
    for c in changes:
        day = _dt.date.fromisoformat(c.date)
        first = day - _dt.timedelta(days=days)
        first += _dt.timedelta(days=-first.weekday() % 7)
        last = day + _dt.timedelta(days=days - 1)
        last -= _dt.timedelta(days=last.weekday())
        if first <= last:
            spans.append((first, last + week - _dt.timedelta(days=1)))
    out: list[tuple[_dt.date, _dt.date]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1] + _dt.timedelta(days=1):
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return [(a.strftime("%Y%m%d"), z.strftime("%Y%m%d")) for a, z in out]


def in_windows(changes: Sequence[Change], days: int = 28, col: str = "event_date") -> Column:
    """Shard filter: the days of the weeks that a change's windows hold.

    The week of a row is computed from its shard, so no optimizer rule can
    find the shards that a join on the week keeps; as ranges of the shard
    column itself they are a partition filter, and other days are never read.
    """
    cond = F.lit(False)
    for a, z in window_shards(changes, days):
        cond = cond | F.col(col).between(a, z)
    return cond


def change_weeks(changes: DataFrame, days: int = 28, by_category: bool = False) -> DataFrame:
    """(change_date, change_label, week, period[, category]) for every Monday in the window.

    A week starting before the change date is "before", so the week holding a
    mid-week change counts as before, as in the reference.
    """
    d = F.col("change_date")
    cw = changes.select(
        "change_date",
        "change_label",
        "affected_categories",
        F.explode(mondays_in(F.date_sub(d, days), F.date_add(d, days))).alias("week"),
    ).withColumn("period", F.when(F.col("week") < d, F.lit(BEFORE)).otherwise(F.lit(AFTER)))
    if by_category:
        cw = cw.select("*", F.explode(F.array_distinct("affected_categories")).alias("category"))
    return cw.drop("affected_categories")


def range_join_changes(weekly: DataFrame, changes: DataFrame, days: int = 28, category_col: str | None = None) -> DataFrame:
    """R-5: weekly rows x the changes whose window holds the week (one row per pair).

    A week inside two overlapping windows pairs with both changes.
    """
    cw = change_weeks(changes, days, by_category=category_col is not None)
    on = ["week"]
    if category_col is not None:
        cw = cw.withColumnRenamed("category", category_col)
        on.append(category_col)
    return weekly.join(F.broadcast(cw), on, "inner")


def _avg_in(period: str, value: Column, divisor: float) -> Column:
    avg = mean(F.when(F.col("period") == period, value))
    return avg if divisor == 1 else avg / F.lit(float(divisor))


def before_after(
    weekly: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    measures: Sequence[tuple[str, str, float]],
    category_col: str | None = "category",
    days: int = 28,
    require: Sequence[str] = ("rev",),
) -> DataFrame:
    """C-4: per (change_label, keys): ``avg_<m>_before`` / ``avg_<m>_after`` (unrounded).

    ``measures`` are (name, column, divisor): integer-valued columns (counts,
    cents, hundredths) averaged exactly and scaled back by ``divisor``.  With
    ``category_col`` set, a change applies only to its affected categories.
    Groups lacking either average of every ``require`` measure are dropped.
    """
    joined = range_join_changes(weekly, changes, days, category_col)
    aggs = []
    for name, column, div in measures:
        aggs.append(_avg_in(BEFORE, F.col(column), div).alias(f"avg_{name}_before"))
        aggs.append(_avg_in(AFTER, F.col(column), div).alias(f"avg_{name}_after"))
    out = joined.groupBy("change_label", *keys).agg(*aggs)
    for r in require:
        out = out.where(F.col(f"avg_{r}_before").isNotNull() & F.col(f"avg_{r}_after").isNotNull())
    return out


def period_averages(
    weekly: DataFrame,
    changes: DataFrame,
    measures: Sequence[str],
    days: int = 28,
) -> DataFrame:
    """Per (change_label, period): AVG of each measure over the window's weeks (one join)."""
    joined = range_join_changes(weekly, changes, days)
    return joined.groupBy("change_label", "period").agg(*[mean(F.col(m)).alias(m) for m in measures])


def before_after_union(
    weekly: DataFrame,
    changes: DataFrame,
    measures: Sequence[str],
    days: int = 28,
) -> DataFrame:
    """U-1: the reference's shape, one join and aggregate per period, UNION ALL by name."""
    cw = change_weeks(changes, days)
    parts = []
    for period in (BEFORE, AFTER):
        side = F.broadcast(cw.where(F.col("period") == period).select("change_label", "week"))
        agg = weekly.join(side, "week", "inner").groupBy("change_label").agg(*[mean(F.col(m)).alias(m) for m in measures])
        parts.append(agg.select("change_label", F.lit(period).alias("period"), *measures))
    return parts[0].unionByName(parts[1])
