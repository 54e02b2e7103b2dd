"""D-1 / D-2 / D-3 / D-5: what the weekly dashboard shows besides the 14 results.

The reference's dashboard file is not published; these definitions are
ours, written down where the README only names the feature:

* D-1 ``annotate_changes``: each change goes to the closest week that the
  weekly table holds (the earlier one at a tie) and picks up its row.
* D-2 ``sale_overlay``: a week is "in" a sale period when its Monday lies in
  [start, end); overlapping periods list every label.
* D-3 ``site_overview``: per week, session_start events, distinct orders,
  revenue summed over orders (one MAX per order, as the AOV query does),
  and CVR = orders / sessions.
* D-5 ``category_summary``: per category over a date range, sums of the
  additive weekly columns and the CVR recomputed from the sums (distinct
  counts summed over weeks are user-weeks, not users).

Every dimension here (changes, periods) is an argument list: the expanded
side of each join is bounded by it and broadcast; the weekly side is never
collected or cross-joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_week, mondays_in
from ..functions.numeric import money_units, rate, round_half_up, units_to_money
from .asof import nearest_join


def annotate_changes(weekly: DataFrame, changes: DataFrame, week_col: str = "week") -> DataFrame:
    """D-1: (change_date, change_label) + the row of the closest present week, and how many days it lies ahead.

    ``weekly`` must hold one row per week.  A change far from all data gets
    the nearest week there is (``days_ahead`` tells how near); only an empty
    weekly table leaves the columns null and ``week_in_data`` false.
    """
    near = nearest_join(changes.select("change_date", "change_label"), weekly, "change_date", week_col)
    return near.withColumns({"days_ahead": F.datediff(week_col, "change_date"), "week_in_data": F.col(week_col).isNotNull()})


def sale_overlay(weekly: DataFrame, periods: DataFrame, week_col: str = "week") -> DataFrame:
    """D-2: ``in_sale`` and ``sale_labels`` ('; '-joined, sorted) for each weekly row.

    The periods are expanded to their Mondays and aggregated per week on the
    small side (bounded by the period list), then broadcast-joined.
    """
    per_week = (
        periods.select(
            "sale_label",
            F.explode(mondays_in(F.col("sale_start"), F.col("sale_end"))).alias(week_col),
        )
        .groupBy(week_col)
        .agg(F.array_join(F.array_sort(F.collect_set("sale_label")), "; ").alias("sale_labels"))
    )
    return weekly.join(F.broadcast(per_week), week_col, "left").withColumn(
        "in_sale", F.col("sale_labels").isNotNull()
    )


def site_overview(events: DataFrame) -> DataFrame:
    """D-3: per week sessions, orders, revenue (per-order MAX, summed) and CVR.

    Two chained aggregates: (week, event, order) first - hashing the order id
    spreads a hot week - then per week.  Null order ids form one group per
    week, counted in revenue but not in orders (as in the AOV query).
    """
    ev = events.where(F.col("event_name").isin("session_start", "purchase")).select(
        event_week("event_date").alias("week"),
        "event_name",
        F.when(F.col("event_name") == "purchase", F.col("ecommerce.transaction_id")).alias("transaction_id"),
        money_units(F.col("ecommerce.purchase_revenue")).alias("rev_u"),
    )
    per_order = ev.groupBy("week", "event_name", "transaction_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("rev_u").alias("rev_u")
    )
    is_p = F.col("event_name") == "purchase"
    out = per_order.groupBy("week").agg(
        F.coalesce(F.sum(F.when(~is_p, F.col("n"))), F.lit(0)).alias("sessions"),
        F.count_if(is_p & F.col("transaction_id").isNotNull()).alias("transactions"),
        F.sum(F.when(is_p, F.col("rev_u"))).alias("rev_u"),
    )
    return out.select(
        "week",
        "sessions",
        "transactions",
        round_half_up(units_to_money(F.col("rev_u")), 2).alias("revenue"),
        rate(F.col("transactions"), F.col("sessions"), 3).alias("cvr"),
    )


def category_summary(category_weekly: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """D-5: per category over weeks in [start, end]: weeks, sums and recomputed CVR."""
    w = category_weekly
    if start is not None:
        w = w.where(F.col("week") >= F.to_date(F.lit(start)))
    if end is not None:
        w = w.where(F.col("week") <= F.to_date(F.lit(end)))
    out = w.groupBy("category").agg(
        F.count(F.lit(1)).alias("weeks"),
        F.sum("sessions").alias("sessions"),
        F.sum("transactions").alias("transactions"),
        F.sum(money_units(F.col("revenue"))).alias("rev_u"),
        F.sum("add_to_cart").alias("add_to_cart"),
        F.sum("began_checkout").alias("began_checkout"),
    )
    return out.select(
        "category",
        "weeks",
        "sessions",
        "transactions",
        round_half_up(units_to_money(F.col("rev_u")), 2).alias("revenue"),
        "add_to_cart",
        "began_checkout",
        rate(F.col("transactions"), F.col("sessions"), 3).alias("cvr"),
    )
