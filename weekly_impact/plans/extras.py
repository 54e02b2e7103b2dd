"""Registered queries beyond the 14: dashboard operators (D-1..D-5) and the
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.categories import category_is_clean, not_blank
from ..functions.dates import event_week
from ..functions.numeric import money_units, units_to_money
from ..functions.params import event_param
from ..functions.tiers import assign_tier, assign_tier_from_table, tier_table
from ..operators.funnel import FUNNEL_STEPS, funnel_counts, step_dropoff
from ..operators.impact import before_after_union, range_join_changes
from ..operators.items import explode_items, item_fact
from ..operators.orders import order_dedup
from ..operators.overlay import annotate_changes, category_summary, sale_overlay, site_overview
from ..operators.sketches import distinct_sketch, estimate, relative_error, unite_sketches
from ..operators.topk import top_k, topk_semi_join
from ..operators.weekly import anchor_left_join, distinct, rows
from ..session import materialize, scratch_path
from ..sources.dimensions import changes_df, sale_periods_df
from ..sources.events import read_events, write_events
from ..sources.sinks import iso_dates, write_result
from . import queries as Q
from .params import Params


# --- D-1 .. D-5 ------------------------------------------------------------------


def site_overview_q(events: DataFrame) -> DataFrame:
    """D-3 over every event (item-mapped orders and site events together)."""
    return site_overview(events).orderBy("week")


def annotate_changes_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """D-1: each impact change on its closest week of the site overview."""
    return annotate_changes(site_overview(events), changes_df(spark, p.changes)).orderBy("change_date")


def sale_overlay_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """D-2: site overview weeks flagged with the sale periods they fall in."""
    return sale_overlay(site_overview(events), sale_periods_df(spark, p.sale_periods)).orderBy("week")


def step_dropoff_q(events: DataFrame, p: Params) -> DataFrame:
    """D-4: per-week step rates and drop-offs of the site funnel."""
    return step_dropoff(funnel_counts(Q.scoped(events, p.start, p))).orderBy("week")


def category_summary_q(events: DataFrame, p: Params) -> DataFrame:
    """D-5: per-category totals of the category weekly table over its whole range."""
    return category_summary(Q.category_weekly(events, p)).orderBy("category")


# --- primitives ------------------------------------------------------------------


def week_bucket_q(events: DataFrame, p: Params) -> DataFrame:
    """P-1: every event date with its Monday week and event count."""
    ev = Q.scoped(events, p.start, p)
    return ev.groupBy("event_date").agg(F.count(F.lit(1)).alias("events")).select(
        "event_date", event_week("event_date").alias("week"), "events"
    ).orderBy("event_date")


def explode_items_q(events: DataFrame, p: Params) -> DataFrame:
    """R-2: item rows, units and revenue per event name after the inner unnest."""
    x = explode_items(Q.scoped(events, p.start, p).select("event_name", "items"))
    return x.groupBy("event_name").agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.sum(F.col("item.quantity")).alias("units"),
        Q.money2(F.sum(money_units(F.col("item.price") * F.col("item.quantity")))).alias("revenue"),
    ).orderBy("event_name")


def event_param_q(events: DataFrame, p: Params) -> DataFrame:
    """P-5: per week, events, events carrying ``ga_session_id`` and distinct sessions."""
    ev = Q.scoped(events, p.start, p).select(
        event_week("event_date").alias("week"), event_param("ga_session_id").alias("session_id")
    )
    return ev.groupBy("week").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("session_id").alias("with_session"),
        F.count_distinct("session_id").alias("sessions"),
    ).orderBy("week")


def clean_categories_q(events: DataFrame, p: Params) -> DataFrame:
    """F-3: per raw category value, item rows kept by each filter variant."""
    fact = item_fact(Q.scoped(events, p.start, p))
    clean = category_is_clean(F.col("category"), p.blocklist)
    return fact.groupBy("category").agg(
        F.count(F.lit(1)).alias("item_rows"),
        F.count_if(not_blank(F.col("category")) & clean).alias("kept_by_category"),
        F.count_if(not_blank(F.col("subcategory")) & clean).alias("kept_by_subcategory"),
    ).orderBy("category")


def top_products_q(events: DataFrame, p: Params) -> DataFrame:
    """C-3 / O-2: the product-weekly top-K list with its ranking metric."""
    fact = item_fact(Q.scoped(events, p.start, p), ["purchase"]).where(F.col("product_name").isNotNull())
    purchases = fact.groupBy("week", *Q.PRODUCT_KEYS).agg(Q.money2(F.sum("item_rev_u")).alias("revenue"))
    return Q.top_products_by_revenue(purchases, p.top_products).orderBy(
        F.col("revenue_cents").desc_nulls_last(), "product_name"
    )


def topk_semi_join_q(events: DataFrame, p: Params) -> DataFrame:
    """R-3: purchase item rows of the top products by orders, per product."""
    fact = item_fact(Q.scoped(events, p.start_recent, p), ["purchase"]).where(F.col("product_name").isNotNull())
    top = top_k(fact, "product_name", F.count_distinct("transaction_id"), p.top_units, "orders")
    kept = topk_semi_join(fact, top, "product_name")
    return kept.groupBy("product_name").agg(
        F.count(F.lit(1)).alias("item_rows"), F.sum("quantity").alias("units")
    ).orderBy("product_name")


def range_join_changes_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """R-5: weekly site funnel rows paired with every change window holding them."""
    weekly = funnel_counts(Q.windowed(events, p.start_recent, p, p.funnel_changes))
    j = range_join_changes(weekly, changes_df(spark, p.funnel_changes), p.window_days)
    return j.select("change_label", "period", "week", *[c for _, c in FUNNEL_STEPS]).orderBy(
        "change_label", "week"
    )


def anchor_left_join_q(events: DataFrame, p: Params) -> DataFrame:
    """R-1: Q1 in the reference's literal shape (anchor CTE + LEFT JOIN chain)."""
    fact = Q.sales_fact(events, p, p.start, Q.SALES_EVENTS, "category")
    j = anchor_left_join(
        fact,
        ["category"],
        distinct("sessions", "view_item", "user_pseudo_id"),
        [
            (distinct("transactions", "purchase", "transaction_id"), ["category"]),
            (Q.total("_rev_u", "purchase", "item_rev_u"), ["category"]),
            (rows("add_to_cart", "add_to_cart"), ["category"]),
            (distinct("began_checkout", "begin_checkout", "user_pseudo_id"), ["category"]),
        ],
    )
    tx = F.coalesce(F.col("transactions"), F.lit(0))
    return j.select(
        "week",
        "category",
        "sessions",
        tx.alias("transactions"),
        F.coalesce(Q.money2(F.col("_rev_u")), F.lit(0.0)).alias("revenue"),
        F.coalesce(F.col("add_to_cart"), F.lit(0)).alias("add_to_cart"),
        F.coalesce(F.col("began_checkout"), F.lit(0)).alias("began_checkout"),
        Q.rate(tx, F.col("sessions"), 3).alias("cvr"),
    ).orderBy("week", "category")


def order_dedup_q(events: DataFrame, p: Params) -> DataFrame:
    """A-7: one row per (week, category, order) with the order's MAX revenue."""
    fact = Q.sales_fact(events, p, p.start_recent, ["purchase"], "category")
    return order_dedup(fact, ["category"]).select(
        "week", "category", "transaction_id", units_to_money(F.col("order_rev_u")).alias("order_revenue")
    )


def before_after_union_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """U-1: Q14 through two joins and UNION ALL (the reference's shape)."""
    weekly = funnel_counts(Q.windowed(events, p.start_recent, p, p.funnel_changes))
    avgs = before_after_union(weekly, changes_df(spark, p.funnel_changes), Q.FUNNEL_MEASURES, p.window_days)
    return Q.funnel_impact_output(avgs)


def assign_tier_q(events: DataFrame, p: Params) -> DataFrame:
    """E-5: item rows per (tier, subcategory, category) under the ordered rules."""
    fact = Q.sales_fact(events, p, p.start_recent, Q.SALES_EVENTS, "category")
    tiered = fact.withColumn("delivery_tier", assign_tier(p.tiers, p.default_tier))
    return tiered.groupBy("delivery_tier", "subcategory", "category").agg(
        F.count(F.lit(1)).alias("item_rows")
    ).orderBy("delivery_tier", "subcategory", "category")


def assign_tier_table_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """E-5 from a stored table of rules instead of a CASE expression."""
    rules = materialize(tier_table(spark, p.tiers), "tier-rules")
    fact = Q.sales_fact(events, p, p.start_recent, Q.SALES_EVENTS, "category", ["subcategory"])
    tiered = assign_tier_from_table(fact, rules, tuple(dict.fromkeys(r.column for r in p.tiers)), p.default_tier)
    return tiered.groupBy("delivery_tier", "subcategory", "category").agg(
        F.count(F.lit(1)).alias("item_rows")
    ).orderBy("delivery_tier", "subcategory", "category")


def approx_viewers_q(events: DataFrame, p: Params) -> DataFrame:
    """A-2: distinct viewers per (week, category) and per category over all weeks, exact and from united sketches."""
    fact = Q.sales_fact(events, p, p.start_recent, ["view_item"], "category", [])
    grain = materialize(fact.groupBy("week", "category", "user_pseudo_id").agg(F.count(F.lit(1)).alias("n")), "viewers")
    weekly = materialize(distinct_sketch(grain, ["week", "category"], "user_pseudo_id"), "sketches")
    every = unite_sketches(weekly, ["category"])
    exact = [
        grain.groupBy("week", "category").agg(F.count("user_pseudo_id").alias("viewers")),
        grain.groupBy("category").agg(F.count_distinct("user_pseudo_id").alias("viewers")).withColumn("week", F.lit(None).cast("date")),
    ]
    told = exact[0].join(weekly, ["week", "category"]).select("week", "category", "viewers", estimate().alias("estimate")).unionByName(
        exact[1].join(every, "category").select("week", "category", "viewers", estimate().alias("estimate")))
    off = F.abs(F.col("estimate") - F.col("viewers"))
    return told.withColumn("within_error", off <= F.col("viewers") * F.lit(relative_error()) + 0.5).orderBy("category", "week")


def iso_dates_q(events: DataFrame, p: Params) -> DataFrame:
    """S-6: the site funnel with its week as ISO text."""
    return iso_dates(Q.funnel_weekly(events, p))


JSON_FUNNEL_SCHEMA = T.StructType(
    [T.StructField("week", T.StringType())] + [T.StructField(c, T.LongType()) for _, c in FUNNEL_STEPS]
)


def json_sink_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """S-7: the site funnel written as JSON lines to the shared folder and read back."""
    path = scratch_path(spark, "json-sink")
    write_result(Q.funnel_weekly(events, p), path, fmt="json")
    return spark.read.schema(JSON_FUNNEL_SCHEMA).json(path).orderBy("week")


def scan_events_q(spark: SparkSession, events: DataFrame, p: Params, start: str, end: str) -> DataFrame:
    """S-1 / S-2: events written as daily shards, then scanned with shard pruning."""
    path = scratch_path(spark, "event-shards")
    write_events(events, path)
    scanned = read_events(spark, path, start, end)
    return scanned.groupBy("event_date", "event_name").agg(F.count(F.lit(1)).alias("events")).orderBy(
        "event_date", "event_name"
    )


def funnel_weekly_stream_q(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Q4 by incremental refresh: shards written, refreshed, rewritten under their names, refreshed again, read back."""
    from ..streaming.funnel_stream import read_weekly_funnel, refresh_weekly_funnel

    shards = scratch_path(spark, "stream-shards")
    table, state = scratch_path(spark, "stream-funnel"), scratch_path(spark, "stream-state")
    write_events(events, shards)
    refresh_weekly_funnel(spark, shards, table, state, p.start, p.end)
    write_events(events, shards)
    refresh_weekly_funnel(spark, shards, table, state, p.start, p.end)
    return read_weekly_funnel(spark, table).orderBy("week")


__all__ = [
    "funnel_weekly_stream_q",
    "anchor_left_join_q",
    "annotate_changes_q",
    "approx_viewers_q",
    "assign_tier_table_q",
    "assign_tier_q",
    "before_after_union_q",
    "category_summary_q",
    "clean_categories_q",
    "event_param_q",
    "explode_items_q",
    "iso_dates_q",
    "json_sink_q",
    "order_dedup_q",
    "range_join_changes_q",
    "sale_overlay_q",
    "scan_events_q",
    "site_overview_q",
    "step_dropoff_q",
    "top_products_q",
    "topk_semi_join_q",
    "week_bucket_q",
]
