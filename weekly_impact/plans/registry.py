"""``queries()`` registry: key -> f(spark, sf_dir) over the driver's test tables.

Every entry reads the given tables through the fixed test mapping
(:mod:`weekly_impact.sources.fixtures`) and runs over them whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixtures
from . import extras as X
from . import queries as Q
from .params import FIXTURE_PARAMS, FIXTURE_SCAN_WINDOW, Params

QueryFn = Callable[[SparkSession, str], DataFrame]


def item_events(spark: SparkSession, sf_dir: str, p: Params = FIXTURE_PARAMS) -> DataFrame:
    return fixtures.item_events(spark, sf_dir, start=min(p.start, p.start_recent), end=p.end)


def site_events(spark: SparkSession, sf_dir: str, p: Params = FIXTURE_PARAMS) -> DataFrame:
    return fixtures.site_events(spark, sf_dir, start=min(p.start, p.start_recent), end=p.end)


def _items(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(item_events(spark, sf_dir), FIXTURE_PARAMS)


def _items_s(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(spark, item_events(spark, sf_dir), FIXTURE_PARAMS)


def _site(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(site_events(spark, sf_dir), FIXTURE_PARAMS)


def _site_s(fn) -> QueryFn:
    return lambda spark, sf_dir: fn(spark, site_events(spark, sf_dir), FIXTURE_PARAMS)


# The 14 end-to-end queries of the reference.
CORE_QUERIES: dict[str, QueryFn] = {
    "category_weekly": _items(Q.category_weekly),
    "subcategory_weekly": _items(Q.subcategory_weekly),
    "product_weekly": _items(Q.product_weekly),
    "funnel_weekly": _site(Q.funnel_weekly),
    "aov_weekly": _items(Q.aov_weekly),
    "units_per_tx": _items(Q.units_per_tx),
    "change_impact": _items_s(Q.change_impact),
    "change_impact_subcategory": _items_s(Q.change_impact_subcategory),
    "change_impact_product": _items_s(Q.change_impact_product),
    "category_funnel": _items(Q.category_funnel),
    "subcategory_funnel": _items(Q.subcategory_funnel),
    "product_funnel": _items(Q.product_funnel),
    "delivery_tier_weekly": _items(Q.delivery_tier_weekly),
    "funnel_change_impact": _site_s(Q.funnel_change_impact),
}


def all_events(spark: SparkSession, sf_dir: str, p: Params = FIXTURE_PARAMS) -> DataFrame:
    """Both mapped event sets as one GA4-shaped table (orders' funnel + site events)."""
    return item_events(spark, sf_dir, p).unionByName(site_events(spark, sf_dir, p))


DASHBOARD_QUERIES: dict[str, QueryFn] = {
    "annotate_changes": lambda spark, d: X.annotate_changes_q(spark, all_events(spark, d), FIXTURE_PARAMS),
    "sale_overlay": lambda spark, d: X.sale_overlay_q(spark, all_events(spark, d), FIXTURE_PARAMS),
    "site_overview": lambda spark, d: X.site_overview_q(all_events(spark, d)),
    "step_dropoff": _site(X.step_dropoff_q),
    "category_summary": _items(X.category_summary_q),
}

# The reference's relational and scalar operators, one query each.
PRIMITIVE_QUERIES: dict[str, QueryFn] = {
    "week_bucket": _items(X.week_bucket_q),
    "explode_items": _items(X.explode_items_q),
    "event_param": _site(X.event_param_q),
    "clean_categories": _items(X.clean_categories_q),
    "top_products": _items(X.top_products_q),
    "topk_semi_join": _items(X.topk_semi_join_q),
    "range_join_changes": _site_s(X.range_join_changes_q),
    "anchor_left_join": _items(X.anchor_left_join_q),
    "order_dedup": _items(X.order_dedup_q),
    "before_after_union": _site_s(X.before_after_union_q),
    "assign_tier": _items(X.assign_tier_q),
    "assign_tier_table": _items_s(X.assign_tier_table_q),
    "approx_viewers": _items(X.approx_viewers_q),
    "iso_dates": _site(X.iso_dates_q),
    "json_sink": _site_s(X.json_sink_q),
    "funnel_weekly_stream": _site_s(X.funnel_weekly_stream_q),
    "scan_events": lambda spark, d: X.scan_events_q(
        spark, site_events(spark, d), FIXTURE_PARAMS, *FIXTURE_SCAN_WINDOW
    ),
}


def all_queries() -> dict[str, QueryFn]:
    return {**CORE_QUERIES, **DASHBOARD_QUERIES, **PRIMITIVE_QUERIES}
