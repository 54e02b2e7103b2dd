"""A full refresh: the 14 results, the items unnested once, published as one set.

The reference submits its 14 statements one after another, each scanning
and unnesting the event table again.  Here the item fact (one row per
event-item, all four item events, only the fields the queries use) is
written once as a Parquet table under the session's checkpoint folder, one
folder per event name (the purchase queries never decode view rows), and
the twelve item queries read it, five of them (Q1, Q2, Q10, Q11, Q13) through
one grain of weeks, segments, events and users or orders that is written once;
the two site-funnel queries read the events' names and dates directly (no unnest).

Besides the 14 results a refresh writes the dashboard's overlays on the site
funnel and the run record.  All of it goes into a new version folder that one
atomic rename makes current (see :mod:`weekly_impact.sources.publish`); a
refresh that fails leaves the old set, and no scratch table behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import event_week
from ..operators.impact import period_averages
from ..operators.items import item_fact
from ..operators.overlay import annotate_changes, sale_overlay
from ..session import materialize_sized, scratch_scope
from ..sources.dimensions import changes_df, sale_periods_df
from ..sources.events import shard_filter
from ..sources.publish import Publication
from ..sources.sinks import run_metadata, write_result
from . import queries as Q
from .params import Params

ITEM_EVENTS = ["purchase", "add_to_cart", "view_item", "begin_checkout"]
OVERLAYS = ["annotated_changes", "sale_weeks", "meta"]


def item_results(spark: SparkSession, fact: DataFrame, grain: DataFrame, p: Params) -> dict[str, DataFrame]:
    """The twelve results over items, from the stored fact and the stored segment grain."""
    return {
        "category_weekly": Q.category_weekly(fact, p, grain),
        "subcategory_weekly": Q.subcategory_weekly(fact, p, grain),
        "product_weekly": Q.product_weekly(fact, p),
        "aov_weekly": Q.aov_weekly(fact, p),
        "units_per_tx": Q.units_per_tx(fact, p),
        "change_impact": Q.change_impact(spark, fact, p),
        "change_impact_subcategory": Q.change_impact_subcategory(spark, fact, p),
        "change_impact_product": Q.change_impact_product(spark, fact, p),
        "category_funnel": Q.category_funnel(fact, p, grain),
        "subcategory_funnel": Q.subcategory_funnel(fact, p, grain),
        "product_funnel": Q.product_funnel(fact, p),
        "delivery_tier_weekly": Q.delivery_tier_weekly(fact, p, grain),
    }


def refresh_results(spark: SparkSession, events: DataFrame, p: Params) -> dict[str, DataFrame]:
    """The 14 result DataFrames, with the item fact materialized once."""
    start = min(p.start, p.start_recent)
    fact = materialize_sized(item_fact(events.where(shard_filter(start, p.end)), ITEM_EVENTS), "item-fact", ("event_name",))
    grain = materialize_sized(Q.segment_grain(fact, p), "segment-grain")
    return {
        **item_results(spark, fact, grain, p),
        "funnel_weekly": Q.funnel_weekly(events, p),
        "funnel_change_impact": Q.funnel_change_impact(spark, events, p),
    }


def overlays(spark: SparkSession, funnel_weekly: DataFrame, p: Params) -> dict[str, DataFrame]:
    """D-1 and D-2 on the site funnel's weeks, and S-8, the run record that a dashboard reads first."""
    return {
        "annotated_changes": annotate_changes(funnel_weekly, changes_df(spark, p.delivery_changes)).orderBy("change_date", "change_label"),
        "sale_weeks": sale_overlay(funnel_weekly, sale_periods_df(spark, p.sale_periods)).orderBy("week"),
        "meta": run_metadata(spark, p.project_id, p.delivery_changes, p.sale_periods, p.current_tiers),
    }


def publish_results(spark: SparkSession, results: dict[str, DataFrame], out_dir: str, p: Params, fmt: str = "json") -> list[str]:
    """Write every result and the overlays into a new version of ``out_dir`` and make it current; the names written."""
    out = Publication(spark, out_dir)
    version = out.stage()
    try:
        for name, df in results.items():
            write_result(df, out.path(name, version), fmt=fmt)
        weeks = spark.read.schema(results["funnel_weekly"].schema).format(fmt).load(out.path("funnel_weekly", version))
        more = overlays(spark, weeks, p)
        for name, df in more.items():
            write_result(df, out.path(name, version), fmt=fmt)
    except BaseException:
        out.abandon(version)
        raise
    out.swap(version)
    return [*results, *more]


def refresh(spark: SparkSession, events: DataFrame, out_dir: str, p: Params, fmt: str = "json") -> list[str]:
    """Publish all results of ``events`` under ``out_dir``; returns the names written."""
    with scratch_scope(spark):
        return publish_results(spark, refresh_results(spark, events, p), out_dir, p, fmt)


def funnel_impact_from_weeks(spark: SparkSession, weekly: DataFrame, p: Params) -> DataFrame:
    """Q14 from stored weekly counts."""
    return Q.funnel_impact_output(period_averages(weekly, changes_df(spark, p.funnel_changes), Q.FUNNEL_MEASURES, p.window_days))


def funnel_weeks(days: DataFrame, start: str, p: Params) -> DataFrame:
    """Q4 from stored counts per day."""
    weeks = days.where(shard_filter(start, p.end)).groupBy(event_week("event_date").alias("week"))
    return weeks.agg(*[F.sum(c).alias(c) for c in Q.FUNNEL_MEASURES]).orderBy("week")
