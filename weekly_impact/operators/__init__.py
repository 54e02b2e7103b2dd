"""Reusable DataFrame operators (C-1..C-5 and the relational pieces they use)."""

from .asof import nearest_join
from .funnel import FUNNEL_STEPS, SITE_STEP_RATES, funnel_counts, funnel_rates, step_dropoff
from .impact import before_after, before_after_union, change_weeks, in_windows, period_averages, range_join_changes, window_shards
from .items import ITEM_FACT_COLUMNS, explode_items, item_fact
from .orders import order_dedup
from .sketches import distinct_sketch, estimate, relative_error, unite_sketches
from .topk import top_k, topk_semi_join
from .weekly import Metric, anchor_left_join, distinct, rows, total, weekly_metrics

__all__ = [
    "FUNNEL_STEPS",
    "ITEM_FACT_COLUMNS",
    "Metric",
    "SITE_STEP_RATES",
    "anchor_left_join",
    "before_after",
    "before_after_union",
    "change_weeks",
    "distinct",
    "distinct_sketch",
    "estimate",
    "explode_items",
    "funnel_counts",
    "funnel_rates",
    "in_windows",
    "item_fact",
    "nearest_join",
    "order_dedup",
    "period_averages",
    "range_join_changes",
    "relative_error",
    "rows",
    "step_dropoff",
    "top_k",
    "topk_semi_join",
    "total",
    "unite_sketches",
    "weekly_metrics",
    "window_shards",
]
