"""Column-expression helpers (all built-in Spark functions, codegen-friendly)."""

from .categories import category_is_clean, clean_categories, not_blank
from .dates import closest_monday, event_week, mondays_in, parse_event_date, week_start, yyyymmdd
from .numeric import (
    MONEY_TYPE,
    mean,
    money_units,
    pct_change,
    rate,
    round_half_up,
    safe_div,
    units_to_money,
)
from .params import event_param
from .tiers import TierRule, assign_tier, tier_rules

__all__ = [
    "MONEY_TYPE",
    "TierRule",
    "assign_tier",
    "category_is_clean",
    "clean_categories",
    "closest_monday",
    "event_param",
    "event_week",
    "mean",
    "money_units",
    "mondays_in",
    "not_blank",
    "parse_event_date",
    "pct_change",
    "rate",
    "round_half_up",
    "safe_div",
    "tier_rules",
    "units_to_money",
    "week_start",
    "yyyymmdd",
]
