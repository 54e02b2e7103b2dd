"""Q4 / C-5 / D-4: site funnel counts per week and step rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_week
from ..functions.numeric import rate, round_half_up

# The seven funnel steps (event name -> output column), in order.
FUNNEL_STEPS = [
    ("session_start", "sessions"),
    ("view_item", "product_views"),
    ("add_to_cart", "add_to_cart"),
    ("begin_checkout", "begin_checkout"),
    ("add_shipping_info", "add_shipping_info"),
    ("add_payment_info", "add_payment_info"),
    ("purchase", "purchase"),
]

# Step rates of the site funnel impact query: (output, numerator, denominator).
SITE_STEP_RATES = [
    ("view_to_atc_rate", "add_to_cart", "product_views"),
    ("atc_to_checkout_rate", "begin_checkout", "add_to_cart"),
    ("checkout_to_shipping_rate", "add_shipping_info", "begin_checkout"),
    ("shipping_to_payment_rate", "add_payment_info", "add_shipping_info"),
    ("payment_to_purchase_rate", "purchase", "add_payment_info"),
    ("checkout_to_purchase_rate", "purchase", "begin_checkout"),
    ("atc_to_purchase_rate", "purchase", "add_to_cart"),
]


def funnel_counts(events: DataFrame, steps: Sequence[tuple[str, str]] = FUNNEL_STEPS) -> DataFrame:
    """Per Monday week, the number of *events* of each step (COUNTIF, no unnest).

    One hash aggregate with map-side partial counts: a hot week costs one row
    per map task in the shuffle.
    """
    names = [e for e, _ in steps]
    ev = events.select("event_date", "event_name").where(F.col("event_name").isin(names))
    return ev.groupBy(event_week("event_date").alias("week")).agg(
        *[F.count_if(F.col("event_name") == e).alias(col) for e, col in steps]
    )


def funnel_rates(df: DataFrame, rates: Sequence[tuple[str, str, str]], digits: int = 2) -> DataFrame:
    """C-5: add ``ROUND(SAFE_DIVIDE(num, den) * 100, digits)`` columns."""
    return df.withColumns({name: rate(F.col(num), F.col(den), digits) for name, num, den in rates})


def step_dropoff(weekly_funnel: DataFrame) -> DataFrame:
    """D-4 (definition ours): per-week step rates and drop-off (100 - rate).

    Adds shipping -> purchase to the site step rates; rates are null on a zero
    denominator, and so is their drop-off.
    """
    rates = SITE_STEP_RATES + [("shipping_to_purchase_rate", "purchase", "add_shipping_info")]
    out = funnel_rates(weekly_funnel, rates, 2)
    drops = {name.replace("_rate", "_dropoff"): F.lit(100.0) - F.col(name) for name, _, _ in rates}
    return out.withColumns({k: round_half_up(v, 2) for k, v in drops.items()})
