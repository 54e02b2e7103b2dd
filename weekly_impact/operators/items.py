"""R-2 / C-1: unnest the ``items`` array into one row per event-item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import event_week
from ..functions.numeric import money_units

# Columns of the item fact produced by :func:`item_fact`.
ITEM_FACT_COLUMNS = [
    "event_date",
    "week",
    "event_name",
    "user_pseudo_id",
    "transaction_id",
    "order_rev_u",
    "product_name",
    "category",
    "subcategory",
    "quantity",
    "item_rev_u",
]

# The item fields that each item column of the fact is made from.
ITEM_FIELDS = {
    "product_name": ["item_name"],
    "category": ["item_category"],
    "subcategory": ["item_category2"],
    "quantity": ["quantity"],
    "item_rev_u": ["price", "quantity"],
}


def explode_items(events: DataFrame, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per (event, item) with the item struct as column ``item``.

    Inner unnest (``explode``, never ``explode_outer``): events whose items
    are null or empty produce no row, as ``CROSS JOIN UNNEST`` does.
    """
    keep = [c for c in (keep or events.columns) if c != "items"]
    return events.select(*keep, F.explode("items").alias("item"))


def item_fact(
    events: DataFrame,
    event_names: Sequence[str] | None = None,
    item_columns: Sequence[str] | None = None,
) -> DataFrame:
    """C-1: the item-event fact all item queries start from.

    The event-name filter is applied *before* the unnest so it runs on event
    rows (and reaches the scan when ``event_name`` is a stored column).  Money
    is carried as a wide decimal (see :mod:`weekly_impact.functions.numeric`):
    ``item_rev_u`` is ``price * quantity``, ``order_rev_u`` the order revenue.

    ``item_columns`` names the item columns to make (default: all).  With
    fewer, only the arrays of their fields are zipped and unnested: the
    optimizer does not prune an unnested struct with several used fields, so
    the scan would otherwise read every item field of every row.

    ``events`` may also be an item fact already (e.g. one materialized for a
    whole refresh run): it is then only filtered, not unnested again.
    """
    if set(ITEM_FACT_COLUMNS) <= set(events.columns):
        fact = events.select(*ITEM_FACT_COLUMNS)
        if event_names is not None:
            fact = fact.where(F.col("event_name").isin(list(event_names)))
        return fact
    ev = events.select("event_date", "event_name", "user_pseudo_id", "ecommerce", "items")
    if event_names is not None:
        ev = ev.where(F.col("event_name").isin(list(event_names)))
    # Event-level fields once per event, before the unnest multiplies rows.
    ev = ev.select(
        "event_date",
        event_week("event_date").alias("week"),
        "event_name",
        "user_pseudo_id",
        F.col("ecommerce.transaction_id").alias("transaction_id"),
        money_units(F.col("ecommerce.purchase_revenue")).alias("order_rev_u"),
        "items",
    )
    wanted = [c for c in ITEM_FIELDS if item_columns is None or c in item_columns]
    if item_columns is not None:
        fields = list(dict.fromkeys(f for c in wanted for f in ITEM_FIELDS[c]))
        kept = [c for c in ev.columns if c != "items"]
        ev = ev.select(*kept, *[F.col(f"items.{f}").alias(f) for f in fields]).select(*kept, F.arrays_zip(*fields).alias("items"))
    x = explode_items(ev)
    item = F.col("item")
    made = {
        "product_name": lambda: item["item_name"],
        "category": lambda: item["item_category"],
        "subcategory": lambda: item["item_category2"],
        "quantity": lambda: item["quantity"],
        "item_rev_u": lambda: money_units(item["price"] * item["quantity"]),
    }
    return x.select(*[c for c in x.columns if c != "item"], *[made[c]().alias(c) for c in wanted])
