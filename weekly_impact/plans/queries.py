"""The 14 end-to-end queries (Q1-Q14) as DataFrame plans over a GA4-shaped event table.

Each function takes the event DataFrame (as returned by ``read_events`` or a
test adapter) and :class:`Params`; none collects anything.  Four (Q3, Q6, Q9,
Q12) write a shared aggregate to the scratch folder while the plan is built
(see ``materialize``), and on large inputs the weekly rollups are computed and
written there as well (see ``settle``); their caller's ``scratch_scope`` deletes both.  Output
column names and the meaning of every number follow the reference's SQL, including
in the category queries but session_start events in the site funnel, the
same product cart count repeats on each category row, averages run over the
weeks present, and rounding happens twice in the impact queries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.categories import clean_categories
from ..functions.numeric import mean, pct_change, rate, round_half_up, units_to_money
from ..functions.tiers import assign_tier
from ..operators.funnel import FUNNEL_STEPS, SITE_STEP_RATES, funnel_counts, funnel_rates
from ..operators.impact import before_after, in_windows, period_averages
from ..operators.items import item_fact
from ..operators.orders import order_dedup
from ..operators.topk import top_k, topk_semi_join
from ..operators.weekly import distinct, event_grain, rollup, rows, total, weekly_metrics
from ..sources.dimensions import changes_df
from ..sources.events import shard_filter
from ..session import materialize_sized, settle
from .params import Params

SALES_EVENTS = ["purchase", "add_to_cart", "view_item", "begin_checkout"]
PRODUCT_EVENTS = ["purchase", "add_to_cart", "view_item"]
FUNNEL_EVENTS = ["view_item", "add_to_cart", "begin_checkout", "purchase"]


# --- shared pieces -----------------------------------------------------------


def money2(units: Column) -> Column:
    """ROUND(SUM(amount), 2) from an exact decimal sum."""
    return round_half_up(units_to_money(units), 2)


def to_hundredths(x: Column) -> Column:
    """A value already rounded to 2 dp -> exact BIGINT hundredths (for exact means)."""
    return F.round(x * F.lit(100.0)).cast("bigint")


def scoped(events: DataFrame, start: str, p: Params) -> DataFrame:
    """Events whose shard lies between the query's floor ``start`` and ``p.end``."""
    return events.where(shard_filter(start, p.end))


def windowed(events: DataFrame, start: str, p: Params, changes) -> DataFrame:
    """``scoped`` events of the weeks within ``p.window_days`` of one of ``changes``."""
    return scoped(events, start, p).where(in_windows(changes, p.window_days))


def sales_fact(events: DataFrame, p: Params, start: str, names, required: str, columns=None) -> DataFrame:
    """Item fact of the given events, noise-filtered (category or subcategory variant), with these item columns (default: all)."""
    fact = item_fact(scoped(events, start, p), names, None if columns is None else {"category", required, *columns})
    return clean_categories(fact, p.blocklist, required_col=required)


# The grain that Q1, Q2, Q10, Q11 and Q13 can share: both floors stay apart, the noise filter needs the keys only.
SEGMENT_KEYS = ["from_start", "from_recent", "category", "subcategory"]


def segment_grain(events: DataFrame, p: Params) -> DataFrame:
    """One row per (week, segment, event, user or order) of the four item events, before the noise filter."""
    fact = item_fact(scoped(events, min(p.start, p.start_recent), p), SALES_EVENTS, {"category", "subcategory", "item_rev_u"})
    floors = {"from_start": F.col("event_date") >= p.start, "from_recent": F.col("event_date") >= p.start_recent}
    ms = [*_funnel_metrics(), total("_rev_u", "purchase", "item_rev_u")]
    return event_grain(fact.withColumns(floors), SEGMENT_KEYS, ms)


def from_grain(grain: DataFrame, p: Params, floor: str, required: str) -> DataFrame:
    """The grain's rows from a floor on, noise-filtered."""
    return clean_categories(grain.where(F.col(floor)), p.blocklist, required_col=required)


# --- Q1 / Q2: category and subcategory weekly --------------------------------


def sales_weekly(events: DataFrame, p: Params, keys: list[str], required: str, grain: DataFrame | None = None) -> DataFrame:
    ms = [
        distinct("sessions", "view_item", "user_pseudo_id"),
        distinct("transactions", "purchase", "transaction_id"),
        total("_rev_u", "purchase", "item_rev_u"),
        rows("add_to_cart", "add_to_cart"),
        distinct("began_checkout", "begin_checkout", "user_pseudo_id"),
    ]
    if grain is None:
        w = weekly_metrics(sales_fact(events, p, p.start, SALES_EVENTS, required, [*keys, "item_rev_u"]), keys, ms, anchor="view_item")
    else:
        w = rollup(from_grain(grain, p, "from_start", required), keys, ms, anchor="view_item", grain_keys=SEGMENT_KEYS)
    return w.select(
        "week",
        *keys,
        "sessions",
        "transactions",
        F.coalesce(money2(F.col("_rev_u")), F.lit(0.0)).alias("revenue"),
        "add_to_cart",
        "began_checkout",
        rate(F.col("transactions"), F.col("sessions"), 3).alias("cvr"),
    ).orderBy("week", *keys)


def category_weekly(events: DataFrame, p: Params, grain: DataFrame | None = None) -> DataFrame:
    """Q1: per (week, category) viewers, orders, revenue, cart rows, checkout users, CVR."""
    return sales_weekly(events, p, ["category"], "category", grain)


def subcategory_weekly(events: DataFrame, p: Params, grain: DataFrame | None = None) -> DataFrame:
    """Q2: Q1 per (week, category, subcategory); the blank test moves to subcategory."""
    return sales_weekly(events, p, ["category", "subcategory"], "subcategory", grain)


# --- Q3: product weekly ------------------------------------------------------


PRODUCT_KEYS = ["product_name", "category", "subcategory"]


def top_products_by_revenue(purchases: DataFrame, k: int) -> DataFrame:
    """Top k products by the sum of their rounded weekly revenue (exact, in cents)."""
    return top_k(purchases, "product_name", F.sum(to_hundredths(F.col("revenue"))), k, "revenue_cents")


def product_weekly(events: DataFrame, p: Params) -> DataFrame:
    """Q3: top products' weekly purchases, with per-product cart and view row counts.

    Purchases per (week, product, category, subcategory) are aggregated from
    purchase events and written once: they feed both the top-K list and the
    result.  Cart and view *row* counts per (week, product) come from their
    own events in one pass (map-side partial counts) and are joined back, so
    the same count repeats on each category row, as in the reference.  The
    two branches read disjoint events (the event filter reaches the scan
    side).  Category and subcategory may be null and are grouped as SQL does.
    """
    nonnull = F.col("product_name").isNotNull()
    bought = item_fact(scoped(events, p.start, p), ["purchase"], [*PRODUCT_KEYS, "quantity", "item_rev_u"]).where(nonnull)
    purchases = materialize_sized(
        bought.groupBy("week", *PRODUCT_KEYS).agg(
            F.count_distinct("transaction_id").alias("transactions"),
            money2(F.sum("item_rev_u")).alias("revenue"),
            F.sum("quantity").alias("units_sold"),
        ),
        "product-purchases",
    )
    top = top_products_by_revenue(purchases, p.top_products)
    carts = weekly_metrics(
        item_fact(scoped(events, p.start, p), ["add_to_cart", "view_item"], ["product_name"]).where(nonnull),
        ["product_name"],
        [rows("add_to_cart", "add_to_cart"), rows("product_views", "view_item")],
    )
    out = topk_semi_join(purchases, top, "product_name").join(
        carts, ["week", "product_name"], "left"
    )
    views = F.col("product_views")
    return out.select(
        "week",
        "product_name",
        "category",
        "subcategory",
        "transactions",
        "revenue",
        "units_sold",
        F.coalesce(F.col("add_to_cart"), F.lit(0)).alias("add_to_cart"),
        F.coalesce(views, F.lit(0)).alias("product_views"),
        rate(F.col("transactions"), F.nullif(views, F.lit(0)), 3).alias("pdp_cvr"),
    ).orderBy(F.col("week"), F.col("revenue").desc_nulls_last(), "product_name", "category", "subcategory")


# --- Q4: site funnel ---------------------------------------------------------


def funnel_weekly(events: DataFrame, p: Params) -> DataFrame:
    """Q4: per week, event counts of the seven funnel steps."""
    return funnel_counts(scoped(events, p.start, p)).orderBy("week")


# --- Q5 / Q6: order value and units per order --------------------------------


def aov_weekly(events: DataFrame, p: Params) -> DataFrame:
    """Q5: orders, revenue and mean order value per (week, category), one row per order first."""
    fact = sales_fact(events, p, p.start_recent, ["purchase"], "category", [])
    per_order = order_dedup(fact, ["category"])
    return (
        per_order.groupBy("week", "category")
        .agg(
            F.count("transaction_id").alias("transactions"),
            money2(F.sum("order_rev_u")).alias("revenue"),
            round_half_up(mean(F.col("order_rev_u")), 2).alias("aov"),
        )
        .orderBy("week", "category")
    )


def units_per_tx(events: DataFrame, p: Params) -> DataFrame:
    """Q6: units per order of the top products (by distinct orders)."""
    fact = item_fact(scoped(events, p.start_recent, p), ["purchase"], [*PRODUCT_KEYS, "quantity"])
    fact = fact.where(F.col("product_name").isNotNull())
    # Feeds the top-K list and the result: written once (see README, shared intermediates).
    per_tx = materialize_sized(
        fact.groupBy("week", "product_name", "category", "subcategory", "transaction_id").agg(
            F.sum("quantity").alias("qty_in_tx")
        )
    )
    top = top_k(per_tx, "product_name", F.count_distinct("transaction_id"), p.top_units, "orders")
    kept = topk_semi_join(per_tx, top, "product_name")
    # Within a (week, product, category, subcategory) group each order id is one
    # row already, so COUNT(order) is the distinct count.
    n_tx = F.count("transaction_id")
    return (
        kept.groupBy("week", "product_name", "category", "subcategory")
        .agg(
            n_tx.alias("transactions"),
            F.sum("qty_in_tx").alias("total_units"),
            round_half_up(mean(F.col("qty_in_tx")), 2).alias("avg_units_per_tx"),
            rate(F.count_if(F.col("qty_in_tx") >= 4), n_tx, 1).alias("pct_tx_4plus_units"),
        )
        .orderBy(F.col("week"), F.col("transactions").desc(), "product_name", "category", "subcategory")
    )


# --- Q7 / Q8 / Q9: change impact ---------------------------------------------


def _impact_columns(measures: list[tuple[str, int, bool]]) -> list[Column]:
    cols = []
    for name, digits, with_pct in measures:
        b, a = F.col(f"avg_{name}_before"), F.col(f"avg_{name}_after")
        cols += [round_half_up(b, digits).alias(f"avg_{name}_before"), round_half_up(a, digits).alias(f"avg_{name}_after")]
        if with_pct:
            cols.append(pct_change(a, b, 1).alias(f"{name}_pct_change"))
    return cols


def change_impact(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Q7: 4-week averages of weekly category revenue, orders and line-weighted AOV; only the windows' shards are read."""
    near = windowed(events, p.start_recent, p, [c for c in p.changes if c.categories])
    fact = sales_fact(near, p, p.start_recent, ["purchase"], "category", ["item_rev_u"])
    weekly = fact.groupBy("week", "category").agg(
        F.count_distinct("transaction_id").alias("transactions"),
        to_hundredths(money2(F.sum("item_rev_u"))).alias("rev_c"),
        to_hundredths(round_half_up(mean(F.col("order_rev_u")), 2)).alias("aov_c"),
    )
    ba = before_after(
        weekly,
        changes_df(spark, p.changes),
        ["category"],
        [("rev", "rev_c", 100), ("tx", "transactions", 1), ("aov", "aov_c", 100)],
        days=p.window_days,
    )
    return ba.select(
        "change_label",
        "category",
        *_impact_columns([("rev", 2, True), ("tx", 1, True), ("aov", 2, True)]),
    ).select(
        "change_label", "category", "avg_rev_before", "avg_rev_after", "rev_pct_change",
        "avg_tx_before", "avg_tx_after", "tx_pct_change", "avg_aov_before", "avg_aov_after", "aov_pct_change",
    ).orderBy("change_label", F.col("avg_rev_after").desc_nulls_last(), "category")


def change_impact_subcategory(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Q8: Q7 per (category, subcategory), revenue and orders."""
    near = windowed(events, p.start_recent, p, [c for c in p.changes if c.categories])
    fact = sales_fact(near, p, p.start_recent, ["purchase"], "subcategory", ["item_rev_u"])
    weekly = fact.groupBy("week", "category", "subcategory").agg(
        F.count_distinct("transaction_id").alias("transactions"),
        to_hundredths(money2(F.sum("item_rev_u"))).alias("rev_c"),
    )
    ba = before_after(
        weekly,
        changes_df(spark, p.changes),
        ["category", "subcategory"],
        [("rev", "rev_c", 100), ("tx", "transactions", 1)],
        days=p.window_days,
    )
    return ba.select(
        "change_label", "category", "subcategory", *_impact_columns([("rev", 2, True), ("tx", 1, True)])
    ).orderBy("change_label", "category", F.col("avg_rev_after").desc_nulls_last(), "subcategory")


def change_impact_product(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Q9: Q7 per top product (by whole-range revenue), with mean units per item row."""
    fact = item_fact(scoped(events, p.start_recent, p), ["purchase"]).where(F.col("product_name").isNotNull())
    # Feeds the top-K list and the impact averages: written once.
    weekly = materialize_sized(
        fact.groupBy("week", "product_name", "category", "subcategory").agg(
            F.count_distinct("transaction_id").alias("transactions"),
            money2(F.sum("item_rev_u")).alias("revenue"),
            round_half_up(mean(F.col("quantity")), 2).alias("avg_units"),
        )
    )
    top = top_products_by_revenue(weekly, p.top_impact_products)
    weekly = topk_semi_join(weekly, top, "product_name").select(
        "week", "product_name", "category", "subcategory", "transactions",
        to_hundredths(F.col("revenue")).alias("rev_c"), to_hundredths(F.col("avg_units")).alias("units_h"),
    )
    ba = before_after(
        weekly,
        changes_df(spark, p.changes),
        ["product_name", "category", "subcategory"],
        [("rev", "rev_c", 100), ("tx", "transactions", 1), ("units", "units_h", 100)],
        days=p.window_days,
    )
    return ba.select(
        "change_label",
        "product_name",
        "category",
        "subcategory",
        *_impact_columns([("rev", 2, True), ("tx", 1, True), ("units", 2, False)]),
    ).orderBy("change_label", "category", F.col("avg_rev_after").desc_nulls_last(), "product_name", "subcategory")


# --- Q10 / Q11 / Q12: item funnels -------------------------------------------

FUNNEL_RATES = [
    ("view_to_atc_rate", "add_to_cart", "views", 2),
    ("atc_to_checkout_rate", "begin_checkout", "add_to_cart", 2),
    ("checkout_to_purchase_rate", "purchases", "begin_checkout", 2),
    ("overall_cvr", "purchases", "views", 3),
]


def _funnel_rate_cols() -> list[Column]:
    return [rate(F.col(n), F.col(d), k).alias(name) for name, n, d, k in FUNNEL_RATES]


def _funnel_metrics(with_views: bool = True):
    ms = [
        distinct("add_to_cart", "add_to_cart", "user_pseudo_id"),
        distinct("begin_checkout", "begin_checkout", "user_pseudo_id"),
        distinct("purchases", "purchase", "transaction_id"),
    ]
    return ([distinct("views", "view_item", "user_pseudo_id")] if with_views else []) + ms


def segment_funnel(events: DataFrame, p: Params, keys: list[str], required: str, grain: DataFrame | None = None) -> DataFrame:
    if grain is None:
        fact = sales_fact(events, p, p.start_recent, FUNNEL_EVENTS, required, keys)
        w = weekly_metrics(fact, keys, _funnel_metrics(), anchor="view_item")
    else:
        w = rollup(from_grain(grain, p, "from_recent", required), keys, _funnel_metrics(), anchor="view_item", grain_keys=SEGMENT_KEYS)
    return w.select(
        "week", *keys, "views", "add_to_cart", "begin_checkout", "purchases", *_funnel_rate_cols()
    ).orderBy("week", *keys)


def category_funnel(events: DataFrame, p: Params, grain: DataFrame | None = None) -> DataFrame:
    """Q10: distinct-user funnel view -> cart -> checkout -> order per (week, category)."""
    return segment_funnel(events, p, ["category"], "category", grain)


def subcategory_funnel(events: DataFrame, p: Params, grain: DataFrame | None = None) -> DataFrame:
    """Q11: Q10 per (week, category, subcategory)."""
    return segment_funnel(events, p, ["category", "subcategory"], "subcategory", grain)


def product_funnel(events: DataFrame, p: Params) -> DataFrame:
    """Q12: Q10 for the top products by orders; views at 4 keys, the other steps per product.

    The views (distinct viewers per product, category, subcategory and week)
    come straight from the view events.  Cart, checkout and purchase events
    form one (week, product, event, distinct-key) grain, written once, from
    which the per-product steps and the top-K list are both rolled up.  The
    two branches read disjoint events (the event filter reaches the scan
    side), so no row is unnested twice.  Views keep category/subcategory,
    which may be null here, so the steps are joined back on (week, product).
    """
    nonnull = F.col("product_name").isNotNull()
    viewed = item_fact(scoped(events, p.start_recent, p), ["view_item"], PRODUCT_KEYS).where(nonnull)
    views = viewed.groupBy("week", *PRODUCT_KEYS).agg(F.count_distinct("user_pseudo_id").alias("views"))
    later = item_fact(scoped(events, p.start_recent, p), FUNNEL_EVENTS[1:], ["product_name"]).where(nonnull)
    ms = _funnel_metrics(with_views=False)
    grain = materialize_sized(event_grain(later, ["product_name"], ms), "product-steps")
    # Only products that were bought are ranked; orders without an id keep their product in the list.
    top = top_k(grain.where(F.col("event_name") == "purchase"), "product_name", F.count_distinct("_dkey"),
                p.top_funnel_products, "orders")
    steps = rollup(grain, ["product_name"], ms)
    out = settle(topk_semi_join(views, top, "product_name"), "top-views").join(
        steps, ["week", "product_name"], "left"
    )
    filled = [F.coalesce(F.col(c), F.lit(0)).alias(c) for c in ("add_to_cart", "begin_checkout", "purchases")]
    return (
        out.select("week", "product_name", "category", "subcategory", "views", *filled)
        .select("*", *_funnel_rate_cols())
        .orderBy("week", "product_name", "category", "subcategory")
    )


# --- Q13: delivery tiers -----------------------------------------------------


def delivery_tier_weekly(events: DataFrame, p: Params, grain: DataFrame | None = None) -> DataFrame:
    """Q13: weekly sales and distinct-user funnel per delivery tier (ordered rules)."""
    ms = [
        distinct("transactions", "purchase", "transaction_id"),
        total("_rev_u", "purchase", "item_rev_u"),
        distinct("product_views", "view_item", "user_pseudo_id"),
        distinct("add_to_cart", "add_to_cart", "user_pseudo_id"),
        distinct("begin_checkout", "begin_checkout", "user_pseudo_id"),
    ]
    tier = assign_tier(p.tiers, p.default_tier)
    if grain is None or not {r.column for r in p.tiers} <= {"category", "subcategory"}:
        fact = sales_fact(events, p, p.start_recent, SALES_EVENTS, "category", ["item_rev_u", *(r.column for r in p.tiers)])
        w = weekly_metrics(fact.withColumn("delivery_tier", tier), ["delivery_tier"], ms, anchor="purchase")
    else:
        tiered = from_grain(grain, p, "from_recent", "category").withColumn("delivery_tier", tier)
        w = rollup(tiered, ["delivery_tier"], ms, anchor="purchase", grain_keys=SEGMENT_KEYS)
    revenue = money2(F.col("_rev_u"))
    views, atc, chk, tx = (F.col(c) for c in ("product_views", "add_to_cart", "begin_checkout", "transactions"))
    return w.select(
        "week",
        "delivery_tier",
        "transactions",
        revenue.alias("revenue"),
        "product_views",
        "add_to_cart",
        "begin_checkout",
        round_half_up(F.try_divide(revenue, tx.cast("double")), 2).alias("aov"),
        rate(tx, F.nullif(views, F.lit(0)), 3).alias("pdp_cvr"),
        rate(atc, F.nullif(views, F.lit(0)), 2).alias("view_to_atc"),
        rate(chk, F.nullif(atc, F.lit(0)), 2).alias("atc_to_checkout"),
        rate(tx, F.nullif(chk, F.lit(0)), 2).alias("checkout_to_purchase"),
    ).orderBy("week", "delivery_tier")


# --- Q14: site funnel around changes -----------------------------------------

FUNNEL_MEASURES = [c for _, c in FUNNEL_STEPS]


def funnel_change_impact(spark: SparkSession, events: DataFrame, p: Params) -> DataFrame:
    """Q14: 4-week mean of each site funnel step before and after each change, with step rates."""
    weekly = funnel_counts(windowed(events, p.start_recent, p, p.funnel_changes))
    avgs = period_averages(weekly, changes_df(spark, p.funnel_changes), FUNNEL_MEASURES, p.window_days)
    return funnel_impact_output(avgs)


def funnel_impact_output(avgs: DataFrame) -> DataFrame:
    """Round the unrounded per-period means (1 dp) and add the step rates (2 dp) from them."""
    rated = funnel_rates(avgs, SITE_STEP_RATES, 2)
    return rated.select(
        "change_label",
        "period",
        *[round_half_up(F.col(m), 1).alias(m) for m in FUNNEL_MEASURES],
        *[name for name, _, _ in SITE_STEP_RATES],
    ).orderBy("change_label", F.col("period").desc())
