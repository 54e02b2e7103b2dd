"""Test-table adapters: the driver's TPC-H-style tables -> GA4-shaped events.

The driver's tables hold no nested analytics events, so two fixed mappings
(FIXTURES.md sections 2 and 3) turn them into the event schema of
:mod:`weekly_impact.sources.events`.  Every rule below is a built-in column
expression; the only shuffle is the join on the order key.

Item events (orders x lineitem x part):

* one event per order and funnel stage (view_item, add_to_cart,
  begin_checkout, purchase) up to a depth set by the order status;
* the stage event of an order is emitted once per order line, each with a
  one-element ``items`` array.  Events of one order and stage share every
  event field, and every item query works on unnested item rows, so no query
  can tell this from one event holding all lines; building the array needs no
  aggregate, so no shuffle and no group of unbounded size.  Orders without
  lines would carry ``items = null`` and vanish at the unnest; they are not
  generated.

Site events (the ``events`` table): one event per row, event name from
``event_type`` and ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .events import EVENT_COLUMNS, EVENT_PARAMS, ITEM, shard_filter

# Rules are SQL expression strings: one plan call each, where the Column API
# would make one call per literal, operator and branch.

# Fixed values of the item-event mapping (FIXTURES.md section 2).
STAGE_NAMES = ["view_item", "add_to_cart", "begin_checkout", "purchase"]
PART_ITEM = [
    "p_partkey",
    "p_name AS item_name",
    "CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN '' "
    "WHEN p_partkey % 23 = 0 THEN lower(p_type) WHEN p_partkey % 29 = 0 THEN 'XY' "
    "ELSE p_type END AS item_category",
    "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS item_category2",
    "CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_retailprice END AS price",
]
STAGE_KEPT = (
    "stage <= CASE WHEN o_orderstatus = 'F' THEN 3 WHEN o_orderstatus = 'P' THEN 2 "
    "WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END "
    "AND NOT (stage = 0 AND o_orderkey % 11 = 0)"
)
STAGE_NAME = "CASE stage " + " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(STAGE_NAMES)) + " END"
ORDER_ECOMMERCE = (
    "named_struct('transaction_id', CASE WHEN stage = 3 AND o_orderkey % 97 <> 0 "
    "THEN CAST(o_orderkey AS STRING) END, "
    "'purchase_revenue', CASE WHEN stage = 3 THEN o_totalprice END)"
)
ITEM_FIELDS = ["item_name", "item_category", "item_category2", "price", "quantity"]

# Fixed values of the site-event mapping (FIXTURES.md section 3).
SITE_EVENT_NAME = (
    "CASE WHEN event_type = 'view' THEN 'view_item' "
    "WHEN event_type = 'click' THEN 'add_to_cart' "
    "WHEN event_type = 'purchase' THEN 'purchase' "
    "WHEN event_type = 'signup' AND k % 3 = 0 THEN 'begin_checkout' "
    "WHEN event_type = 'signup' AND k % 3 = 1 THEN 'add_shipping_info' "
    "WHEN event_type = 'signup' AND k % 3 = 2 THEN 'add_payment_info' "
    "WHEN event_type = 'error' AND k % 3 = 0 THEN 'session_start' "
    "ELSE 'page_view' END"
)
SESSION_PARAM = (
    "CASE WHEN event_id % 10 = 0 THEN CAST(array() AS {t}) ELSE array(named_struct('key', 'ga_session_id', "
    "'value', named_struct('string_value', CAST(NULL AS STRING), 'int_value', event_id, "
    "'float_value', CAST(NULL AS DOUBLE), 'double_value', CAST(NULL AS DOUBLE)))) END"
).format(t=EVENT_PARAMS.simpleString())
NO_ECOMMERCE = "named_struct('transaction_id', CAST(NULL AS STRING), 'purchase_revenue', CAST(NULL AS DOUBLE))"

# Declared schemas of the test tables (only the columns the mapping reads):
# no schema-discovery job per read, and the scan reads just these columns.
TABLE_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _floor(start: str) -> str:
    return f"o_orderdate >= TIMESTAMP_NTZ '{start[:4]}-{start[4:6]}-{start[6:8]} 00:00:00'"


def order_events(spark: SparkSession, sf_dir: str, start: str = "19950101", end: str | None = None) -> DataFrame:
    """Event-level rows of the item mapping (no items yet), keyed by ``o_orderkey``.

    Event fields are computed once per order and stage, before any join, and
    a query's ``event_name`` filter lands right after the stage explode, so
    a purchase-only query shuffles and joins purchase events only.  Stages
    come from exploding a constant array and a plain filter (both codegen'd;
    a lambda ``filter`` would run interpreted).  The floor on the raw date
    column is pushed to the Parquet reader; the exact string bound follows.
    """
    orders = _table(spark, sf_dir, "orders").where(_floor(start)).selectExpr(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        "CAST(o_custkey AS STRING) AS user_pseudo_id",
        "date_format(o_orderdate, 'yyyyMMdd') AS event_date",
    ).where(shard_filter(start, end))
    staged = orders.selectExpr("*", f"explode(array({', '.join(map(str, range(len(STAGE_NAMES))))})) AS stage")
    return staged.where(STAGE_KEPT).selectExpr(
        "o_orderkey",
        f"{STAGE_NAME} AS event_name",
        "user_pseudo_id",
        f"CAST(array() AS {EVENT_PARAMS.simpleString()}) AS event_params",
        f"{ORDER_ECOMMERCE} AS ecommerce",
        "event_date",
    )


def item_events(spark: SparkSession, sf_dir: str, start: str = "19950101", end: str | None = None) -> DataFrame:
    """Nested GA4-shaped events (``EVENT_COLUMNS``) from orders x lineitem x part.

    One shuffle: order events (after the query's event filter) and narrow
    lines (keys and quantity, no item strings) meet on the order key.  The
    order side grows with the data, so it is never broadcast: a sort-merge
    join (both sides spill; no per-partition hash table that must fit in
    memory) and AQE splits a hot order's partition on the line side (inner
    join).  ``part`` is joined after it by the planner's size check
    (broadcast while small, sort-merge otherwise).  Each line becomes a
    one-element ``items`` array: a projection, not an aggregate, so no group
    is ever collected however many lines an order has.
    """
    events = order_events(spark, sf_dir, start, end).hint("merge")
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey", "l_partkey", "CAST(l_quantity AS BIGINT) AS quantity"
    )
    joined = events.join(lines, events.o_orderkey == lines.l_orderkey, "inner")
    parts = _table(spark, sf_dir, "part").selectExpr(*PART_ITEM)
    with_items = joined.join(parts, joined.l_partkey == parts.p_partkey, "inner")
    item = "named_struct(" + ", ".join(f"'{f}', {f}" for f in ITEM_FIELDS) + ")"
    return with_items.selectExpr(*[c for c in EVENT_COLUMNS if c != "items"], f"array({item}) AS items").select(
        *EVENT_COLUMNS
    )


def site_events(spark: SparkSession, sf_dir: str, start: str = "19950101", end: str | None = None) -> DataFrame:
    """GA4-shaped events (no items) from the ``events`` table (FIXTURES.md section 3)."""
    ev = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "user_id", "event_type", "CAST(get_json_object(props, '$.k') AS BIGINT) AS k"
    )
    return ev.selectExpr(
        f"{SITE_EVENT_NAME} AS event_name",
        "CAST(user_id AS STRING) AS user_pseudo_id",
        f"{SESSION_PARAM} AS event_params",
        f"{NO_ECOMMERCE} AS ecommerce",
        f"CAST(NULL AS {T.ArrayType(ITEM).simpleString()}) AS items",
        "date_format(ts, 'yyyyMMdd') AS event_date",
    ).where(shard_filter(start, end))
