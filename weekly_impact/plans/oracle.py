"""DuckDB oracle SQL for every registered query (driver correctness gate).

The oracle starts from the same fixed mapping of the test tables as
:mod:`weekly_impact.sources.fixtures`, kept *flat* (no nested arrays), and
computes each query from its definition in SQL's own terms (distinct counts
with filters, window ranks, distances in days), so it checks the Spark plans
(two-phase aggregates, Monday equi-joins), not just re-runs them.
"""

from __future__ import annotations

from ..sources.dimensions import Change
from .params import FIXTURE_PARAMS, FIXTURE_SCAN_WINDOW, Params

P = FIXTURE_PARAMS


# --- SQL helpers mirroring weekly_impact.functions.numeric -------------------


def rhu(x: str, n: int) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {n}) AS DOUBLE)"


def money(units: str) -> str:
    return f"CAST({units} AS DOUBLE)"


def money2(units: str) -> str:
    return rhu(money(units), 2)


def rate(num: str, den: str, n: int) -> str:
    return rhu(f"CAST({num} AS DOUBLE) / NULLIF(CAST({den} AS DOUBLE), 0) * 100.0", n)


def mean(x: str) -> str:
    return f"(CAST(SUM({x}) AS DOUBLE) / NULLIF(CAST(COUNT({x}) AS DOUBLE), 0))"


def pct(after: str, before: str) -> str:
    return rhu(f"({after} - {before}) / NULLIF({before}, 0) * 100.0", 1)


def hundredths(x: str) -> str:
    return f"CAST(round({x} * 100.0) AS BIGINT)"


def sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def clean(required: str = "category", p: Params = P) -> str:
    block = f"AND category NOT IN ({sql_list(p.blocklist)}) " if p.blocklist else ""
    return (
        f"{required} IS NOT NULL AND {required} <> '' {block}"
        "AND length(category) > 2 AND regexp_matches(category, '^[A-Z]')"
    )


def scan(start: str) -> str:
    return f"event_date BETWEEN '{start}' AND strftime(current_date, '%Y%m%d')"


# --- the test-table mapping (FIXTURES.md sections 2 and 3), flat -------------

ITEM_BASE = """
part_items AS (
  SELECT p_partkey, p_name AS item_name,
    CASE WHEN p_partkey % 17 = 0 THEN NULL WHEN p_partkey % 19 = 0 THEN ''
         WHEN p_partkey % 23 = 0 THEN lower(p_type) WHEN p_partkey % 29 = 0 THEN 'XY'
         ELSE p_type END AS item_category,
    CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_brand END AS item_category2,
    CASE WHEN p_partkey % 41 = 0 THEN NULL ELSE p_retailprice END AS price
  FROM part
),
stages AS (
  SELECT * FROM (VALUES (0, 'view_item'), (1, 'add_to_cart'), (2, 'begin_checkout'), (3, 'purchase'))
    AS t(stage, event_name)
),
order_events AS (
  SELECT o.o_orderkey, s.event_name, strftime(o.o_orderdate, '%Y%m%d') AS event_date,
    CAST(o.o_custkey AS VARCHAR) AS user_pseudo_id,
    CASE WHEN s.stage = 3 AND o.o_orderkey % 97 <> 0 THEN CAST(o.o_orderkey AS VARCHAR) END AS transaction_id,
    CASE WHEN s.stage = 3 THEN o.o_totalprice END AS purchase_revenue
  FROM orders o
  JOIN stages s
    ON s.stage <= CASE WHEN o.o_orderstatus = 'F' THEN 3 WHEN o.o_orderstatus = 'P' THEN 2
                       WHEN o.o_orderkey % 2 = 0 THEN 1 ELSE 0 END
   AND NOT (s.stage = 0 AND o.o_orderkey % 11 = 0)
),
item_events AS (
  SELECT CAST(date_trunc('week', strptime(e.event_date, '%Y%m%d')) AS DATE) AS week,
    e.event_date, e.event_name, e.user_pseudo_id, e.transaction_id,
    e.purchase_revenue AS order_rev_u,
    pi.item_name AS product_name, pi.item_category AS category, pi.item_category2 AS subcategory,
    CAST(l.l_quantity AS BIGINT) AS quantity,
    pi.price * CAST(l.l_quantity AS BIGINT) AS item_rev_u
  FROM order_events e
  JOIN lineitem l ON l.l_orderkey = e.o_orderkey
  JOIN part_items pi ON pi.p_partkey = l.l_partkey
)"""

SITE_BASE = """
site_raw AS (
  SELECT event_id, ts, user_id, event_type,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
site_events AS (
  SELECT
    CASE WHEN event_type = 'view' THEN 'view_item'
         WHEN event_type = 'click' THEN 'add_to_cart'
         WHEN event_type = 'purchase' THEN 'purchase'
         WHEN event_type = 'signup' AND k % 3 = 0 THEN 'begin_checkout'
         WHEN event_type = 'signup' AND k % 3 = 1 THEN 'add_shipping_info'
         WHEN event_type = 'signup' AND k % 3 = 2 THEN 'add_payment_info'
         WHEN event_type = 'error' AND k % 3 = 0 THEN 'session_start'
         ELSE 'page_view' END AS event_name,
    CAST(user_id AS VARCHAR) AS user_pseudo_id,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE event_id END AS session_id,
    strftime(ts, '%Y%m%d') AS event_date,
    CAST(date_trunc('week', CAST(ts AS DATE)) AS DATE) AS week
  FROM site_raw
)"""


def with_items(body: str) -> str:
    return f"WITH {ITEM_BASE},\n{body}"


def with_site(body: str) -> str:
    return f"WITH {SITE_BASE},\n{body}"


def with_both(body: str) -> str:
    return f"WITH {ITEM_BASE},\n{SITE_BASE},\n{body}"


def change_values(changes: tuple[Change, ...], with_categories: bool = True) -> str:
    rows = []
    for c in changes:
        cats = f", [{sql_list(c.categories)}]" if with_categories else ""
        rows.append(f"(DATE '{c.date}', '{c.label}'{cats})")
    cols = "change_date, change_label, affected_categories" if with_categories else "change_date, change_label"
    return f"SELECT * FROM (VALUES {', '.join(rows)}) AS t({cols})"


# --- Q1 / Q2 -------------------------------------------------------------------


def counted(event: str, what: str) -> str:
    """What one event contributes to a group: COUNT/SUM of ``what`` over that event's rows."""
    return f"{what} FILTER (WHERE event_name = '{event}')"


# Users (orders for a purchase) that reached a step, within a group.
STEP_USERS = {e: counted(e, "COUNT(DISTINCT user_pseudo_id)") for e in ("view_item", "add_to_cart", "begin_checkout")}
ORDERS = counted("purchase", "COUNT(DISTINCT transaction_id)")
REVENUE = money2(counted("purchase", "FSUM(item_rev_u)"))


def sales_weekly_sql(keys: list[str], required: str) -> str:
    """One grouped pass; a group appears if it was viewed.  The key columns are never null after ``clean``."""
    k = ", ".join(keys)
    return with_items(f"""
totals AS (
  SELECT week, {k}, {STEP_USERS['view_item']} AS sessions, {ORDERS} AS transactions,
    COALESCE({REVENUE}, 0.0) AS revenue, {counted('add_to_cart', 'COUNT(*)')} AS add_to_cart,
    {STEP_USERS['begin_checkout']} AS began_checkout
  FROM item_events
  WHERE {scan(P.start)} AND {clean(required)}
  GROUP BY ALL
  HAVING bool_or(event_name = 'view_item')
)
SELECT *, {rate('transactions', 'sessions', 3)} AS cvr FROM totals ORDER BY week, {k}
""")


# --- Q3 ------------------------------------------------------------------------


def product_weekly_sql() -> str:
    """One grouped pass; cart and view rows are additive, so a product's week sums them over its categories."""
    return with_items(f"""
totals AS (
  SELECT week, product_name, category, subcategory, bool_or(event_name = 'purchase') AS bought,
    {ORDERS} AS transactions, {REVENUE} AS revenue, {counted('purchase', 'SUM(quantity)')} AS units_sold,
    SUM({counted('add_to_cart', 'COUNT(*)')}) OVER w AS add_to_cart,
    SUM({counted('view_item', 'COUNT(*)')}) OVER w AS product_views
  FROM item_events
  WHERE {scan(P.start)} AND product_name IS NOT NULL
  GROUP BY week, product_name, category, subcategory
  WINDOW w AS (PARTITION BY week, product_name)
),
ranked AS (
  SELECT *, SUM({hundredths('revenue')}) OVER (PARTITION BY product_name) AS earned FROM totals WHERE bought
)
SELECT week, product_name, category, subcategory, transactions, revenue, CAST(units_sold AS BIGINT) AS units_sold,
  CAST(add_to_cart AS BIGINT) AS add_to_cart, CAST(product_views AS BIGINT) AS product_views,
  {rate('transactions', 'product_views', 3)} AS pdp_cvr
FROM ranked
QUALIFY dense_rank() OVER (ORDER BY earned DESC NULLS LAST, product_name) <= {P.top_products}
ORDER BY week, revenue DESC
""")


# --- Q4 / Q14 ------------------------------------------------------------------

# The funnel's event names and their columns.
FUNNEL_COLUMNS = {
    "session_start": "sessions", "view_item": "product_views", "add_to_cart": "add_to_cart", "begin_checkout": "begin_checkout",
    "add_shipping_info": "add_shipping_info", "add_payment_info": "add_payment_info", "purchase": "purchase",
}
FUNNEL_EVENTS = sql_list(FUNNEL_COLUMNS)
FUNNEL_COUNTS = ", ".join(f"CAST(coalesce(n['{e}'], 0) AS BIGINT) AS {c}" for e, c in FUNNEL_COLUMNS.items())
MEASURES = list(FUNNEL_COLUMNS.values())
SITE_RATES = [
    ("view_to_atc_rate", "add_to_cart", "product_views"),
    ("atc_to_checkout_rate", "begin_checkout", "add_to_cart"),
    ("checkout_to_shipping_rate", "add_shipping_info", "begin_checkout"),
    ("shipping_to_payment_rate", "add_payment_info", "add_shipping_info"),
    ("payment_to_purchase_rate", "purchase", "add_payment_info"),
    ("checkout_to_purchase_rate", "purchase", "begin_checkout"),
    ("atc_to_purchase_rate", "purchase", "add_to_cart"),
]


def weekly_funnel_cte(start: str) -> str:
    """One map of counts per week; a step that a week lacks counts 0."""
    return f"""step_counts AS (
  SELECT week, histogram(event_name) AS n FROM site_events WHERE {scan(start)} AND event_name IN ({FUNNEL_EVENTS}) GROUP BY week
),
weekly_funnel AS (SELECT week, {FUNNEL_COUNTS} FROM step_counts)"""


def funnel_weekly_sql() -> str:
    return with_site(f"{weekly_funnel_cte(P.start)}\nSELECT * FROM weekly_funnel ORDER BY week")


def near_changes_cte() -> str:
    """Each change with the weeks that start at most 28 days away, and their distance in days."""
    return f"""{weekly_funnel_cte(P.start_recent)},
near AS (
  SELECT *, date_diff('day', change_date, week) AS days
  FROM weekly_funnel, ({change_values(P.funnel_changes, with_categories=False)})
  WHERE days BETWEEN -28 AND 27
)"""


def before_after_funnel_cte() -> str:
    """The sign of the distance is the period."""
    avgs = ", ".join(f"{mean(m)} AS {m}" for m in MEASURES)
    return f"""{near_changes_cte()},
before_after AS (
  SELECT change_label, CASE WHEN days < 0 THEN 'before' ELSE 'after' END AS period, {avgs}
  FROM near GROUP BY ALL
)"""


def funnel_change_impact_sql() -> str:
    cols = ",\n  ".join([f"{rhu(m, 1)} AS {m}" for m in MEASURES]
                         + [rhu(f"{n} / NULLIF({d}, 0) * 100.0", 2) + f" AS {name}" for name, n, d in SITE_RATES])
    return with_site(f"""{before_after_funnel_cte()}
SELECT change_label, period,
  {cols}
FROM before_after
ORDER BY change_label, period DESC
""")


# --- Q5 / Q6 -------------------------------------------------------------------


def aov_weekly_sql() -> str:
    return with_items(f"""
order_rows AS (
  SELECT week, category, transaction_id, order_rev_u FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND {clean('category')}
  QUALIFY row_number() OVER (PARTITION BY week, category, transaction_id ORDER BY order_rev_u DESC NULLS LAST) = 1
)
SELECT week, category, COUNT(transaction_id) AS transactions, {money2('FSUM(order_rev_u)')} AS revenue,
  {rhu('FSUM(order_rev_u) / NULLIF(CAST(COUNT(order_rev_u) AS DOUBLE), 0)', 2)} AS aov
FROM order_rows GROUP BY ALL ORDER BY week, category
""")


def units_per_tx_sql() -> str:
    """Every bought line knows its order's units; the order's first line stands for it."""
    order_units = mean("CASE WHEN opens THEN units END")
    return with_items(f"""
bought AS (
  SELECT week, product_name, category, subcategory, transaction_id, quantity,
    SUM(quantity) OVER one AS units, row_number() OVER one = 1 AS opens
  FROM item_events WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND product_name IS NOT NULL
  WINDOW one AS (PARTITION BY week, product_name, category, subcategory, transaction_id)
),
most_ordered AS (
  SELECT product_name FROM bought GROUP BY product_name
  QUALIFY row_number() OVER (ORDER BY COUNT(DISTINCT transaction_id) DESC, product_name) <= {P.top_units}
)
SELECT week, product_name, category, subcategory,
  COUNT(transaction_id) FILTER (WHERE opens) AS transactions, CAST(SUM(quantity) AS BIGINT) AS total_units,
  {rhu(order_units, 2)} AS avg_units_per_tx,
  {rate('count_if(opens AND units >= 4)', 'COUNT(transaction_id) FILTER (WHERE opens)', 1)} AS pct_tx_4plus_units
FROM bought SEMI JOIN most_ordered USING (product_name)
GROUP BY ALL ORDER BY week, transactions DESC
""")


# --- Q7 / Q8 / Q9 --------------------------------------------------------------


def affected(source: str, p: Params = P) -> str:
    """Rows of ``source`` whose category a change affects, with the days from the change to the row's week."""
    return f"""
  SELECT r.*, c.change_label, date_diff('day', c.change_date, r.week) AS days
  FROM {source} r
  JOIN (SELECT change_date, change_label, unnest(list_distinct(affected_categories)) AS category
        FROM ({change_values(p.changes)})) c ON c.category = r.category"""


def _window(side: str, col: str) -> str:
    days = "-28 AND -1" if side == "before" else "0 AND 27"
    return mean(f"CASE WHEN days BETWEEN {days} THEN {col} END")


def _ba_select(measures: list[tuple[str, str, int]]) -> str:
    out = []
    for name, col, div in measures:
        for side in ("before", "after"):
            expr = _window(side, col)
            out.append(f"{expr}{' / 100.0' if div == 100 else ''} AS avg_{name}_{side}")
    return ",\n    ".join(out)


def _ba_output(measures: list[tuple[str, int, bool]]) -> str:
    out = []
    for name, digits, with_pct in measures:
        b, a = f"avg_{name}_before", f"avg_{name}_after"
        out += [f"{rhu(b, digits)} AS {b}", f"{rhu(a, digits)} AS {a}"]
        if with_pct:
            out.append(f"{pct(a, b)} AS {name}_pct_change")
    return ",\n  ".join(out)


def _impact_sql(source: str, keys: list[str], measures: list[tuple[str, str, int]], shown: list[tuple[str, int, bool]], order: str) -> str:
    """Mean per period for each change and key, kept where both periods have revenue."""
    k = ", ".join(keys)
    return with_items(f"""{source},
impact AS (
  SELECT change_label, {k}, {_ba_select(measures)}
  FROM ({affected('weeks')}) GROUP BY ALL
)
SELECT change_label, {k}, {_ba_output(shown)}
FROM impact
WHERE avg_rev_before + avg_rev_after IS NOT NULL
ORDER BY {order}
""")


def change_impact_sql() -> str:
    order_value = rhu("FSUM(order_rev_u) / NULLIF(CAST(COUNT(order_rev_u) AS DOUBLE), 0)", 2)
    return _impact_sql(
        f"""
weeks AS (
  SELECT week, category, COUNT(DISTINCT transaction_id) AS transactions,
    {hundredths(money2('FSUM(item_rev_u)'))} AS rev_c, {hundredths(order_value)} AS aov_c
  FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND {clean('category')} GROUP BY ALL
)""",
        ["category"], [("rev", "rev_c", 100), ("tx", "transactions", 1), ("aov", "aov_c", 100)],
        [("rev", 2, True), ("tx", 1, True), ("aov", 2, True)], "change_label, avg_rev_after DESC")


def change_impact_subcategory_sql() -> str:
    return _impact_sql(
        f"""
weeks AS (
  SELECT week, category, subcategory, COUNT(DISTINCT transaction_id) AS transactions,
    {hundredths(money2('FSUM(item_rev_u)'))} AS rev_c
  FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND {clean('subcategory')} GROUP BY ALL
)""",
        ["category", "subcategory"], [("rev", "rev_c", 100), ("tx", "transactions", 1)],
        [("rev", 2, True), ("tx", 1, True)], "change_label, category, avg_rev_after DESC")


def change_impact_product_sql() -> str:
    return _impact_sql(
        f"""
sold AS (
  SELECT week, product_name, category, subcategory, COUNT(DISTINCT transaction_id) AS transactions,
    {hundredths(money2('FSUM(item_rev_u)'))} AS rev_c, {hundredths(rhu(mean('quantity'), 2))} AS units_h
  FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND product_name IS NOT NULL GROUP BY ALL
),
earning AS (SELECT *, SUM(rev_c) OVER (PARTITION BY product_name) AS earned FROM sold),
weeks AS (
  SELECT * FROM earning
  QUALIFY dense_rank() OVER (ORDER BY earned DESC NULLS LAST, product_name) <= {P.top_impact_products}
)""",
        ["product_name", "category", "subcategory"],
        [("rev", "rev_c", 100), ("tx", "transactions", 1), ("units", "units_h", 100)],
        [("rev", 2, True), ("tx", 1, True), ("units", 2, False)], "change_label, category, avg_rev_after DESC")


# --- Q10 / Q11 / Q12 -----------------------------------------------------------

STEP_COUNTS = ", ".join(f"{users} AS {name}" for users, name in (
    (STEP_USERS["add_to_cart"], "add_to_cart"), (STEP_USERS["begin_checkout"], "begin_checkout"), (ORDERS, "purchases")))
STEP_RATES = ", ".join(f"{rate(num, den, n)} AS {name}" for name, num, den, n in (
    ("view_to_atc_rate", "add_to_cart", "views", 2),
    ("atc_to_checkout_rate", "begin_checkout", "add_to_cart", 2),
    ("checkout_to_purchase_rate", "purchases", "begin_checkout", 2),
    ("overall_cvr", "purchases", "views", 3)))


def segment_funnel_sql(keys: list[str], required: str) -> str:
    """One grouped pass; a group appears if it was viewed.  The key columns are never null after ``clean``."""
    k = ", ".join(keys)
    return with_items(f"""
steps AS (
  SELECT week, {k}, {STEP_USERS['view_item']} AS views, {STEP_COUNTS}
  FROM item_events
  WHERE {scan(P.start_recent)} AND {clean(required)}
  GROUP BY ALL
  HAVING bool_or(event_name = 'view_item')
)
SELECT *, {STEP_RATES} FROM steps ORDER BY week, {k}
""")


def product_funnel_sql() -> str:
    """Three grains from one grouping: views per full key, steps per product and week, orders per product."""
    return with_items(f"""
grains AS (
  SELECT week, product_name, category, subcategory, GROUPING(week) + GROUPING(category) AS level,
    bool_or(event_name = 'view_item') AS viewed, bool_or(event_name = 'purchase') AS bought,
    {STEP_USERS['view_item']} AS views, {STEP_COUNTS}
  FROM item_events
  WHERE {scan(P.start_recent)} AND product_name IS NOT NULL
  GROUP BY GROUPING SETS ((week, product_name, category, subcategory), (week, product_name), (product_name))
),
best AS (
  SELECT product_name FROM grains WHERE level = 2 AND bought ORDER BY purchases DESC, product_name LIMIT {P.top_funnel_products}
),
steps AS (
  SELECT k.week, k.product_name, k.category, k.subcategory, k.views, w.add_to_cart, w.begin_checkout, w.purchases
  FROM grains k JOIN grains w ON w.level = 1 AND w.week = k.week AND w.product_name = k.product_name
  WHERE k.level = 0 AND k.viewed AND k.product_name IN (FROM best)
)
SELECT *, {STEP_RATES} FROM steps ORDER BY week, product_name
""")


# --- Q13 -------------------------------------------------------------------------


def tier_case(p: Params = P) -> str:
    whens = " ".join(f"WHEN {r.column} IN ({sql_list(r.values)}) THEN '{r.tier}'" for r in p.tiers)
    return f"CASE {whens} ELSE '{p.default_tier}' END"


def delivery_tier_weekly_sql() -> str:
    """One grouped pass; a tier's week appears if something was bought."""
    return with_items(f"""
tiers AS (
  SELECT week, {tier_case()} AS delivery_tier, {ORDERS} AS transactions, {REVENUE} AS revenue,
    {STEP_USERS['view_item']} AS product_views, {STEP_USERS['add_to_cart']} AS add_to_cart,
    {STEP_USERS['begin_checkout']} AS begin_checkout
  FROM item_events
  WHERE {scan(P.start_recent)} AND {clean('category')}
  GROUP BY ALL
  HAVING bool_or(event_name = 'purchase')
)
SELECT *, {rhu('revenue / NULLIF(CAST(transactions AS DOUBLE), 0)', 2)} AS aov,
  {rate('transactions', 'product_views', 3)} AS pdp_cvr,
  {rate('add_to_cart', 'product_views', 2)} AS view_to_atc,
  {rate('begin_checkout', 'add_to_cart', 2)} AS atc_to_checkout,
  {rate('transactions', 'begin_checkout', 2)} AS checkout_to_purchase
FROM tiers ORDER BY week, delivery_tier
""")


# --- dashboard operators (D-1 .. D-5) ---------------------------------------------


def site_overview_cte() -> str:
    return f"""ev AS (
  SELECT week, event_name, transaction_id, order_rev_u AS rev_u FROM item_events
  WHERE {scan(P.start)} AND event_name IN ('session_start', 'purchase')
  UNION ALL
  SELECT week, event_name, NULL AS transaction_id, NULL AS rev_u FROM site_events
  WHERE {scan(P.start)} AND event_name IN ('session_start', 'purchase')
),
per_order AS (
  SELECT week, event_name, transaction_id, COUNT(*) AS n, MAX(rev_u) AS rev_u FROM ev GROUP BY ALL
),
so AS (
  SELECT week,
    CAST(COALESCE(SUM(CASE WHEN event_name <> 'purchase' THEN n END), 0) AS BIGINT) AS sessions,
    CAST(count_if(event_name = 'purchase' AND transaction_id IS NOT NULL) AS BIGINT) AS transactions,
    {money2("FSUM(CASE WHEN event_name = 'purchase' THEN rev_u END)")} AS revenue
  FROM per_order GROUP BY week
),
so2 AS (SELECT *, {rate('transactions', 'sessions', 3)} AS cvr FROM so)"""


def site_overview_sql() -> str:
    return with_both(f"{site_overview_cte()}\nSELECT * FROM so2 ORDER BY week")


def annotate_changes_sql() -> str:
    return with_both(f"""{site_overview_cte()},
ch AS ({change_values(P.changes)})
SELECT c.change_date, c.change_label, s.week, s.sessions, s.transactions, s.revenue, s.cvr,
  CAST(date_diff('day', c.change_date, s.week) AS INTEGER) AS days_ahead, s.week IS NOT NULL AS week_in_data
FROM ch c LEFT JOIN so2 s ON TRUE
QUALIFY row_number() OVER (PARTITION BY c.change_date, c.change_label ORDER BY abs(date_diff('day', c.change_date, s.week)), s.week) = 1
ORDER BY c.change_date
""")


def sale_overlay_sql() -> str:
    rows = ", ".join(f"(DATE '{x.start}', DATE '{x.end}', '{x.label}')" for x in P.sale_periods)
    return with_both(f"""{site_overview_cte()},
periods AS (SELECT * FROM (VALUES {rows}) AS t(sale_start, sale_end, sale_label)),
per_week AS (
  SELECT s.week, string_agg(DISTINCT p.sale_label, '; ' ORDER BY p.sale_label) AS sale_labels
  FROM so2 s JOIN periods p ON s.week >= p.sale_start AND s.week < p.sale_end
  GROUP BY s.week
)
SELECT s.week, s.sessions, s.transactions, s.revenue, s.cvr, w.sale_labels, w.sale_labels IS NOT NULL AS in_sale
FROM so2 s LEFT JOIN per_week w ON w.week = s.week
ORDER BY s.week
""")


def step_dropoff_sql() -> str:
    rates = SITE_RATES + [("shipping_to_purchase_rate", "purchase", "add_shipping_info")]
    rate_cols = ",\n  ".join(f"{rate(n, d, 2)} AS {name}" for name, n, d in rates)
    drop_cols = ",\n  ".join(f"{rhu('100.0 - ' + name, 2)} AS {name.replace('_rate', '_dropoff')}"
                              for name, _, _ in rates)
    return with_site(f"""{weekly_funnel_cte(P.start)},
r AS (SELECT *, {rate_cols} FROM weekly_funnel)
SELECT *, {drop_cols} FROM r ORDER BY week
""")


def category_summary_sql() -> str:
    q1 = sales_weekly_sql(["category"], "category")
    return f"""SELECT category, COUNT(*) AS weeks,
  CAST(SUM(sessions) AS BIGINT) AS sessions,
  CAST(SUM(transactions) AS BIGINT) AS transactions,
  {money2('FSUM(revenue)')} AS revenue,
  CAST(SUM(add_to_cart) AS BIGINT) AS add_to_cart,
  CAST(SUM(began_checkout) AS BIGINT) AS began_checkout,
  {rate('SUM(transactions)', 'SUM(sessions)', 3)} AS cvr
FROM ({q1}) q1
GROUP BY category ORDER BY category"""


# --- primitive operators -----------------------------------------------------------


def week_bucket_sql() -> str:
    return with_items(f"""
d AS (SELECT event_date, COUNT(*) AS events FROM item_events WHERE {scan(P.start)} GROUP BY event_date)
SELECT event_date, CAST(date_trunc('week', strptime(event_date, '%Y%m%d')) AS DATE) AS week, events
FROM d ORDER BY event_date
""")


def explode_items_sql() -> str:
    return with_items(f"""
x AS (SELECT * FROM item_events WHERE {scan(P.start)})
SELECT event_name, COUNT(*) AS item_rows, CAST(SUM(quantity) AS BIGINT) AS units,
  {money2('FSUM(item_rev_u)')} AS revenue
FROM x GROUP BY event_name ORDER BY event_name
""")


def event_param_sql() -> str:
    return with_site(f"""
x AS (SELECT * FROM site_events WHERE {scan(P.start)})
SELECT week, COUNT(*) AS events, COUNT(session_id) AS with_session, COUNT(DISTINCT session_id) AS sessions
FROM x GROUP BY week ORDER BY week
""")


def clean_categories_sql() -> str:
    block = f"AND category NOT IN ({sql_list(P.blocklist)}) " if P.blocklist else ""
    c = f"length(category) > 2 AND regexp_matches(category, '^[A-Z]') {block}"
    return with_items(f"""
x AS (SELECT * FROM item_events WHERE {scan(P.start)})
SELECT category, COUNT(*) AS item_rows,
  CAST(count_if(category IS NOT NULL AND category <> '' AND {c}) AS BIGINT) AS kept_by_category,
  CAST(count_if(subcategory IS NOT NULL AND subcategory <> '' AND {c}) AS BIGINT) AS kept_by_subcategory
FROM x GROUP BY category ORDER BY category
""")


def top_products_sql() -> str:
    return with_items(f"""
purchases AS (
  SELECT week, product_name, category, subcategory, {money2('FSUM(item_rev_u)')} AS revenue
  FROM item_events
  WHERE {scan(P.start)} AND event_name = 'purchase' AND product_name IS NOT NULL
  GROUP BY ALL
)
SELECT product_name, CAST(SUM({hundredths('revenue')}) AS BIGINT) AS revenue_cents
FROM purchases GROUP BY product_name
ORDER BY revenue_cents DESC NULLS LAST, product_name LIMIT {P.top_products}
""")


def topk_semi_join_sql() -> str:
    return with_items(f"""
products AS (
  SELECT product_name, COUNT(*) AS item_rows, CAST(SUM(quantity) AS BIGINT) AS units, COUNT(DISTINCT transaction_id) AS orders
  FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND product_name IS NOT NULL
  GROUP BY product_name
)
SELECT product_name, item_rows, units FROM products
QUALIFY row_number() OVER (ORDER BY orders DESC, product_name) <= {P.top_units}
ORDER BY product_name
""")


def range_join_changes_sql() -> str:
    cols = ", ".join(MEASURES)
    return with_site(f"""{near_changes_cte()}
SELECT change_label, CASE WHEN days < 0 THEN 'before' ELSE 'after' END AS period, week, {cols}
FROM near ORDER BY change_label, week
""")


def order_dedup_sql() -> str:
    return with_items(f"""
lines AS (
  SELECT DISTINCT week, category, transaction_id,
    first_value(order_rev_u) OVER (PARTITION BY week, category, transaction_id ORDER BY order_rev_u DESC NULLS LAST) AS most
  FROM item_events WHERE {scan(P.start_recent)} AND event_name = 'purchase' AND {clean('category')}
)
SELECT week, category, transaction_id, {money('most')} AS order_revenue FROM lines ORDER BY ALL
""")


def assign_tier_sql() -> str:
    return with_items(f"""
ie AS (
  SELECT * FROM item_events
  WHERE {scan(P.start_recent)} AND event_name IN ('purchase','add_to_cart','view_item','begin_checkout')
    AND {clean('category')}
)
SELECT {tier_case()} AS delivery_tier, subcategory, category, COUNT(*) AS item_rows
FROM ie GROUP BY ALL ORDER BY 1, 2, 3
""")


def approx_viewers_sql() -> str:
    """The estimate is the exact count here: up to 1,536 values a sketch of 2^14 registers still lists its values."""
    return with_items(f"""
v AS (
  SELECT week, category, user_pseudo_id FROM item_events
  WHERE {scan(P.start_recent)} AND event_name = 'view_item' AND {clean('category')}
),
n AS (SELECT week, category, COUNT(DISTINCT user_pseudo_id) AS viewers FROM v GROUP BY GROUPING SETS ((week, category), (category)))
SELECT week, category, viewers, viewers AS estimate, TRUE AS within_error FROM n ORDER BY category, week
""")


def iso_funnel_sql() -> str:
    cols = ", ".join(MEASURES)
    return with_site(f"""{weekly_funnel_cte(P.start)}
SELECT strftime(week, '%Y-%m-%d') AS week, {cols} FROM weekly_funnel ORDER BY week""")


def scan_events_sql(start: str, end: str) -> str:
    return with_site(f"""
x AS (SELECT * FROM site_events WHERE event_date BETWEEN '{start}' AND '{end}')
SELECT event_date, event_name, COUNT(*) AS events FROM x GROUP BY ALL ORDER BY 1, 2
""")


def oracle_queries() -> dict[str, str]:
    return {
        "category_weekly": sales_weekly_sql(["category"], "category"),
        "subcategory_weekly": sales_weekly_sql(["category", "subcategory"], "subcategory"),
        "product_weekly": product_weekly_sql(),
        "funnel_weekly": funnel_weekly_sql(),
        "aov_weekly": aov_weekly_sql(),
        "units_per_tx": units_per_tx_sql(),
        "change_impact": change_impact_sql(),
        "change_impact_subcategory": change_impact_subcategory_sql(),
        "change_impact_product": change_impact_product_sql(),
        "category_funnel": segment_funnel_sql(["category"], "category"),
        "subcategory_funnel": segment_funnel_sql(["category", "subcategory"], "subcategory"),
        "product_funnel": product_funnel_sql(),
        "delivery_tier_weekly": delivery_tier_weekly_sql(),
        "funnel_change_impact": funnel_change_impact_sql(),
        "annotate_changes": annotate_changes_sql(),
        "sale_overlay": sale_overlay_sql(),
        "site_overview": site_overview_sql(),
        "step_dropoff": step_dropoff_sql(),
        "category_summary": category_summary_sql(),
        "week_bucket": week_bucket_sql(),
        "explode_items": explode_items_sql(),
        "event_param": event_param_sql(),
        "clean_categories": clean_categories_sql(),
        "top_products": top_products_sql(),
        "topk_semi_join": topk_semi_join_sql(),
        "range_join_changes": range_join_changes_sql(),
        "anchor_left_join": sales_weekly_sql(["category"], "category"),
        "order_dedup": order_dedup_sql(),
        "before_after_union": funnel_change_impact_sql(),
        "assign_tier": assign_tier_sql(),
        "assign_tier_table": assign_tier_sql(),
        "approx_viewers": approx_viewers_sql(),
        "iso_dates": iso_funnel_sql(),
        "json_sink": iso_funnel_sql(),
        "scan_events": scan_events_sql(*FIXTURE_SCAN_WINDOW),
        "funnel_weekly_stream": funnel_weekly_sql(),
    }
