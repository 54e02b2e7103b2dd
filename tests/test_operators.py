"""Hand-made micro fixtures, one per trap (FIXTURES.md section 4)."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from weekly_impact.operators.impact import before_after
from weekly_impact.operators.items import explode_items, item_fact
from weekly_impact.operators.topk import top_k
from weekly_impact.plans import queries as Q
from weekly_impact.plans.params import Params
from weekly_impact.sources.dimensions import Change, changes_df
from weekly_impact.sources.events import EVENT_SCHEMA, read_events, write_events
from weekly_impact.functions.numeric import mean

P = Params(start="20000101", start_recent="20000101", blocklist=("Sofas",), top_products=2)


def item(name, cat="GARDEN", sub="Benches", price=10.0, qty=1):
    return (name, cat, sub, price, qty)


def ev(name, user="u1", items=None, date="20240102", txn=None, rev=None):
    return (name, user, [], (txn, rev), items, date)


def events(spark, rows):
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_empty_and_null_items_vanish(spark):
    df = events(spark, [ev("view_item", items=[]), ev("view_item", items=None),
                        ev("view_item", items=[item("a"), item("b")])])
    assert explode_items(df).count() == 2


def test_anchor_keeps_viewed_groups_only(spark):
    df = events(spark, [
        ev("view_item", user=None, items=[item("a", cat="GARDEN")]),
        ev("purchase", items=[item("b", cat="OFFICE")], txn="T1", rev=10.0),
    ])
    rows = Q.category_weekly(df, P).collect()
    assert [(r.category, r.sessions, r.transactions, r.cvr) for r in rows] == [("GARDEN", 0, 0, None)]


def test_tier_query_anchors_on_purchase(spark):
    p = Params(start="20000101", start_recent="20000101")
    df = events(spark, [
        ev("view_item", items=[item("a", cat="GARDEN", sub="X")]),
        ev("purchase", items=[item("b", cat="OFFICE", sub="Y", price=5.0, qty=2)], txn="T1", rev=10.0),
    ])
    rows = Q.delivery_tier_weekly(df, p).collect()
    assert [(r.delivery_tier, r.transactions, r.revenue, r.product_views, r.pdp_cvr) for r in rows] == [
        ("Other", 1, 10.0, 1, 100.0)
    ]


def test_null_order_counted_in_revenue_not_orders(spark):
    df = events(spark, [
        ev("purchase", items=[item("a")], txn=None, rev=100.0),
        ev("purchase", items=[item("b")], txn=None, rev=50.0),
        ev("purchase", items=[item("c")], txn="A", rev=30.0),
    ])
    r = Q.aov_weekly(df, P).collect()[0]
    assert (r.transactions, r.revenue, r.aov) == (1, 130.0, 65.0)


def test_two_grain_cart_count_repeats(spark):
    df = events(spark, [
        ev("purchase", items=[item("P", cat="GARDEN")], txn="T1", rev=10.0),
        ev("purchase", items=[item("P", cat="OFFICE")], txn="T2", rev=10.0),
        ev("add_to_cart", items=[item("P", cat="GARDEN"), item("P", cat="OFFICE"), item("P", cat="RUGS")]),
    ])
    rows = Q.product_weekly(df, P).collect()
    assert sorted((r.category, r.add_to_cart) for r in rows) == [("GARDEN", 3), ("OFFICE", 3)]


def test_three_aovs_differ(spark):
    df = events(spark, [
        ev("purchase", items=[item("a", price=100.0)] * 3, txn="A", rev=300.0),
        ev("purchase", items=[item("b", price=100.0)], txn="B", rev=100.0),
    ])
    per_order = Q.aov_weekly(df, P).collect()[0].aov
    line_weighted = item_fact(df).select(mean(F.col("order_rev_u"))).collect()[0][0]
    tier = Q.delivery_tier_weekly(df, Params(start="20000101", start_recent="20000101")).collect()[0].aov
    assert (per_order, line_weighted, tier) == (200.0, 250.0, 200.0)


def _weekly(spark, weeks):
    rows = [(dt.date.fromisoformat(w), "GARDEN", n, n * 100) for w, n in weeks]
    return spark.createDataFrame(rows, "week date, category string, transactions bigint, rev_c bigint")


def test_sparse_weeks_average_over_present_weeks(spark):
    weekly = _weekly(spark, [("2024-01-01", 3), ("2024-01-08", 6), ("2024-01-22", 9), ("2024-02-05", 4)])
    ch = changes_df(spark, [Change("2024-01-29", "c", ("GARDEN",))])
    r = before_after(weekly, ch, ["category"], [("tx", "transactions", 1)], require=("tx",)).collect()[0]
    assert (r.avg_tx_before, r.avg_tx_after) == (6.0, 4.0)


def test_one_sided_group_is_dropped(spark):
    weekly = _weekly(spark, [("2024-02-05", 4)])
    ch = changes_df(spark, [Change("2024-01-29", "c", ("GARDEN",))])
    assert before_after(weekly, ch, ["category"], [("tx", "transactions", 1)], require=("tx",)).count() == 0


def test_unaffected_category_is_ignored(spark):
    weekly = _weekly(spark, [("2024-01-22", 4), ("2024-02-05", 4)])
    ch = changes_df(spark, [Change("2024-01-29", "c", ("OFFICE",))])
    assert before_after(weekly, ch, ["category"], [("tx", "transactions", 1)], require=("tx",)).count() == 0


def test_topk_ties_broken_by_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 5), ("d", 9)], "product_name string, v int")
    got = [r.product_name for r in top_k(df, "product_name", F.sum("v"), 3).collect()]
    assert got == ["d", "a", "b"]


def test_shard_bounds_are_string_compares(spark):
    path = tempfile.mkdtemp(prefix="wi-shards-", dir="/tmp") + "/events"
    df = events(spark, [ev("view_item", date="20230101"), ev("view_item", date="20221231"),
                        ev("view_item", date="intraday_20240101")])
    write_events(df, path)
    got = [r.event_date for r in read_events(spark, path, start="20230101").collect()]
    assert got == ["20230101"]
    plan = read_events(spark, path, start="20230101")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


@pytest.mark.parametrize("flag", ["view_item"])
def test_weekly_metrics_equals_join_chain(spark, small_dir, flag):
    from weekly_impact.plans.extras import anchor_left_join_q
    from weekly_impact.plans.params import FIXTURE_PARAMS
    from weekly_impact.plans.registry import item_events

    ev_df = item_events(spark, small_dir)
    a = Q.category_weekly(ev_df, FIXTURE_PARAMS)
    b = anchor_left_join_q(ev_df, FIXTURE_PARAMS)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
