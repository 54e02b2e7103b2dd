"""Cases that the fixture tables don't reach: unbought products, small money digits, bad dates, rewritten shards."""

import pytest
from pyspark.sql import functions as F

from weekly_impact.functions.dates import event_week
from weekly_impact.functions.tiers import assign_tier
from weekly_impact.plans import queries as Q
from weekly_impact.plans.params import FIXTURE_PARAMS, REFERENCE_PARAMS, Params
from weekly_impact.plans.registry import site_events
from weekly_impact.sources.events import EVENT_SCHEMA, write_events
from weekly_impact.streaming import read_weekly_funnel, refresh_weekly_funnel

SF = "/root/testdata/sf0.001"


def event(name, user, product, order=None, price=1.0, date="20250106"):
    return (name, user, [], (order, price if order else None), [(product, "BEDS", "Frames", price, 1)], date)


def test_product_funnel_lists_bought_products_only(spark):
    rows = [event(n, "u", p, "o" if n == "purchase" else None) for p in ("bought", "carted") for n in ("view_item", "add_to_cart")]
    rows += [event("purchase", "u", "bought", "o1"), event("view_item", "u", "no order id"), event("purchase", "u", "no order id")]
    out = Q.product_funnel(spark.createDataFrame(rows, EVENT_SCHEMA), Params(end="20251231")).collect()
    assert {r.product_name for r in out} == {"bought", "no order id"}


def test_money_keeps_small_digits(spark):
    rows = [event("purchase", "u", "p", f"o{i}", 1.00004) for i in range(10_000)] + [event("view_item", "u", "p")]
    out = Q.category_weekly(spark.createDataFrame(rows, EVENT_SCHEMA), Params(end="20251231")).collect()
    assert [r.revenue for r in out] == [10000.4]


@pytest.mark.parametrize("text", ["2025+4+1", "2025 4 1", "2025-4-1", "202504"])
def test_malformed_dates_raise(spark, text):
    with pytest.raises(Exception, match="(?i)pars|cast|date"):
        spark.createDataFrame([(text,)], "d string").select(event_week(F.col("d"))).collect()


def test_published_tiers(spark):
    rows = [("Benches", "DINING"), ("Sofas", "X"), ("Hammocks", "GARDEN"), (None, "X")]
    df = spark.createDataFrame(rows, "subcategory string, category string")
    got = [r.t for r in df.select(assign_tier(REFERENCE_PARAMS.tiers).alias("t")).collect()]
    assert got == ["Medium £69 (B&S)", "Large £99 (B&S)", "Garden (Free/£29)", "Other"]


def test_stream_follows_rewritten_and_late_shards(spark, tmp_path):
    ev = site_events(spark, SF)
    shards, table, ckpt = (str(tmp_path / n) for n in ("shards", "table", "ckpt"))
    days = sorted(r.event_date for r in ev.select("event_date").distinct().collect())
    late, again = days[0], days[-1]
    write_events(ev.where(F.col("event_date") != late), shards)
    refresh_weekly_funnel(spark, shards, table, ckpt, start="19950101")
    fewer = ev.where((F.col("event_date") == again) & (F.col("event_name") != "view_item"))
    fewer.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(shards)
    write_events(ev.where(F.col("event_date") == late), shards, mode="append")
    refresh_weekly_funnel(spark, shards, table, ckpt, start="19950101")
    now = ev.where((F.col("event_date") != again) | (F.col("event_name") != "view_item"))
    want, got = Q.funnel_weekly(now, FIXTURE_PARAMS), read_weekly_funnel(spark, table)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_drops_a_week_without_funnel_events(spark, tmp_path):
    shards, table, ckpt = (str(tmp_path / n) for n in ("shards", "table", "ckpt"))
    two = [event("view_item", "u", "p"), event("purchase", "u", "p", "o", date="20250114")]
    write_events(spark.createDataFrame(two, EVENT_SCHEMA), shards)
    refresh_weekly_funnel(spark, shards, table, ckpt)
    assert read_weekly_funnel(spark, table).count() == 2
    other = spark.createDataFrame([event("scroll", "u", "p")], EVENT_SCHEMA)
    other.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(shards)
    refresh_weekly_funnel(spark, shards, table, ckpt)
    assert [(str(r.week), r.purchase) for r in read_weekly_funnel(spark, table).collect()] == [("2025-01-13", 1)]


def test_money_at_the_edges(spark):
    from weekly_impact.functions.numeric import mean, money_units, units_to_money

    df = spark.createDataFrame([(1.5,), (1e21,), (float("nan"),), (float("inf"),), (-1e20,), (None,), (2.5,)], "d double")
    units = money_units(F.col("d"))
    r = df.select(units_to_money(F.sum(units)).alias("total"), mean(units).alias("mean"), F.count(units).alias("n")).first()
    assert (r.total, r.mean, r.n) == (4.0, 2.0, 2)
