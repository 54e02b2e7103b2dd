"""Scalar helpers: rounding, Monday weeks, windows, params, noise filter, tiers."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weekly_impact.functions import (
    TierRule,
    assign_tier,
    clean_categories,
    closest_monday,
    event_param,
    event_week,
    mondays_in,
    round_half_up,
    week_start,
)
from weekly_impact.sources.events import EVENT_PARAMS


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(1.005, 2), (2.675, 2), (-2.25, 1), (170380.25, 1), (5018.75, 1)], "x double, n int")
    got = [r[0] for r in df.select(
        F.when(F.col("n") == 2, round_half_up(F.col("x"), 2)).otherwise(round_half_up(F.col("x"), 1))
    ).collect()]
    assert got == [1.01, 2.68, -2.3, 170380.3, 5018.8]


def test_week_start_is_monday(spark):
    df = spark.createDataFrame([("20240107",), ("20240108",), ("20250101",)], "event_date string")
    got = [r[0].isoformat() for r in df.select(event_week("event_date")).collect()]
    assert got == ["2024-01-01", "2024-01-08", "2024-12-30"]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.dates(dt.date(1990, 1, 1), dt.date(2040, 12, 31)), min_size=1, max_size=50))
def test_28_day_windows_hold_four_mondays(spark, days):
    df = spark.createDataFrame([(d,) for d in days], "d date")
    d = F.col("d")
    before = F.size(mondays_in(F.date_sub(d, 28), d))
    after = F.size(mondays_in(d, F.date_add(d, 28)))
    ok = df.select(((before == 4) & (after == 4)).alias("ok")).collect()
    assert all(r.ok for r in ok)


def test_closest_monday(spark):
    df = spark.createDataFrame(
        [(dt.date(2025, 4, 5),), (dt.date(2025, 4, 1),), (dt.date(2025, 4, 3),), (dt.date(2025, 4, 4),),
         (dt.date(2026, 3, 30),)], "d date")
    got = [r[0].isoformat() for r in df.select(closest_monday(F.col("d"))).collect()]
    assert got == ["2025-04-07", "2025-03-31", "2025-03-31", "2025-04-07", "2026-03-30"]


def test_event_param_missing_is_null(spark):
    rows = [
        ([("ga_session_id", (None, 7, None, None))],),
        ([("other", (None, 1, None, None))],),
        ([],),
        (None,),
    ]
    from pyspark.sql import types as T

    df = spark.createDataFrame(rows, T.StructType([T.StructField("event_params", EVENT_PARAMS)]))
    got = [r[0] for r in df.select(event_param("ga_session_id")).collect()]
    assert got == [7, None, None, None]


def test_noise_filter(spark):
    df = spark.createDataFrame([(None,), ("",), ("XY",), ("abc",), ("Sofas",), ("GARDEN",)], "category string")
    got = [r[0] for r in clean_categories(df, ["Sofas"]).collect()]
    assert got == ["GARDEN"]


def test_noise_filter_subcategory_variant_drops_null_category(spark):
    df = spark.createDataFrame([(None, "Beds"), ("GARDEN", ""), ("GARDEN", "Benches")], "category string, subcategory string")
    got = [tuple(r) for r in clean_categories(df, ["Sofas"], required_col="subcategory").collect()]
    assert got == [("GARDEN", "Benches")]


def test_tier_rules_first_match_wins(spark):
    rules = [TierRule("T2", ("Brand#4", "Brand#7")), TierRule("T3", ("Brand#7", "Brand#8")),
             TierRule("T4", ("PROMO",), "category")]
    df = spark.createDataFrame(
        [("Brand#7", "SMALL"), ("Brand#8", "SMALL"), (None, "PROMO"), (None, "SMALL")],
        "subcategory string, category string")
    got = [r[0] for r in df.select(assign_tier(rules, "Other")).collect()]
    assert got == ["T2", "T3", "T4", "Other"]


def test_week_start_helper_on_dates(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2023, 12, 31),)], "d date")
    assert [r[0] for r in df.select(week_start("d")).collect()] == [dt.date(2024, 1, 1), dt.date(2023, 12, 25)]


def test_event_param_duplicate_key_fails_like_a_scalar_subquery(spark):
    import pytest
    from pyspark.sql import types as T

    rows = [([("ga_session_id", (None, 1, None, None)), ("ga_session_id", (None, 2, None, None))],)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("event_params", EVENT_PARAMS)]))
    with pytest.raises(Exception, match="more than once"):
        df.select(event_param("ga_session_id")).collect()
    assert df.select(event_param("ga_session_id", on_duplicate="first")).collect()[0][0] == 1
