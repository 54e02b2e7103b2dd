"""Dimensions and sinks: change table, sale periods, ISO dates, JSON with nulls, run record."""

import datetime as dt
import json
import os
import tempfile

from weekly_impact.plans.params import REFERENCE_CHANGES
from weekly_impact.sources.dimensions import CURRENT_TIERS, DELIVERY_CHANGES, SALE_PERIODS, Change, changes_df
from weekly_impact.sources.sinks import iso_dates, run_metadata, write_result


def test_change_table_dedupes_categories(spark):
    df = changes_df(spark, [Change("2025-04-01", "x", ("A", "B", "A"))])
    r = df.collect()[0]
    assert (r.change_date, r.change_label, r.affected_categories) == (dt.date(2025, 4, 1), "x", ["A", "B"])


def test_reference_changes_are_three(spark):
    df = changes_df(spark, REFERENCE_CHANGES)
    assert [r.change_date.isoformat() for r in df.collect()] == ["2025-04-01", "2025-08-01", "2026-03-27"]


def test_iso_dates_and_json_keeps_nulls(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1), None, 3)], "week date, rate double, n bigint")
    assert iso_dates(df).collect()[0].week == "2024-01-01"
    path = tempfile.mkdtemp(prefix="wi-json-", dir="/tmp") + "/out"
    write_result(df, path, fmt="json")
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    lines = [json.loads(x) for f in files for x in open(os.path.join(path, f)) if x.strip()]
    assert lines == [{"week": "2024-01-01", "rate": None, "n": 3}]


def test_run_metadata_keeps_the_given_order(spark):
    meta = run_metadata(spark, "proj", DELIVERY_CHANGES, SALE_PERIODS, CURRENT_TIERS)
    rows = meta.collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.project_id == "proj" and r.last_updated.endswith("+00:00")
    assert [(c.date, c.label, c.detail) for c in r.delivery_changes] == [(c.date, c.label, c.detail) for c in DELIVERY_CHANGES]
    assert [(x.start, x.end, x.label, x.detail) for x in r.sale_periods] == [(x.start, x.end, x.label, x.detail) for x in SALE_PERIODS]
    assert [tuple(t) for t in r.current_delivery] == CURRENT_TIERS
    back = run_metadata(spark, "proj", list(reversed(DELIVERY_CHANGES)), (), ()).first()
    assert [c.date for c in back.delivery_changes] == [c.date for c in reversed(DELIVERY_CHANGES)] and back.sale_periods == []


def test_stream_refresh_is_zone_independent(spark, tmp_path):
    from weekly_impact.plans.params import FIXTURE_PARAMS
    from weekly_impact.plans.queries import funnel_weekly
    from weekly_impact.plans.registry import site_events
    from weekly_impact.sources.events import write_events
    from weekly_impact.streaming import read_weekly_funnel, refresh_weekly_funnel

    sf = "/root/testdata/sf0.001"
    shards = str(tmp_path / "shards")
    write_events(site_events(spark, sf), shards)
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        table = str(tmp_path / "table")
        refresh_weekly_funnel(spark, shards, table, str(tmp_path / "ckpt"), start="19950101")
        got = read_weekly_funnel(spark, table)
        want = funnel_weekly(site_events(spark, sf), FIXTURE_PARAMS)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_stream_refresh_is_incremental(spark, tmp_path):
    from pyspark.sql import functions as F

    from weekly_impact.plans.params import FIXTURE_PARAMS
    from weekly_impact.plans.queries import funnel_weekly
    from weekly_impact.plans.registry import site_events
    from weekly_impact.sources.events import write_events
    from weekly_impact.streaming import read_weekly_funnel, refresh_weekly_funnel

    sf = "/root/testdata/sf0.001"
    ev = site_events(spark, sf)
    shards, table, ckpt = (str(tmp_path / n) for n in ("shards", "table", "ckpt"))
    # First run sees the shards up to Wednesday 2024-01-17, the second the rest:
    # the week of 2024-01-15 is split across the two runs.
    write_events(ev.where(F.col("event_date") <= "20240117"), shards, mode="append")
    refresh_weekly_funnel(spark, shards, table, ckpt, start="19950101")
    first = {r.week.isoformat() for r in read_weekly_funnel(spark, table).collect()}
    assert "2024-01-22" not in first and "2024-01-15" in first
    write_events(ev.where(F.col("event_date") > "20240117"), shards, mode="append")
    refresh_weekly_funnel(spark, shards, table, ckpt, start="19950101")
    got = read_weekly_funnel(spark, table)
    want = funnel_weekly(ev, FIXTURE_PARAMS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dimension_df_from_records(spark):
    from weekly_impact.sources.dimensions import dimension_df

    df = dimension_df(spark, [{"tier": "Large", "price": 99}, {"price": 15, "tier": "Small"}], "tier STRING, price INT")
    assert [tuple(r) for r in df.collect()] == [("Large", 99), ("Small", 15)]
