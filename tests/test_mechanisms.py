"""Window pruning, nearest-row join, bucketed joins, sketches and tiers from a table."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from weekly_impact.functions.dates import mondays_in
from weekly_impact.functions.tiers import TierRule, assign_tier, assign_tier_from_table, tier_table
from weekly_impact.operators.asof import nearest_join
from weekly_impact.operators.impact import window_shards
from weekly_impact.operators.overlay import annotate_changes
from weekly_impact.operators.sketches import distinct_sketch, estimate, relative_error, unite_sketches
from weekly_impact.operators.weekly import anchor_left_join, distinct, rows, total, weekly_metrics
from weekly_impact.plans import queries as Q
from weekly_impact.plans.extras import before_after_union_q, range_join_changes_q
from weekly_impact.plans.params import FIXTURE_PARAMS
from weekly_impact.plans.registry import all_events, item_events, site_events
from weekly_impact.session import materialize
from weekly_impact.sources.dimensions import Change, changes_df
from weekly_impact.sources.events import read_events, write_events

SF = "/root/testdata/sf0.001"


def plan(df):
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


# --- windows ---------------------------------------------------------------


def test_window_shards_hold_exactly_the_windows_weeks(spark):
    rng = random.Random(0)
    for _ in range(30):
        days = rng.choice([1, 5, 7, 28])
        changes = [Change((dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 200))).isoformat(), "x") for _ in range(rng.randint(0, 3))]
        kept = set()
        for a, z in window_shards(changes, days):
            day, last = dt.datetime.strptime(a, "%Y%m%d").date(), dt.datetime.strptime(z, "%Y%m%d").date()
            while day <= last:
                kept.add(day)
                day += dt.timedelta(days=1)
        want = set()
        for c in changes:
            d = dt.date.fromisoformat(c.date)
            for i in range(-days, days):
                if (m := d + dt.timedelta(days=i)).weekday() == 0:
                    want |= {m + dt.timedelta(days=j) for j in range(7)}
        assert kept == want, (changes, days)
    d = dt.date(2024, 3, 27)
    got = spark.range(1).select(mondays_in(F.lit(d - dt.timedelta(28)), F.lit(d + dt.timedelta(28)))).first()[0]
    assert window_shards([Change("2024-03-27", "x")]) == [(got[0].strftime("%Y%m%d"), (got[-1] + dt.timedelta(6)).strftime("%Y%m%d"))]


@pytest.mark.parametrize("key, changes", [
    ("change_impact", "changes"), ("change_impact_subcategory", "changes"), ("funnel_change_impact", "funnel_changes"),
    ("range_join_changes", "funnel_changes"), ("before_after_union", "funnel_changes")])
def test_only_the_windows_shards_are_read(spark, tmp_path, key, changes):
    shards = str(tmp_path / "s")
    near = all_events(spark, SF).where("event_date between '19970101' and '19970615' or event_date > '2024'")  # few folders
    write_events(near, shards)
    run = {"range_join_changes": range_join_changes_q, "before_after_union": before_after_union_q}.get(key) or getattr(Q, key)
    read = read_events(spark, shards, "19950101")
    text = plan(run(spark, read, FIXTURE_PARAMS))
    spans = window_shards(getattr(FIXTURE_PARAMS, changes))
    filters = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", text)
    assert filters and all("event_date#" in f and all(f">= {a}" in f and f"<= {z}" in f for a, z in spans) for f in filters)
    whole = run(spark, near, FIXTURE_PARAMS)
    assert whole.count() and same(run(spark, read, FIXTURE_PARAMS), whole)


# --- nearest row ------------------------------------------------------------


def test_nearest_join_equals_brute_force(spark):
    rng = random.Random(1)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randint(0, 60))
    left = [(i, rng.choice("abc"), day() if rng.random() < 0.9 else None) for i in range(200)]
    right = [(rng.choice("ab"), day() if rng.random() < 0.95 else None, rng.randint(0, 9)) for _ in range(40)]
    a = spark.createDataFrame(left, "i int, k string, at date")
    b = spark.createDataFrame(right, "k string, d date, v int")
    for by in (["k"], []):
        r = b if by else b.drop("k")
        got = {x.i: (x.d, x.v) for x in nearest_join(a, r, "at", "d", by).collect()}
        for i, k, at in left:
            near = [(abs((d - at).days), d, v) for kk, d, v in right if d and (not by or kk == k)] if at else []
            assert got[i] == ((min(near)[1:]) if near else (None, None)), (i, by)
    with pytest.raises(ValueError):
        nearest_join(a, b.withColumnRenamed("d", "at"), "at", "at", ["k"])


def test_annotate_takes_the_closest_present_week(spark):
    weeks = [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 22), 2), (dt.date(2024, 2, 5), 3)]
    weekly = spark.createDataFrame(weeks, "week date, n int")
    changes = changes_df(spark, [Change("2024-01-09", "its Monday is absent"), Change("2024-01-29", "a tie"), Change("2030-01-01", "far")])
    got = {r.change_label: (str(r.week), r.n, r.days_ahead, r.week_in_data) for r in annotate_changes(weekly, changes).collect()}
    assert got == {"its Monday is absent": ("2024-01-01", 1, -8, True), "a tie": ("2024-01-22", 2, -7, True), "far": ("2024-02-05", 3, -2157, True)}
    none = annotate_changes(weekly.limit(0), changes).collect()
    assert len(none) == 3 and not any(r.week_in_data for r in none) and all(r.week is None for r in none)


# --- bucketed joins ------------------------------------------------------------


def _anchor(spark, keys, others_keys):
    fact = Q.sales_fact(item_events(spark, SF), FIXTURE_PARAMS, FIXTURE_PARAMS.start, Q.SALES_EVENTS, "category")
    fact = fact.where("subcategory is not null")
    first = distinct("sessions", "view_item", "user_pseudo_id")
    others = [distinct("transactions", "purchase", "transaction_id"), total("rev", "purchase", "item_rev_u"), rows("carts", "add_to_cart")]
    return fact, first, others, anchor_left_join(fact, keys, first, [(m, others_keys) for m in others])


def test_anchor_joins_need_no_exchange_and_read_the_fact_once(spark):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact, first, others, out = _anchor(spark, ["category"], ["category"])
        text = plan(out)
        assert text.count("SortMergeJoin") == 3 and "Exchange" not in text and "lineitem" not in text
        want = weekly_metrics(fact, ["category"], [first, *others], anchor="view_item")
        filled = out.fillna(0, ["transactions", "carts"]).select(*want.columns)
        assert same(filled, want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_anchor_join_on_fewer_keys_counts_a_user_once(spark):
    fact, _, _, out = _anchor(spark, ["category", "subcategory"], ["category"])
    want = fact.where("event_name = 'purchase'").groupBy("week", "category").agg(F.count_distinct("transaction_id").alias("n"))
    got = out.select("week", "category", "transactions").where("transactions is not null").distinct()
    assert got.join(want, ["week", "category"]).where("transactions <> n").count() == 0 and got.count() > 0


# --- sketches --------------------------------------------------------------------


def test_sketches_merge_within_the_stated_error(spark):
    df = spark.range(120_000).select((F.col("id") % 7).alias("week"), (F.col("id") % 3).alias("seg"), F.floor(F.col("id") / 2).alias("user"))
    df = df.unionByName(df.withColumn("user", F.lit(None).cast("long")))
    weekly = distinct_sketch(df, ["week", "seg"], "user")
    for keys in (["week", "seg"], ["seg"], ["week"]):
        got = unite_sketches(weekly, keys).select(*keys, estimate().alias("e"))
        want = df.groupBy(*keys).agg(F.count_distinct("user").alias("n"))
        off = got.join(want, keys).select(F.max(F.abs(F.col("e") - F.col("n")) / F.col("n"))).first()[0]
        assert off <= relative_error(), keys
    union_of_parts = unite_sketches(weekly, ["seg"]).agg(F.sum(estimate())).first()[0]
    assert union_of_parts < df.groupBy("week", "seg").agg(F.count_distinct("user").alias("n")).agg(F.sum("n")).first()[0] * 1.05


# --- tiers from a table ---------------------------------------------------------------


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_tier_table_equals_the_case_form(spark, threshold):
    rules = [TierRule("A", ("x", "y")), TierRule("B", ("y", "z")), TierRule("C", ("G", "H"), "category"), TierRule("D", ("w",)), TierRule("E", ("H",), "category")]
    rng = random.Random(2)
    data = [(i, rng.choice(["x", "y", "z", "w", "q", None]), rng.choice(["G", "H", "K", None])) for i in range(300)]
    df = spark.createDataFrame(data, "i int, subcategory string, category string")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        got = assign_tier_from_table(df, materialize(tier_table(spark, rules), "rules"))
        assert ("BroadcastHashJoin" in plan(got)) == (threshold != "-1")
        assert same(got, df.withColumn("delivery_tier", assign_tier(rules)))
        assert same(assign_tier_from_table(df, tier_table(spark, []), default="none"), df.withColumn("delivery_tier", F.lit("none")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_scratch_scopes_nest_and_clean_up(spark):
    from weekly_impact.session import release, scratch_scope
    from weekly_impact.sources import files

    outer = materialize(spark.range(3), "outer")
    with pytest.raises(RuntimeError), scratch_scope(spark):
        inner = materialize(spark.range(4), "inner")
        path = inner._scratch
        assert inner.count() == 4
        raise RuntimeError
    assert not files.exists(spark, path) and outer.count() == 3
    release(outer)
    assert not files.exists(spark, outer._scratch)
