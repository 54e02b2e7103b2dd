"""Plan checks: no cross joins or nested loops, pushdown, no Expand in the one-pass rewrite."""

import re

import pytest

import __spark_entry__ as E
from weekly_impact.plans import queries as Q
from weekly_impact.plans.params import FIXTURE_PARAMS
from weekly_impact.plans.registry import all_queries, item_events, site_events

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_no_cartesian_or_nested_loop(spark, key):
    p = plan(E.queries()[key](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_one_pass_weekly_has_no_expand(spark):
    p = plan(Q.category_weekly(item_events(spark, SF), FIXTURE_PARAMS))
    assert "Expand" not in p


def test_order_side_is_shuffled_not_broadcast(spark):
    p = plan(item_events(spark, SF))
    assert "SortMergeJoin" in p and "orders.parquet" not in p.split("BroadcastExchange")[-1]


def test_change_windows_are_broadcast_hash_joins(spark):
    p = plan(Q.funnel_change_impact(spark, site_events(spark, SF), FIXTURE_PARAMS))
    assert "BroadcastHashJoin" in p


def test_scan_prunes_columns(spark):
    p = plan(Q.funnel_weekly(site_events(spark, SF), FIXTURE_PARAMS))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in p


@pytest.mark.parametrize("key", ["category_weekly", "subcategory_weekly", "category_funnel", "delivery_tier_weekly"])
def test_one_pass_queries_scan_each_table_once(spark, key):
    p = plan(E.queries()[key](spark, SF))
    for t in ("orders.parquet", "lineitem.parquet", "part.parquet"):
        assert p.count(t) == 1, (key, t)


def test_event_scan_uses_partition_filter(spark, tmp_path):
    from weekly_impact.plans.registry import site_events as se
    from weekly_impact.sources.events import read_events, write_events

    path = str(tmp_path / "shards")
    write_events(se(spark, SF), path)
    p = plan(read_events(spark, path, "20240108", "20240121").groupBy("event_name").count())
    assert "PartitionFilters: [isnotnull(event_date" in p and "20240108" in p


def test_distinct_counts_shuffle_on_the_distinct_key_too(spark):
    # A hot (week, category) is spread: the first shuffle of the one-pass
    # aggregate hashes the user / order key as well as the group keys.
    p = plan(Q.category_weekly(item_events(spark, SF), FIXTURE_PARAMS))
    parts = [seg for seg in p.split("hashpartitioning(")[1:]]
    first = [seg.split(")")[0] for seg in parts if "event_name" in seg.split(")")[0]]
    assert first and any("_dkey" in s or "_groupingexpression" in s for s in first)


@pytest.mark.parametrize("key", ["product_weekly", "units_per_tx", "product_funnel", "change_impact_product"])
def test_top_k_is_take_ordered_not_a_global_sort(spark, key):
    # Each partition keeps its own top K; one task merges K rows per partition.
    p = plan(E.queries()[key](spark, SF))
    assert "TakeOrderedAndProject" in p and "SinglePartition" not in p


def _broadcast_subtrees(p):
    lines = p.splitlines()
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            depth = len(line) - len(line.lstrip(" :+-"))
            sub = []
            for nxt in lines[i + 1:]:
                if len(nxt) - len(nxt.lstrip(" :+-")) <= depth:
                    break
                sub.append(nxt)
            yield "\n".join(sub)


@pytest.mark.parametrize("key", sorted(all_queries()))
def test_broadcasts_are_bounded(spark, key):
    for sub in _broadcast_subtrees(plan(E.queries()[key](spark, SF))):
        bounded = "TakeOrderedAndProject" in sub or not any(
            t in sub for t in ("orders.parquet", "lineitem.parquet", "events.parquet", "Relation[")
        )
        assert bounded, sub[:500]


ITEM_READS = {
    "aov_weekly": {"item_category"},
    "category_funnel": {"item_category"},
    "subcategory_funnel": {"item_category", "item_category2"},
    "category_weekly": {"item_category", "price", "quantity"},
}


def test_item_scan_reads_only_the_used_item_fields(spark, tmp_path):
    from weekly_impact.plans.registry import all_events
    from weekly_impact.sources.events import ITEM, read_events, write_events

    path = str(tmp_path / "shards")
    write_events(all_events(spark, SF), path)
    for name, used in ITEM_READS.items():
        spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
        try:
            text = plan(getattr(Q, name)(read_events(spark, path), FIXTURE_PARAMS))
        finally:
            spark.conf.unset("spark.sql.maxMetadataStringLength")
        schema = re.search(r"ReadSchema: (.*)", text).group(1)
        read = re.search(r"items:array<struct<(.*?)>>", schema).group(1)
        assert {f.split(":")[0] for f in read.split(",")} == used, (name, schema)
        assert used < set(ITEM.names)


def test_refresh_fact_is_filtered_by_folder(spark):
    from weekly_impact.plans.refresh import refresh_results
    from weekly_impact.plans.registry import all_events

    results = refresh_results(spark, all_events(spark, SF), FIXTURE_PARAMS)
    for name in ("aov_weekly", "change_impact", "change_impact_subcategory"):
        assert re.search(r"PartitionFilters: \[[^]]*event_name", plan(results[name])), name
