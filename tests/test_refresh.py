"""The one-scan refresh gives the same 14 results as the queries run one by one."""

import os
import tempfile

from weekly_impact.plans import queries as Q
from weekly_impact.plans.params import FIXTURE_PARAMS
from weekly_impact.plans.refresh import OVERLAYS, refresh, refresh_results
from weekly_impact.plans.registry import CORE_QUERIES, all_events
from weekly_impact.sources.publish import Publication

SF = "/root/testdata/sf0.001"


def test_refresh_equals_individual_queries(spark):
    events = all_events(spark, SF)
    results = refresh_results(spark, events, FIXTURE_PARAMS)
    assert set(results) == set(CORE_QUERIES)
    # The site-funnel queries count every event of the table they are given.
    site = {
        "funnel_weekly": Q.funnel_weekly(events, FIXTURE_PARAMS),
        "funnel_change_impact": Q.funnel_change_impact(spark, events, FIXTURE_PARAMS),
    }
    for name, df in results.items():
        single = site.get(name) or CORE_QUERIES[name](spark, SF)
        assert df.columns == single.columns, name
        assert df.exceptAll(single).count() == 0 and single.exceptAll(df).count() == 0, name


def test_refresh_writes_every_result(spark):
    out = tempfile.mkdtemp(prefix="wi-refresh-", dir="/tmp")
    names = refresh(spark, all_events(spark, SF), out, FIXTURE_PARAMS, fmt="parquet")
    where = Publication(spark, out).path("")
    assert sorted(os.listdir(where)) == sorted(names) == sorted([*CORE_QUERIES, *OVERLAYS])
