"""Golden test: the published site funnel impact recomputed from the published weekly funnel."""

import datetime as dt

import pytest

from golden_funnel import FUNNEL_IMPACT, WEEKLY_FUNNEL
from weekly_impact.operators.impact import before_after_union, period_averages
from weekly_impact.plans.params import REFERENCE_PARAMS
from weekly_impact.plans.queries import FUNNEL_MEASURES, funnel_impact_output
from weekly_impact.sources.dimensions import changes_df

SCHEMA = "week DATE, " + ", ".join(f"{m} BIGINT" for m in FUNNEL_MEASURES)


@pytest.fixture(scope="module")
def weekly(spark):
    rows = [(dt.date.fromisoformat(r[0]), *r[1:]) for r in WEEKLY_FUNNEL]
    return spark.createDataFrame(rows, SCHEMA)


def _rows(df):
    return [tuple(r) for r in df.collect()]


def test_funnel_change_impact_matches_published(spark, weekly):
    avgs = period_averages(weekly, changes_df(spark, REFERENCE_PARAMS.funnel_changes), FUNNEL_MEASURES)
    assert _rows(funnel_impact_output(avgs)) == FUNNEL_IMPACT


def test_union_shape_gives_the_same(spark, weekly):
    avgs = before_after_union(weekly, changes_df(spark, REFERENCE_PARAMS.funnel_changes), FUNNEL_MEASURES)
    assert _rows(funnel_impact_output(avgs)) == FUNNEL_IMPACT


def test_mid_week_change_week_counts_before(spark, weekly):
    # 2025-04-01 is a Tuesday: the week of 2025-03-31 belongs to "before".
    from weekly_impact.operators.impact import range_join_changes

    j = range_join_changes(weekly, changes_df(spark, REFERENCE_PARAMS.funnel_changes[:1]))
    got = {(r.week.isoformat(), r.period) for r in j.select("week", "period").collect()}
    assert ("2025-03-31", "before") in got and ("2025-04-07", "after") in got
    assert len(got) == 8 and ("2025-03-03", "before") not in got and ("2025-05-05", "after") not in got
