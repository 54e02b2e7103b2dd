"""weekly_impact: weekly e-commerce funnel and change-impact analytics on Spark.

Typical use::

    from weekly_impact import read_events, queries, Params
    events = read_events(spark, "/data/events", start="20230101")
    queries.category_weekly(events, Params(blocklist=("shop",))).write.parquet(...)
"""

from .plans import queries
from .plans.incremental import refresh_incremental
from .plans.params import FIXTURE_PARAMS, REFERENCE_PARAMS, Params
from .plans.refresh import refresh, refresh_results
from .sources.dimensions import Change, SalePeriod
from .sources.events import read_events, write_events
from .sources.publish import read_published

__all__ = [
    "FIXTURE_PARAMS",
    "REFERENCE_PARAMS",
    "Change",
    "Params",
    "SalePeriod",
    "queries",
    "read_events",
    "read_published",
    "refresh",
    "refresh_incremental",
    "refresh_results",
    "write_events",
]
