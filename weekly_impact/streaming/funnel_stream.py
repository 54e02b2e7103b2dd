"""Incremental refresh of the weekly site funnel (Q4): the weeks of changed shards are recomputed.

Each run lists the shard files and compares the listing with the one stored
by the last run (see :mod:`weekly_impact.sources.manifest`), so that new,
late, rewritten, emptied and deleted shards all name their weeks.  Exactly
these weeks are recomputed from the event table (a scan with a partition
filter) and their partitions of the result are overwritten; a week that has
no funnel event any more becomes a row without counts, which the reader
leaves out.  The listing is stored after the result: a run that fails is
repeated by the next one, and repeating it writes the same rows.

``watch_weekly_funnel`` repeats this as a Structured Streaming query whose
clock is a rate source.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import event_week
from ..operators.funnel import FUNNEL_STEPS, funnel_counts
from ..session import materialize, scratch_scope
from ..sources.events import read_events
from ..sources.manifest import LISTING, changed_days, list_shards
from ..sources.publish import Publication


def refresh_weekly_funnel(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    state_path: str,
    start: str = "20230101",
    end: str | None = None,
) -> list[_dt.date]:
    """One incremental run; the weeks that were recomputed (none if no shard changed)."""
    state = Publication(spark, state_path)
    with scratch_scope(spark):
        now = materialize(list_shards(spark, source_path, start, end), "listing")
        old = spark.read.schema(LISTING).parquet(state.path("shards")) if state.current() else spark.createDataFrame([], LISTING)
        weeks = [r["week"] for r in changed_days(old, now).select(event_week("event_date").alias("week")).distinct().collect()]  # calendar weeks
        if weeks:
            days = [(w + _dt.timedelta(days=i)).strftime("%Y%m%d") for w in weeks for i in range(7)]
            events = read_events(spark, source_path, start, end).where(F.col("event_date").isin(days))
            touched = spark.createDataFrame([(w,) for w in weeks], "week date")
            (
                touched.join(funnel_counts(events), "week", "left").write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("week")
                .parquet(table_path)
            )
            version = state.stage()
            now.write.parquet(state.path("shards", version))
            state.swap(version)
    return sorted(weeks)


def watch_weekly_funnel(
    spark: SparkSession,
    source_path: str,
    table_path: str,
    state_path: str,
    checkpoint_path: str,
    start: str = "20230101",
    every: str = "1 hour",
) -> StreamingQuery:
    """A running query that refreshes the result ``every`` so often."""

    def run(batch: DataFrame, epoch_id: int) -> None:  # noqa: ARG001 - the shards decide, not the clock's rows
        refresh_weekly_funnel(batch.sparkSession, source_path, table_path, state_path, start)

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.option("checkpointLocation", checkpoint_path).foreachBatch(run).trigger(processingTime=every).start()


def read_weekly_funnel(spark: SparkSession, table_path: str) -> DataFrame:
    """The refreshed result table (one row per week with funnel events)."""
    cols = [c for _, c in FUNNEL_STEPS]
    table = spark.read.parquet(table_path).where(F.col(cols[0]).isNotNull())
    return table.select(F.col("week").cast("date").alias("week"), *cols)
