"""Incremental refresh: what the results are made from is kept between runs.

State under one folder:

* the listing of the shard files (see :mod:`weekly_impact.sources.manifest`);
* the item fact and the site funnel's counts, per shard day;
* the segment grain, per week;
* which run wrote each day's and each week's current part.

A run lists the shards, and only the days of changed files are read from the
event table, unnested and counted.  Only the weeks of those days are grouped
again, from the stored fact.  Parts are written under the run's own name and
nothing is overwritten; the new state (a few rows per day) becomes current by
one atomic rename after the results are published, so a run that fails at any
point is as if it had not been.  Replaced parts, and parts that failed runs or
runs with other bounds left, are deleted after the next run that succeeds.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.funnel import FUNNEL_STEPS
from ..operators.items import item_fact
from ..session import materialize, scratch_scope
from ..sources import files
from ..sources.events import read_events
from ..sources.manifest import LISTING, changed_days, list_shards
from ..sources.publish import Publication
from . import queries as Q
from .params import Params
from .refresh import ITEM_EVENTS, funnel_impact_from_weeks, funnel_weeks, item_results, publish_results

FACT, DAYS, GRAIN = "fact", "days", "grain"
PARTITIONED = {FACT: ("event_date", "event_name"), DAYS: ("event_date",), GRAIN: ("week",)}
PARTS = "kind string, part string, run string"


def touched_events(spark: SparkSession, events_path: str, days: list[str], p: Params) -> DataFrame:
    """The events of these shards; the list is a partition filter, so no other shard is opened."""
    return read_events(spark, events_path, min(p.start, p.start_recent), p.end).where(F.col("event_date").isin(days))


def day_counts(events: DataFrame) -> DataFrame:
    """Event counts of the site funnel's steps per shard day."""
    ev = events.select("event_date", "event_name").where(F.col("event_name").isin([e for e, _ in FUNNEL_STEPS]))
    return ev.groupBy("event_date").agg(*[F.count_if(F.col("event_name") == e).alias(c) for e, c in FUNNEL_STEPS])


def monday(day: str) -> str:
    d = _dt.datetime.strptime(day, "%Y%m%d").date()
    return (d - _dt.timedelta(days=d.weekday())).isoformat()


class Store:
    """The parts of one state: ``kind`` -> part (a day or a week) -> the run that wrote it."""

    def __init__(self, spark: SparkSession, root: str, parts: dict[tuple[str, str], str]):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), dict(parts)

    def write(self, kind: str, df: DataFrame, run: str) -> None:
        """Write a run's parts and note those that have rows."""
        base = f"{self.root}/{kind}/run={run}"
        column = PARTITIONED[kind][0]
        # Rebalanced by part: the runtime splits large days and joins small ones by their bytes.
        df.hint("rebalance", F.col(column)).write.partitionBy(*PARTITIONED[kind]).parquet(base)
        for name in files.folders(self.spark, base):
            if name.startswith(f"{column}="):
                self.parts[kind, name.split("=", 1)[1]] = run

    def read(self, kind: str, schema: T.StructType, only: set[str] | None = None) -> DataFrame:
        """The current parts (of ``only``, if given) as one table."""
        column = PARTITIONED[kind][0]
        paths = [f"{self.root}/{kind}/run={r}/{column}={x}" for (k, x), r in sorted(self.parts.items()) if k == kind and (only is None or x in only)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/{kind}").parquet(*paths).select(*schema.names)

    def drop(self, kind: str, parts) -> None:
        for x in parts:
            self.parts.pop((kind, x), None)

    def sweep(self, run: str) -> None:
        """Delete the folders of runs before ``run`` that no part names: of failed runs, of other bounds, or replaced as a whole."""
        used = {(kind, r) for (kind, _), r in self.parts.items()}
        for kind in PARTITIONED:
            for name in files.folders(self.spark, f"{self.root}/{kind}"):
                by = name.removeprefix("run=")
                if by < run and (kind, by) not in used:
                    files.delete(self.spark, f"{self.root}/{kind}/{name}")


def refresh_incremental(
    spark: SparkSession, events_path: str, state_path: str, out_dir: str, p: Params, fmt: str = "json"
) -> dict[str, list[str]]:
    """Publish the 14 results, the overlays and the run record; returns the days and weeks that were computed anew.

    Equal to ``refresh`` over the same shards.  A state made with other scan
    bounds (``start``, ``start_recent``, ``end``) is not used.  Days and weeks
    are calendar-bounded lists, which the driver holds; rows never are.
    """
    state = Publication(spark, state_path)
    store_root = f"{state_path.rstrip('/')}/parts"
    bounds = f"{p.start} {p.start_recent} {p.end or ''}"
    start = min(p.start, p.start_recent)
    with scratch_scope(spark):
        now = materialize(list_shards(spark, events_path, start, p.end), "listing")
        known = state.current() and files.read_text(spark, state.path("bounds.txt")) == bounds
        old = spark.read.schema(LISTING).parquet(state.path("shards")) if known else spark.createDataFrame([], LISTING)
        held = spark.read.schema(PARTS).parquet(state.path("held")).collect() if known else []  # a row per day and week
        store = Store(spark, store_root, {(r["kind"], r["part"]): r["run"] for r in held})
        before = dict(store.parts)
        days = sorted(r["event_date"] for r in changed_days(old, now).collect())  # calendar days
        weeks = sorted({monday(d) for d in days})
        run = state.stage()

        no_events = read_events(spark, events_path, start, p.end).limit(0) if files.exists(spark, events_path) else None
        if no_events is None:
            raise FileNotFoundError(events_path)
        fact_schema = item_fact(no_events, ITEM_EVENTS).schema
        day_schema, grain_schema = day_counts(no_events).schema, Q.segment_grain(item_fact(no_events, ITEM_EVENTS), p).schema
        if days:
            touched = touched_events(spark, events_path, days, p)
            for kind in (FACT, DAYS):
                store.drop(kind, days)
            store.drop(GRAIN, weeks)
            store.write(FACT, item_fact(touched, ITEM_EVENTS), run)
            store.write(DAYS, day_counts(touched), run)
            of_weeks = {(_dt.date.fromisoformat(w) + _dt.timedelta(days=i)).strftime("%Y%m%d") for w in weeks for i in range(7)}
            store.write(GRAIN, Q.segment_grain(store.read(FACT, fact_schema, of_weeks), p), run)
        fact, grain, counts = store.read(FACT, fact_schema), store.read(GRAIN, grain_schema), store.read(DAYS, day_schema)
        results = {
            **item_results(spark, fact, grain, p),
            "funnel_weekly": funnel_weeks(counts, p.start, p),
            "funnel_change_impact": funnel_impact_from_weeks(spark, funnel_weeks(counts, p.start_recent, p), p),
        }
        publish_results(spark, results, out_dir, p, fmt)

        if days or not known:
            rows = [(k, x, r) for (k, x), r in sorted(store.parts.items())]
            spark.createDataFrame(rows, PARTS).coalesce(1).write.parquet(state.path("held", run))
            now.write.parquet(state.path("shards", run))
            files.replace_text(spark, state.path("bounds.txt", run), bounds)
            state.swap(run)
            for (kind, part), r in before.items():
                if store.parts.get((kind, part)) != r:
                    files.delete(spark, f"{store_root}/{kind}/run={r}/{PARTITIONED[kind][0]}={part}")
            store.sweep(run)
    return {"days": days, "weeks": weeks}
