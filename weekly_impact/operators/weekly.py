"""C-2: weekly metrics per key, one pass instead of an anchor LEFT JOIN chain.

The reference computes one CTE per event (distinct users, distinct orders,
row counts, sums) and LEFT JOINs them onto an *anchor* CTE.  Here the same
numbers come from two chained aggregates over one scan:

1. :func:`event_grain` - ``groupBy(week, keys, event_name, dkey)`` where
   ``dkey`` is the column the event's distinct metric counts (user or order
   id).  Partial aggregation runs map-side; the shuffle hashes the distinct
   key too, so a hot (week, category) is spread over many reducers.
2. :func:`rollup` - ``groupBy(week, keys)`` with conditional aggregates: a
   distinct count is a ``count_if`` over the de-duplicated rows, row counts
   and sums add up.  Rolling up to *fewer* keys first re-de-duplicates on
   (week, keys, event, dkey), so a user seen under two categories counts once.

No Expand (Spark's rewrite of several ``count(DISTINCT)`` multiplies rows by
the number of distinct groups) and no self-joins.  Several results can roll
up from one event grain (see ``segment_grain`` in the queries).

The one-pass form is valid when the key columns are non-null (USING joins
never match nulls, a group-by groups them): callers guarantee it by their
filters, or join grains explicitly where keys may be null.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize_bucketed, settle, sized_shuffles

DISTINCT = "distinct"
ROWS = "rows"
SUM = "sum"


@dataclass(frozen=True)
class Metric:
    """``kind`` of ``column`` over rows with ``event_name == event``."""

    name: str
    kind: str
    event: str
    column: str | None = None


def distinct(name: str, event: str, column: str) -> Metric:
    return Metric(name, DISTINCT, event, column)


def rows(name: str, event: str) -> Metric:
    return Metric(name, ROWS, event)


def total(name: str, event: str, column: str) -> Metric:
    return Metric(name, SUM, event, column)


def _sum_col(m: Metric) -> str:
    return f"_s__{m.event}__{m.column}"


def event_grain(
    fact: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    anchor: str | None = None,
    time_col: str = "week",
) -> DataFrame:
    """Phase 1: one row per (week, keys, event_name, _dkey) with ``_n`` and the sums."""
    events = {m.event for m in metrics} | ({anchor} if anchor else set())
    dcols: dict[str, str] = {}
    for m in metrics:
        if m.kind == DISTINCT and dcols.setdefault(m.event, m.column) != m.column:
            raise ValueError(f"one distinct column per event: {m.event}")
    ev = F.col("event_name")
    dkey = None
    for e, c in sorted(dcols.items()):
        cond, val = ev == F.lit(e), F.col(c).cast("string")
        dkey = F.when(cond, val) if dkey is None else dkey.when(cond, val)
    dkey = F.lit(None).cast("string") if dkey is None else dkey
    sums = {_sum_col(m): m for m in metrics if m.kind == SUM}
    return (
        fact.where(ev.isin(sorted(events)))
        .groupBy(time_col, *keys, "event_name", dkey.alias("_dkey"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            *[F.sum(F.when(ev == m.event, F.col(m.column))).alias(c) for c, m in sums.items()],
        )
    )


def rollup(
    grain: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    anchor: str | None = None,
    time_col: str = "week",
    grain_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Phase 2: per (week, keys) the metrics; groups without an ``anchor`` row dropped.

    ``grain_keys`` are the keys ``grain`` was built on; when ``keys`` drops
    some of them, rows are first re-de-duplicated on (week, keys, event, dkey).
    Distinct counts and row counts are 0 when the event is absent; sums are
    null when no non-null value exists (SQL SUM).  The result is settled: a
    large grain is shuffled to as many partitions as its input asks for.
    """
    sum_cols = sorted({_sum_col(m) for m in metrics if m.kind == SUM})
    if grain_keys is not None and list(grain_keys) != list(keys):
        grain = grain.groupBy(time_col, *keys, "event_name", "_dkey").agg(
            F.sum("_n").alias("_n"), *[F.sum(c).alias(c) for c in sum_cols]
        )
    ev = F.col("event_name")
    aggs = []
    for m in metrics:
        on = ev == F.lit(m.event)
        if m.kind == DISTINCT:
            aggs.append(F.count_if(on & F.col("_dkey").isNotNull()).alias(m.name))
        elif m.kind == ROWS:
            aggs.append(F.coalesce(F.sum(F.when(on, F.col("_n"))), F.lit(0)).alias(m.name))
        elif m.kind == SUM:
            aggs.append(F.sum(F.when(on, F.col(_sum_col(m)))).alias(m.name))
        else:
            raise ValueError(m.kind)
    if anchor is not None:
        aggs.append(F.max(ev == F.lit(anchor)).alias("_anchor"))
    out = grain.groupBy(time_col, *keys).agg(*aggs)
    if anchor is not None:
        out = out.where(F.col("_anchor")).drop("_anchor")
    return settle(out, "rollup")


def weekly_metrics(
    fact: DataFrame,
    keys: Sequence[str],
    metrics: Sequence[Metric],
    anchor: str | None = None,
    time_col: str = "week",
) -> DataFrame:
    """Per (week, keys): the metrics, keeping only groups with an ``anchor`` row."""
    return rollup(event_grain(fact, keys, metrics, anchor, time_col), keys, metrics, anchor, time_col)


def anchor_left_join(
    fact: DataFrame,
    keys: Sequence[str],
    anchor: Metric,
    others: Sequence[tuple[Metric, Sequence[str]]],
    time_col: str = "week",
) -> DataFrame:
    """R-1 in the reference's shape: per-event aggregates LEFT JOINed onto the anchor.

    ``others`` pairs each metric with its own join keys (a subset of ``keys``).
    The fact is read once, into its event grain, which is written bucketed by
    (week, keys).  Each metric's aggregate and every join on all keys then
    work bucket by bucket, without an exchange; only a metric on fewer keys is
    shuffled.  A bucket holds all of a (week, keys) cell's users and orders:
    where one cell is a large part of the data, ``weekly_metrics`` spreads it
    and this form does not.  The returned plan reads the bucketed table, which
    stays until the scratch scope ends.
    """
    metrics = [anchor, *(m for m, _ in others)]
    grain = event_grain(fact, keys, metrics, time_col=time_col)
    with sized_shuffles(grain):
        grain = materialize_bucketed(grain, [time_col, *keys], "anchor-grain")

    def one(m: Metric, ks: Sequence[str]) -> DataFrame:
        sub = grain.where(F.col("event_name") == m.event)
        if list(ks) != list(keys) and m.kind == DISTINCT:  # a user under two of the dropped keys is one user
            sub = sub.select(time_col, *ks, "_dkey").distinct()
        if m.kind == DISTINCT:
            agg = F.count("_dkey")
        else:
            agg = F.sum("_n" if m.kind == ROWS else _sum_col(m))
        return sub.groupBy(time_col, *ks).agg(agg.alias(m.name))

    out = one(anchor, keys)
    for m, ks in others:
        out = out.join(one(m, ks), [time_col, *ks], "left")
    return out
