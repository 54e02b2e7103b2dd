"""C-3 / O-2 / R-3: top-K keys by an aggregate, and the semi-join that applies them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, key: str, metric: Column, k: int, metric_name: str = "rank_metric") -> DataFrame:
    """The ``k`` keys with the largest ``metric`` (an aggregate expression).

    Ties, undefined in the reference, are broken by the key ascending, so the
    list is deterministic.  ``orderBy(...).limit(k)`` plans as
    TakeOrderedAndProject: each partition keeps its own top k and one task
    merges k rows per partition, never the whole input.
    """
    agg = df.groupBy(key).agg(metric.alias(metric_name))
    return agg.orderBy(F.col(metric_name).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)


def topk_semi_join(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Keep rows of ``df`` whose ``key`` is in ``top`` (an inner join on a unique key).

    ``top`` comes from a ``limit``, which gives the planner a row bound: it
    broadcasts the keys while they are small and shuffles both sides beyond.
    """
    return df.join(top.select(key), key, "left_semi")
