"""A-2 (opt-in): approximate distinct counts from mergeable HyperLogLog sketches.

Exact distinct counts can't be added up: a user of two weeks is one user of
the month.  Sketches can be united, so one stored table of sketches per
(week, segment) answers distinct counts at every coarser grain without
reading events again, at a stated error.  Exact counts stay the default; no
query uses this unless asked to.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_K = 14


def relative_error(log_k: int = LOG_K, deviations: float = 3.0) -> float:
    """The stated bound: ``deviations`` standard errors of a sketch with 2^log_k registers."""
    return deviations * 1.04 / math.sqrt(2**log_k)


def distinct_sketch(df: DataFrame, keys: Sequence[str], column: str, log_k: int = LOG_K, name: str = "sketch") -> DataFrame:
    """(keys, sketch) of the non-null values of ``column``; tasks sketch first, so a hot key costs one sketch per task."""
    return df.groupBy(*keys).agg(F.hll_sketch_agg(F.col(column).cast("string"), log_k).alias(name))


def unite_sketches(sketches: DataFrame, keys: Sequence[str], name: str = "sketch") -> DataFrame:
    """(keys, sketch) at a coarser grain."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg(name).alias(name))


def estimate(name: str = "sketch") -> Column:
    """The estimated distinct count of a sketch."""
    return F.hll_sketch_estimate(name)
