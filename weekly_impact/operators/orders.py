"""A-7: de-duplicate item rows to one row per order before aggregating."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_dedup(fact: DataFrame, keys: Sequence[str], value: str = "order_rev_u", order_col: str = "transaction_id") -> DataFrame:
    """One row per (week, keys, order) with MAX(value).

    Null order ids form one group per (week, keys), as SQL GROUP BY does: it
    is counted in sums and means, not in distinct-order counts.  The shuffle
    hashes the order id too, so a hot (week, category) is spread.
    """
    return fact.groupBy("week", *keys, order_col).agg(F.max(value).alias(value))
