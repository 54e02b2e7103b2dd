"""P-5: keyed lookup in a GA4 ``event_params`` key/value array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE_FIELDS = {
    "int": "int_value",
    "string": "string_value",
    "double": "double_value",
    "float": "float_value",
}


def event_param(
    key: str,
    value_type: str = "int",
    params: Column | str = "event_params",
    on_duplicate: str = "error",
) -> Column:
    """Value of the entry with ``key`` (null when absent or the array is null).

    Uses the higher-order ``filter`` (no correlated subquery) and ``get`` (null
    out of range, where ``[0]`` would raise under ANSI).  A key present twice
    fails the query, as a scalar subquery returning two rows does
    (``on_duplicate="first"`` takes the first instead).
    """
    params = F.col(params) if isinstance(params, str) else params
    hits = F.filter(params, lambda p: p["key"] == F.lit(key))
    value = F.get(hits, 0)["value"][_VALUE_FIELDS[value_type]]
    if on_duplicate == "first":
        return value
    msg = F.lit(f"event_params holds key '{key}' more than once")
    return F.when(F.size(hits) > 1, F.raise_error(msg)).otherwise(value)
