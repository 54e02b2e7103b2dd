"""S-1/S-2/S-3: the analytics event table (GA4-style export) and its scan.

The event table is laid out as Parquet partitioned by ``event_date``
(``YYYYMMDD`` text, one directory per daily shard).  The scan declares an
explicit schema listing only the fields the queries touch, so no inference
pass runs and ``event_date`` stays a string (inference would make it int).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARAM_VALUE = T.StructType(
    [
        T.StructField("string_value", T.StringType()),
        T.StructField("int_value", T.LongType()),
        T.StructField("float_value", T.DoubleType()),
        T.StructField("double_value", T.DoubleType()),
    ]
)
EVENT_PARAMS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", PARAM_VALUE)])
)
ECOMMERCE = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("purchase_revenue", T.DoubleType()),
    ]
)
ITEM = T.StructType(
    [
        T.StructField("item_name", T.StringType()),
        T.StructField("item_category", T.StringType()),
        T.StructField("item_category2", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("quantity", T.LongType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("user_pseudo_id", T.StringType()),
        T.StructField("event_params", EVENT_PARAMS),
        T.StructField("ecommerce", ECOMMERCE),
        T.StructField("items", T.ArrayType(ITEM)),
        T.StructField("event_date", T.StringType()),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]


def today_yyyymmdd() -> Column:
    """S-3: ``FORMAT_DATE('%Y%m%d', CURRENT_DATE())`` (constant-folded per query)."""
    return F.date_format(F.current_date(), "yyyyMMdd")


def shard_filter(start: str, end: str | None = None, col: Column | str = "event_date") -> Column:
    """S-2: shard suffix between ``start`` and ``end`` as a *string* compare.

    Letters sort above digits, so non-date shards such as ``intraday_...``
    fall outside the bounds, as they do for a wildcard-table suffix filter.
    """
    upper = F.lit(end) if end is not None else today_yyyymmdd()
    c = F.col(col) if isinstance(col, str) else col
    return c.between(F.lit(start), upper)


def read_events(
    spark: SparkSession,
    path: str,
    start: str = "20230101",
    end: str | None = None,
) -> DataFrame:
    """S-1: scan every daily shard under ``path`` between ``start`` and ``end``.

    ``event_date`` is a partition column, so the bound becomes a
    PartitionFilter: shards outside the range are never listed into tasks.
    """
    df = spark.read.schema(EVENT_SCHEMA).parquet(path)
    return df.where(shard_filter(start, end))


def write_events(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    max_records_per_file: int = 2_000_000,
) -> None:
    """Write an event DataFrame in the scan's layout (one directory per day).

    Rows are rebalanced by day: the runtime splits big days and joins small
    ones by bytes, so a hot day is spread over as many tasks as it needs.
    ``maxRecordsPerFile`` bounds each file.
    """
    (
        df.select(*EVENT_COLUMNS)
        .hint("rebalance", F.col("event_date"))
        .write.mode(mode)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("event_date")
        .parquet(path)
    )
