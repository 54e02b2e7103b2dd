"""S-1 / S-2: which daily shards changed since the last run.

A listing has one row per file: its shard, path, size and modification time.
It is a Spark scan that reads no file contents.  Compared both ways with the
listing of the last run it names the days of files that are new, rewritten
(also under their old name), emptied or gone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import files
from .events import shard_filter

LISTING = "path string, size long, modified timestamp, event_date string"


def list_shards(spark: SparkSession, path: str, start: str = "20230101", end: str | None = None) -> DataFrame:
    """(path, size, modified, event_date) of the Parquet files of the shards between ``start`` and ``end``."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], LISTING)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return listing.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        F.regexp_extract("path", "event_date=([^/]+)/[^/]*$", 1).alias("event_date"),
    ).where(shard_filter(start, end))


def changed_days(old: DataFrame, new: DataFrame) -> DataFrame:
    """(event_date) of the files that stand in one listing only, or with another size or time in each."""
    a, b = old.select(F.struct("path", "size", "modified").alias("was"), "path", "event_date"), new
    b = b.select(F.struct("path", "size", "modified").alias("now"), F.col("path"), F.col("event_date").alias("day"))
    return a.join(b, "path", "full").where(~F.col("was").eqNullSafe(F.col("now"))).select(
        F.coalesce("event_date", "day").alias("event_date")).distinct()
