"""S-6 / S-7 / S-8: result output.

Results leave Spark as files written by the executors (JSON lines or
Parquet, optionally partitioned); nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dimensions import Change, SalePeriod


def iso_dates(df: DataFrame) -> DataFrame:
    """S-6: DATE columns as ``yyyy-MM-dd`` text, TIMESTAMP columns as ISO-8601 text."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd").alias(f.name))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            cols.append(F.date_format(F.col(f.name), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_result(
    df: DataFrame,
    path: str,
    fmt: str = "json",
    partition_by: Sequence[str] | None = None,
    mode: str = "overwrite",
) -> None:
    """S-7: write a result set; JSON keeps null fields (Spark drops them by default).

    JSON output is one object per line with keys in column order and dates as
    ISO text.  ``partition_by`` (e.g. ``week``) lays results out for pruning.
    """
    out = iso_dates(df) if fmt == "json" else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "json":
        w.option("ignoreNullFields", "false").json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


RUN_RECORD = (
    "last_updated string, project_id string, delivery_changes array<struct<date:string,label:string,detail:string>>, "
    "sale_periods array<struct<start:string,end:string,label:string,detail:string>>, "
    "current_delivery array<struct<tier:string,price:int,carrier:string,examples:string>>"
)


def run_metadata(
    spark: SparkSession,
    project_id: str,
    changes: Sequence[Change],
    sale_periods: Sequence[SalePeriod],
    current_tiers: Sequence[tuple] = (),
) -> DataFrame:
    """S-8: one-row run record: UTC time, source id, and the three dimension lists in the order given."""
    row = (
        _dt.datetime.now(_dt.timezone.utc).isoformat(),
        project_id,
        [(c.date, c.label, c.detail) for c in changes],
        [(x.start, x.end, x.label, x.detail) for x in sale_periods],
        [tuple(t) for t in current_tiers],
    )
    return spark.createDataFrame([row], RUN_RECORD)


__all__ = ["iso_dates", "run_metadata", "write_result"]
