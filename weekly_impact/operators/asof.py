"""D-1: nearest-row join: each row picks up the row of another table that lies closest in time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nearest_join(left: DataFrame, right: DataFrame, left_on: str, right_on: str, by: Sequence[str] = ()) -> DataFrame:
    """``left`` (all rows) with the columns of ``right``'s row of the same ``by`` keys whose date is closest.

    The earlier of two equally distant rows wins; of several rows of one date,
    the least.  Where ``right`` has no row for the keys, or ``left`` no date,
    the columns are null.  Both tables are united and sorted by date, once up
    and once down: the last row of ``right`` that a row of ``left`` has behind
    it is its nearest on that side, so no row meets more than two others,
    whatever the distances.  ``by`` spreads the windows; without it all rows
    pass through one task, which suits tables of one row per week only.
    """
    keys = list(by)
    mine = [c for c in left.columns if c not in keys]
    theirs = [c for c in right.columns if c not in keys]
    if clash := set(mine) & set(theirs):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    a = left.select(*keys, F.col(left_on).alias("_at"), F.lit(True).alias("_asks"), F.struct(*mine).alias("_l"))
    one = right.where(F.col(right_on).isNotNull()).groupBy(*keys, F.col(right_on).alias("_at")).agg(F.min(F.struct(*theirs)).alias("_r"))
    both = a.unionByName(one.withColumn("_asks", F.lit(False)), allowMissingColumns=True)

    def behind(*order):
        frame = Window.partitionBy(*keys).orderBy(*order, "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.last("_r", ignorenulls=True).over(frame)

    told = both.withColumn("_b", behind(F.col("_at").asc())).withColumn("_a", behind(F.col("_at").desc())).where("_asks")
    back, ahead = F.datediff("_at", F.col(f"_b.{right_on}")), F.datediff(F.col(f"_a.{right_on}"), "_at")
    earlier = F.col("_b").isNotNull() & (F.col("_a").isNull() | (back <= ahead))
    near = F.when(F.col("_at").isNull(), None).when(earlier, F.col("_b")).otherwise(F.col("_a"))
    return told.select(*keys, "_l.*", near.alias("_r")).select(*left.columns, "_r.*")
