"""E-5: ordered tier rules -> one searched CASE expression (first match wins)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TierRule:
    """``column IN values -> tier``; rules are tried in list order."""

    tier: str
    values: tuple[str, ...]
    column: str = "subcategory"


def tier_rules(rows: Sequence[tuple]) -> list[TierRule]:
    """Build rules from (tier, values) or (tier, values, column) tuples."""
    return [TierRule(r[0], tuple(r[1]), *(r[2:] or ())) for r in rows]


def assign_tier(rules: Sequence[TierRule], default: str = "Other") -> Column:
    """CASE WHEN col IN (...) THEN tier ... ELSE default END.

    A value listed under two tiers takes the earlier one; a null value falls
    through to the next rule (``NULL IN (...)`` is unknown).  The rule list is
    a plan-time constant, so this stays a codegen'd expression: no join and no
    shuffle, whatever the data size.
    """
    expr = None
    for r in rules:
        cond = F.col(r.column).isin(list(r.values))
        expr = F.when(cond, F.lit(r.tier)) if expr is None else expr.when(cond, F.lit(r.tier))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def tier_table(spark: SparkSession, rules: Sequence[TierRule]) -> DataFrame:
    """E-5 as data: (rule_no, column_name, value, tier), one row per listed value."""
    rows = [(i, r.column, v, r.tier) for i, r in enumerate(rules) for v in r.values]
    return spark.createDataFrame(rows, "rule_no int, column_name string, value string, tier string")


def assign_tier_from_table(
    df: DataFrame,
    rules: DataFrame,
    columns: Sequence[str] = ("subcategory", "category"),
    default: str = "Other",
    name: str = "delivery_tier",
) -> DataFrame:
    """``df`` with the tier of the earliest rule that one of ``columns`` meets, from a table of rules.

    For rule tables that are kept with the data and grow with it (one row per
    product, say): per column, each value's earliest rule (``min_by``) is
    looked up by a left join, and the earliest of the columns' rules wins, as
    in the CASE form.  Null keys and unlisted values meet no rule.  No side is
    broadcast by hint: the planner does so below its size threshold
    (``spark.sql.autoBroadcastJoinThreshold``) and shuffles beyond it.
    """
    found = []
    out = df
    for i, c in enumerate(columns):
        first = rules.where((F.col("column_name") == c) & F.col("value").isNotNull()).groupBy("value").agg(
            F.struct(F.min("rule_no").alias("rule_no"), F.min_by("tier", "rule_no").alias("tier")).alias(f"_rule{i}"))
        out = out.join(first.withColumnRenamed("value", f"_value{i}"), F.col(c) == F.col(f"_value{i}"), "left")
        found.append(f"_rule{i}")
    # least() skips nulls; structs compare by rule number first.
    best = F.least(*found) if len(found) > 1 else F.col(found[0])
    return out.select(*df.columns, F.coalesce(best["tier"], F.lit(default)).alias(name))
