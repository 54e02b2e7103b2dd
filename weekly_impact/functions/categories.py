"""F-3: the category noise filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_blank(c: Column) -> Column:
    """F-2: not null and not the empty string."""
    return c.isNotNull() & (c != F.lit(""))


def category_is_clean(category: Column, blocklist: Sequence[str]) -> Column:
    """Not in the block list, longer than two characters, starts with A-Z.

    A null category makes every term unknown, so the row is dropped without an
    explicit null test (SQL ``NULL NOT IN (...)`` semantics).
    """
    cond = (F.length(category) > 2) & category.rlike("^[A-Z]")
    if blocklist:
        cond = ~category.isin(list(blocklist)) & cond
    return cond


def clean_categories(
    df: DataFrame,
    blocklist: Sequence[str],
    required_col: str = "category",
    category_col: str = "category",
) -> DataFrame:
    """Keep rows whose ``required_col`` is not blank and whose category is clean.

    ``required_col`` is ``category`` for the category variant and
    ``subcategory`` for the subcategory variant of the reference's filter.
    """
    return df.where(not_blank(F.col(required_col)) & category_is_clean(F.col(category_col), blocklist))
