"""S-4 / S-5: small literal dimensions (changes, sale periods, tiers).

These are plan-time constants supplied as arguments; they become tiny
DataFrames with an explicit schema.  Their size is bounded by the argument
lists, which is what makes broadcasting them safe at any data size.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Change:
    """A dated change; ``categories`` are those it affects (empty = site-wide)."""

    date: str
    label: str
    categories: tuple[str, ...] = field(default_factory=tuple)
    detail: str = ""


@dataclass(frozen=True)
class SalePeriod:
    start: str
    end: str
    label: str
    detail: str = ""


CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("change_date", T.DateType(), False),
        T.StructField("change_label", T.StringType(), False),
        T.StructField("affected_categories", T.ArrayType(T.StringType(), False), False),
        T.StructField("change_detail", T.StringType(), True),
    ]
)
SALE_SCHEMA = T.StructType(
    [
        T.StructField("sale_start", T.DateType(), False),
        T.StructField("sale_end", T.DateType(), False),
        T.StructField("sale_label", T.StringType(), False),
        T.StructField("sale_detail", T.StringType(), True),
    ]
)


def _date(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s)


def changes_df(spark: SparkSession, changes: Sequence[Change]) -> DataFrame:
    """S-4: change table (date, label, affected categories, detail)."""
    rows = [(_date(c.date), c.label, list(dict.fromkeys(c.categories)), c.detail) for c in changes]
    return spark.createDataFrame(rows, CHANGE_SCHEMA)


def sale_periods_df(spark: SparkSession, periods: Sequence[SalePeriod]) -> DataFrame:
    """S-5: promotional periods (start, end, label, detail)."""
    rows = [(_date(p.start), _date(p.end), p.label, p.detail) for p in periods]
    return spark.createDataFrame(rows, SALE_SCHEMA)


def dimension_df(spark: SparkSession, rows: Sequence[dict], schema: T.StructType | str) -> DataFrame:
    """S-5: any small literal list of records with an explicit schema."""
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    names = [f.name for f in schema.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], schema)


# The published dimension lists, in their order.
DELIVERY_CHANGES = [
    Change("2023-08-01", "New delivery structure", detail="Small courier £29 / Medium B&S £49 / Large B&S £79 / Dining ≤3 £9 / Dining ≥4 £19"),
    Change("2024-12-01", "Dining chairs increase", detail="Dining ≥4 chairs £19→£29. DPD Freight items (oversized/heavy) also defaulted to £29 for ≤3 chairs."),
    Change("2025-04-01", "Medium & Large increase", detail="Medium B&S £49→£59 / Large B&S £79→£89. DX 2-crew medium remains £49."),
    Change("2025-08-01", "Small furniture increase", detail="Small furniture (incl. dining ≤3 chairs) £9→£15 via DPD"),
    Change("2026-03-27", "Medium & Large increase", detail="Medium B&S £59→£69 / Large B&S £89→£99. Current structure: Large £99 / Medium B&S £69 / Medium DX £49 / Mattresses £29 / Small £15 / Accessories £6 / Large accessories £29"),
]
SALE_PERIODS = [
    SalePeriod("2025-02-01", "2025-03-01", "Winter Sale ends", "Winter Sale 2024/25 — ends 1st March 2025"),
    SalePeriod("2025-03-29", "2025-06-02", "Spring Promotion", "Spring Preview & Sale 2025 — ends early June 2025"),
    SalePeriod("2025-06-21", "2025-09-01", "Summer Sale", "Summer Sale 2025 — ends 31st August 2025"),
    SalePeriod("2025-09-27", "2025-11-23", "Autumn Promotion", "Autumn Promotion 2025 — ends 22nd November 2025"),
    SalePeriod("2025-12-26", "2026-03-01", "Winter Sale", "Winter Sale 2025/26 — Boxing Day start, ends 1st March 2026"),
    SalePeriod("2026-03-28", "2026-05-25", "Spring Promotion", "Spring Preview & Sale 2026 — starts 28th March, ends 25th May 2026"),
    SalePeriod("2026-06-20", "2026-08-31", "Summer Sale", "Summer Sale 2026 — starts 20th June, ends 31st August 2026"),
]
CURRENT_TIERS = [  # tier, price, carrier, examples
    ("Large furniture", 99, "B&S", "Sofas, sofa beds, wardrobes"),
    ("Medium furniture", 69, "B&S", "Beds, dining tables, dining sets, sideboards, recliner chairs"),
    ("Medium furniture", 49, "DX 2-crew", "Armchairs, TV units, coffee tables, chest of drawers"),
    ("Mattresses", 29, "B&S", "All mattresses"),
    ("Small furniture", 15, "DPD", "Dining chairs (≤3), bar stools, small tables. 4+ dining chairs or heavy items: £29"),
    ("Small accessories", 6, "DPD", "Table lamps, soft furnishings, clocks, home decor, plants"),
    ("Large accessories & rugs", 29, "DPD", "Rugs, ceiling/floor lamps, mirrors, wall art over 1m/30kg"),
    ("Assisted delivery", 149, "B&S", "Items requiring 2+ person delivery due to size/weight"),
    ("Click & Collect", 0, "N/A", "All furniture and accessories from 4 warehouses or 11 stores"),
]
