"""Query parameters: what the reference hard-codes is an argument here."""

from __future__ import annotations

from dataclasses import dataclass, field

from ..functions.tiers import TierRule
from ..sources.dimensions import CURRENT_TIERS, DELIVERY_CHANGES, SALE_PERIODS, Change, SalePeriod


@dataclass(frozen=True)
class Params:
    """Parameters shared by the 14 queries.

    ``start`` is the scan floor of the four all-history queries (category,
    subcategory, product weekly, site funnel) and ``start_recent`` that of the
    other ten; ``end`` None means today.  ``delivery_changes`` (shown on the
    weekly charts), ``current_tiers`` and ``project_id`` only go into the
    overlays and the run record.
    """

    start: str = "20230101"
    start_recent: str = "20250101"
    end: str | None = None
    blocklist: tuple[str, ...] = ()
    top_products: int = 500
    top_units: int = 300
    top_impact_products: int = 300
    top_funnel_products: int = 300
    changes: tuple[Change, ...] = ()
    funnel_changes: tuple[Change, ...] = ()
    tiers: tuple[TierRule, ...] = ()
    default_tier: str = "Other"
    window_days: int = 28
    sale_periods: tuple[SalePeriod, ...] = field(default_factory=tuple)
    delivery_changes: tuple[Change, ...] = ()
    current_tiers: tuple[tuple, ...] = ()
    project_id: str = ""


# The published query configuration (block list and the three
# changes the impact queries know, with their affected categories).
REFERENCE_BLOCKLIST = (
    "shop", "Sofas", "Beds", "New In", "Need It Quick", "Black Friday",
    "Accessories", "51714", "51716", "51718", "51720",
)
_ML = ("DINING AND LIVING", "BEDROOM", "UPHOLSTERY", "BEDS", "GARDEN", "OFFICE", "RUGS",
       "ACCESSORIES", "BEDS AND BEDROOM")
REFERENCE_CHANGES = (
    Change("2025-04-01", "Apr 2025: Medium & Large increase", _ML),
    Change("2025-08-01", "Aug 2025: Small furniture increase",
           ("DINING AND LIVING", "ACCESSORIES", "GARDEN", "OFFICE", "RUGS", "SUNDRIES")),
    Change("2026-03-27", "Mar 2026: Medium & Large increase", _ML),
)

# The published tier rules, tried in this order ('Benches' belongs to the earlier one).
REFERENCE_TIERS = (
    TierRule("Large £99 (B&S)", ("Sofas", "Sofa Beds", "Wardrobes", "Large Sofas", "Corner Sofas", "Sofa Beds")),
    TierRule("Medium £69 (B&S)", ("Dining Tables", "Dining Sets", "Beds", "Sideboards", "Recliner Chairs", "Bookcases", "Cabinets",
                                  "Benches", "Display Cabinets", "Dressers")),
    TierRule("Medium £49 (DX 2-crew)", ("Armchairs", "TV Units", "Coffee Tables", "Chest of Drawers", "Console Tables", "Lamp Tables",
                                        "Desks", "Dressing Tables")),
    TierRule("Mattress £29 (B&S)", ("Mattresses",)),
    TierRule("Small £15 (DPD)", ("Dining Chairs", "Bar Stools", "Bedside Tables", "Footstools", "Small Tables", "Benches")),
    TierRule("Small accessories £6 (DPD)", ("Cushions", "Vases", "Candles", "Plants", "Clocks", "Throws", "Ornaments", "Trays", "Baskets",
                                            "Diffusers")),
    TierRule("Large accessories £29 (DPD)", ("Rugs", "Mirrors", "Floor Lamps", "Ceiling Lamps", "Wall Art", "Pictures and Wall Art",
                                             "Table Lamps")),
    TierRule("Garden (Free/£29)", ("GARDEN",), "category"),
)

REFERENCE_PARAMS = Params(
    tiers=REFERENCE_TIERS,
    sale_periods=tuple(SALE_PERIODS),
    delivery_changes=tuple(DELIVERY_CHANGES),
    current_tiers=tuple(CURRENT_TIERS),
    blocklist=REFERENCE_BLOCKLIST,
    changes=REFERENCE_CHANGES,
    funnel_changes=tuple(Change(c.date, c.label) for c in REFERENCE_CHANGES),
)

# The parameters of the test-table mapping (FIXTURES.md section 2-3).
FIXTURE_CHANGES = (
    Change("1997-04-01", "Apr 1997: Small, Medium, Large", ("SMALL", "MEDIUM", "LARGE")),
    Change("1998-08-01", "Aug 1998: Promo, Standard", ("PROMO", "STANDARD")),
    Change("2000-03-27", "Mar 2000: Small, Promo", ("SMALL", "PROMO")),
)
FIXTURE_FUNNEL_CHANGES = (
    Change("2024-01-17", "Jan 2024: mid-week change"),
    Change("2024-01-22", "Jan 2024: Monday change"),
)
FIXTURE_TIERS = (
    TierRule("T1", ("Brand#1", "Brand#2", "Brand#3")),
    TierRule("T2", ("Brand#4", "Brand#5", "Brand#7")),
    TierRule("T3", ("Brand#7", "Brand#8")),
    TierRule("T4", ("PROMO",), "category"),
)
FIXTURE_SALE_PERIODS = (
    SalePeriod("1996-11-29", "1997-01-01", "Winter Sale"),
    SalePeriod("1997-03-29", "1997-06-02", "Spring Promotion"),
    SalePeriod("1997-05-20", "1997-06-10", "Early Summer"),
    SalePeriod("1999-06-21", "1999-09-01", "Summer Sale"),
)
FIXTURE_PARAMS = Params(
    start="19950101",
    start_recent="19950101",
    blocklist=("ECONOMY",),
    top_products=20,
    top_units=20,
    top_impact_products=20,
    top_funnel_products=20,
    changes=FIXTURE_CHANGES,
    funnel_changes=FIXTURE_FUNNEL_CHANGES,
    tiers=FIXTURE_TIERS,
    sale_periods=FIXTURE_SALE_PERIODS,
    delivery_changes=FIXTURE_CHANGES,
)

# Shard bounds of the scan test (YYYYMMDD): two middle weeks of the site events.
FIXTURE_SCAN_WINDOW = ("20240108", "20240121")
