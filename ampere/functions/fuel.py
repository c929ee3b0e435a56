"""Fuel-code classification used by the generation mart and its dashboard measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# These must equal the source pipeline's lists for equal results.
# Aggregate codes, excluded before shares are computed (they double count):
AGGREGATE_FUEL_CODES = ("ALL", "FOS", "REN", "COW", "AOR", "BIS", "SUN", "TSN",
                        "TPV", "DPV", "NG", "WND", "COL")
# Category of each detailed code, checked in this order; anything else is "Other":
FUEL_CATEGORIES = (
    ("Natural Gas", ("NGO",)),
    ("Wind", ("WNT", "WNS")),
    ("Solar & Geothermal", ("SPV", "STH", "GEO")),
    ("Nuclear", ("NUC",)),
    ("Coal", ("SUB", "LIG", "BIT", "ANT", "RC", "WOC")),
    ("Hydro", ("HYC", "HPS")),
)
OTHER_CATEGORY = "Other"
# ---------------------------------------------------------------------------

# Dashboard groupings (described in words only by the source, so our reading):
# clean = renewables + nuclear; fossil = coal + natural gas; "Other" is the rest.
CLEAN_CATEGORIES = ("Hydro", "Wind", "Solar & Geothermal", "Nuclear")
SOURCE_GROUPS = (
    ("Fossil", ("Coal", "Natural Gas")),
    ("Nuclear", ("Nuclear",)),
    ("Renewable", ("Hydro", "Wind", "Solar & Geothermal")),
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_detail_code(code) -> Column:
    """NOT IN over the aggregate list; a NULL code yields NULL and is filtered out."""
    return ~_col(code).isin(*AGGREGATE_FUEL_CODES)


def fuel_category(code) -> Column:
    c = _col(code)
    expr = None
    for name, codes in FUEL_CATEGORIES:
        cond = c.isin(*codes)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_CATEGORY))


def source_group(category) -> Column:
    c = _col(category)
    expr = None
    for name, cats in SOURCE_GROUPS:
        cond = c.isin(*cats)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit("Other"))
