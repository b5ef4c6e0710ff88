"""Scalar business formulas (B15-B21, J6) as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perishables.functions.nulls import clip_range

# --- fixed values (must equal the source pipeline's for identical results) ---
# shelf-life base days by quality grade; any other grade uses the default
GRADE_SHELF_BASE = {"high": 15, "medium": 10, "low": 5}
GRADE_SHELF_DEFAULT = 7
SHELF_TEMP_THRESHOLD_C = 40.0      # above it, 0.2 day lost per degree
SHELF_TEMP_DAYS_PER_C = 0.2
SHELF_PH_THRESHOLD = 6.8           # below it, 0.5 day lost per pH unit
SHELF_DAYS_PER_PH = 0.5
SHELF_MIN_DAYS, SHELF_MAX_DAYS = 2, 20
WEEKEND_DAYS = (4, 5)              # Friday, Saturday (weekday(): 0 = Monday)
WEEKEND_DEMAND_FACTOR = 1.1
NEAR_EXPIRY_DAYS = 3               # expiration risk: days to expiry <= 3 with stock
HIGH_RISK_DAYS = 1                 # risk score 2 if days <= 1, 1 if <= 3, else 0
PRODUCT_TYPES = ["whole milk", "skimmed milk", "yogurt", "cheese", "cream"]
QUALITY_GRADES = ["high", "medium", "low"]
DATE_FORMAT = "yyyy-MM-dd"
# a store's natural order: letters, then digits
STORE_PATTERN = r"^([A-Za-z]*)(\d+)$"
# -----------------------------------------------------------------------------


def iso_date_text(d: Column) -> Column:
    """Date as ``YYYY-MM-DD`` text."""
    return F.date_format(d, DATE_FORMAT)


def product_name(pid: Column, ptype: Column) -> Column:
    """Title-cased product name, ``Product <id>`` when the type is unknown."""
    return F.initcap(F.coalesce(ptype, F.concat(F.lit("Product "), pid.cast("string"))))


def product_label(pid: Column, ptype: Column) -> Column:
    """``"<id> • <Title>"``."""
    return F.concat(pid.cast("string"), F.lit(" • "), product_name(pid, ptype))


def store_sort_prefix(store: Column) -> Column:
    """Natural-sort prefix: upper letters before the digits, or the whole upper text."""
    s = store.cast("string")
    t = F.trim(s)
    return F.when(t.rlike(STORE_PATTERN), F.upper(F.regexp_extract(t, STORE_PATTERN, 1))).otherwise(F.upper(s))


def store_sort_number(store: Column) -> Column:
    """Natural-sort number (0 when the id is not letters followed by digits)."""
    t = F.trim(store.cast("string"))
    num = F.regexp_extract(t, STORE_PATTERN, 2).try_cast("decimal(38,0)")
    return F.when(t.rlike(STORE_PATTERN), num).otherwise(F.lit(0).cast("decimal(38,0)"))


def shelf_life_days(grade: Column, temperature: Column, ph: Column) -> Column:
    """Shelf life from grade, temperature and pH; half-even rounding, clipped to 2..20."""
    base = F.lit(float(GRADE_SHELF_DEFAULT))
    for g, days in reversed(list(GRADE_SHELF_BASE.items())):
        base = F.when(grade == g, F.lit(float(days))).otherwise(base)
    temp_loss = F.when(temperature > SHELF_TEMP_THRESHOLD_C,
                       F.lit(SHELF_TEMP_DAYS_PER_C) * (temperature - F.lit(SHELF_TEMP_THRESHOLD_C))) \
        .otherwise(F.lit(0.0))
    ph_loss = F.when(ph < SHELF_PH_THRESHOLD, F.lit(SHELF_DAYS_PER_PH) * (F.lit(SHELF_PH_THRESHOLD) - ph)) \
        .otherwise(F.lit(0.0))
    adj = (F.lit(0.0) - temp_loss) - ph_loss
    return clip_range(F.bround(base + adj, 0), float(SHELF_MIN_DAYS), float(SHELF_MAX_DAYS)).cast("int")


def weekday_factor(d: Column) -> Column:
    """Demand factor 1.1 on Friday and Saturday, else 1.0."""
    return F.when(F.weekday(d).isin(*WEEKEND_DAYS), F.lit(WEEKEND_DEMAND_FACTOR)).otherwise(F.lit(1.0))


def expiry_date(production_date: Column, shelf_days: Column) -> Column:
    """Production date + shelf days (null shelf life counts as 0 days)."""
    return F.date_add(production_date, F.coalesce(shelf_days, F.lit(0)).cast("int"))


def risk_score(days_to_expiration: Column) -> Column:
    """2 if <= 1 day, 1 if <= 3 days, else 0."""
    return (F.when(days_to_expiration <= HIGH_RISK_DAYS, F.lit(2))
            .when(days_to_expiration <= NEAR_EXPIRY_DAYS, F.lit(1)).otherwise(F.lit(0)))
