"""Null-semantics rules (T1-T7, T13) as Spark column expressions.

Spark's ``greatest``/``least`` skip nulls and ``sum`` of an all-null group is
null; the rules below keep the semantics of the source pipeline instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clip_lower0(x: ColumnOrName) -> Column:
    """Lower clip at 0 that keeps null (``greatest(x, 0)`` would turn null into 0)."""
    x = _c(x)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def clip_range(x: ColumnOrName, lo, hi) -> Column:
    """Clip to [lo, hi]; null stays null."""
    x = _c(x)
    return F.when(x < lo, F.lit(lo)).when(x > hi, F.lit(hi)).otherwise(x)


def min_with_cap(gap: ColumnOrName, cap: ColumnOrName) -> Column:
    """min(gap, cap) if cap is known; null gap stays null; unknown cap leaves gap."""
    gap, cap = _c(gap), _c(cap)
    return F.when(cap.isNull() | gap.isNull(), gap).otherwise(F.least(gap, cap))


def flag(cond: Column) -> Column:
    """Boolean condition to 0/1 where a null comparison counts as False."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def sum0(x: ColumnOrName) -> Column:
    """T4: sum that is 0 (not null) over an empty or all-null group."""
    return F.coalesce(F.sum(_c(x)), F.lit(0))


def nan_to_null(x: ColumnOrName) -> Column:
    """NaN and null are one thing; normalise NaN to null (double input)."""
    x = _c(x)
    return F.when(F.isnan(x), F.lit(None)).otherwise(x)


def div_or_null(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den, null when den is 0 or null (ANSI-safe, skipped by ``avg``)."""
    num, den = _c(num), _c(den)
    return num / F.nullif(den, F.lit(0))
