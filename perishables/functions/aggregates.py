"""Aggregate helpers whose results do not depend on partitioning or row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed-point type used to accumulate doubles exactly: 26 integer digits and
# 12 decimals.  Addition in it is associative, so a sum is the same whichever
# task adds which rows; the result is returned as double.
EXACT_SUM_TYPE = "decimal(38,12)"


def exact_sum(x: Column) -> Column:
    """Order-independent sum of a double column (null for an empty/all-null group)."""
    return F.sum(x.cast(EXACT_SUM_TYPE)).cast("double")


def exact_sum0(x: Column) -> Column:
    """``exact_sum`` that is 0.0 for an empty or all-null group (T4)."""
    return F.coalesce(exact_sum(x), F.lit(0.0))


def exact_avg(x: Column) -> Column:
    """Order-independent mean of a double column; nulls are skipped."""
    return exact_sum(x) / F.count(x).cast("double")
