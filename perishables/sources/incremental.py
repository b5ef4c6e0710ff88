"""Incremental loads and table maintenance.

High-water marks are uncorrelated scalar subqueries, so the range filter
reaches the scan as a plain predicate once the scalar is known, and no driver
round trip or cross join is needed.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables import schemas
from perishables.session import cut_lineage

DEFAULT_START_DATE = dt.date(2025, 1, 1)


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """A10/H1: union all of a new batch; columns matched by name, absent ones null."""
    return existing.unionByName(new, allowMissingColumns=True)


def high_water_mark(df: DataFrame, key: str, default=None) -> Column:
    """``max(key)`` (``default`` when the table is empty) as a scalar subquery column."""
    top = F.max(key)
    return df.select(top if default is None else F.coalesce(top, F.lit(default))).scalar()


def rows_between(df: DataFrame, key: str, lo: Column | int, hi: Column | int) -> DataFrame:
    """Rows whose key lies in [lo, hi]."""
    return df.filter(F.col(key).between(lo, hi))


def new_rows_after(df: DataFrame, key: str, loaded: DataFrame) -> DataFrame:
    """Rows whose key is above the high-water mark of what was already loaded
    (everything when nothing was loaded).  The key must grow with load order."""
    mark = high_water_mark(loaded, key)
    return df.filter(mark.isNull() | (F.col(key) > mark))


def last_date(df: DataFrame, column: str, default: dt.date = DEFAULT_START_DATE) -> DataFrame:
    """The latest date of a column, or ``default`` for an empty table."""
    return df.agg(F.coalesce(F.max(column), F.lit(default)).alias("last_date"))


def ensure_dimension(existing: DataFrame, seed: DataFrame, keys: list[str]) -> DataFrame:
    """Existing dimension rows plus seed rows whose key is not present yet."""
    return existing.unionByName(seed.join(existing.select(*keys), keys, "left_anti"))


def assign_ids(new: DataFrame, id_col: str, order_by: list[str], start_after: Column | int = 0) -> DataFrame:
    """Consecutive ids after ``start_after`` in ``order_by`` order, without a one-partition window.

    Rows are sorted by range and written once with the number of their range (a
    checkpoint).  The numbers within a range and the counts of the ranges before it
    are then taken from the same stored rows, so nothing depends on how a second
    execution would deal or merge partitions.
    """
    ordered = cut_lineage(new.repartitionByRange(*order_by).withColumn("_part", F.spark_partition_id()))
    local = ordered.withColumn("_local", F.row_number().over(Window.partitionBy("_part").orderBy(*order_by)))
    counts = ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # one row per range
    offsets = counts.select("_part", F.coalesce(
        F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    base = start_after if isinstance(start_after, Column) else F.lit(start_after)
    offset = F.coalesce("_offset", F.raise_error(F.lit("a range of rows has no offset")).cast("bigint"))
    return local.join(offsets, "_part", "left") \
        .withColumn(id_col, (base + offset + F.col("_local")).cast("bigint")).drop("_part", "_local", "_offset")


def produced_quantity(batches: DataFrame, inventory: DataFrame) -> DataFrame:
    """Quantity produced per new batch = initial stock (0 when there is no inventory row)."""
    inv = inventory.select(*schemas.BATCH_KEYS, "initial_stock_liters")
    return batches.join(inv, schemas.BATCH_KEYS, "left").withColumn(
        "quantity_produced_liters", F.coalesce(F.col("initial_stock_liters"), F.lit(0)).cast("bigint")) \
        .drop("initial_stock_liters")


def batch_stock(batches: DataFrame, inventory: DataFrame) -> DataFrame:
    """Current stock of each batch in one join (0 when there is no inventory row)."""
    inv = inventory.select(*schemas.BATCH_KEYS, "current_stock_liters")
    return batches.join(inv, schemas.BATCH_KEYS, "left").withColumn(
        "current_stock_liters", F.coalesce(F.col("current_stock_liters"), F.lit(0)).cast("bigint"))
