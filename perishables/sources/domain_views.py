"""Domain tables derived from the provided TPC-H-style parquet tables.

One batch is one order; a sale is a line item.  The mapping (see FIXTURES.md)
only projects and joins the provided tables, so every derived table grows with
them.  The holes of ``inventory`` and ``factory`` (batches without such a row) are
part of the fixture design for joins, lookups and orphan checks: they are how
orphans, null stock and missing capacity get exercised.  ``whole`` has the tables
without holes, for checks of single tables.

Each view is one projection written as Spark SQL expressions that already
produce the canonical schema (``schemas.py``) with explicit casts.  Derived
doubles use integer arithmetic and one exact division, so an ANSI SQL engine
computes the very same values.  Views are built lazily: a query only
constructs the tables it reads.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables import schemas

PID = "o_custkey % 5 + 1"
ORDER_DATE = "CAST(o_orderdate AS DATE)"
LINE_DATE = "date_add(CAST(o_orderdate AS DATE), CAST(l_partkey % 12 AS INT))"
GRADE = "CASE CAST(o_orderkey % 3 AS INT) WHEN 0 THEN '{}' WHEN 1 THEN '{}' ELSE '{}' END"

PRODUCTION = [
    "o_orderkey AS batch_id", f"{PID} AS product_id",
    f"concat('type_', CAST({PID} AS STRING)) AS product_type", f"{ORDER_DATE} AS production_date",
    "CAST(o_custkey % 24 AS INT) AS production_hour", f"{GRADE.format('high', 'medium', 'low')} AS grade",
    "CAST(2 + o_orderkey % 19 AS INT) AS shelf_life_days",
]
QUALITY = [
    "o_orderkey AS batch_id", "CAST(30 + o_custkey % 66 AS DOUBLE) / 10.0D AS ph",
    "CAST(34 + o_orderkey % 57 AS DOUBLE) AS temperature", "CAST(o_custkey % 4 - 1 AS INT) AS taste",
    "CAST(o_custkey % 3 AS INT) AS odor", "CAST(o_orderkey % 2 AS INT) AS fat",
    "CAST(o_custkey % 2 AS INT) AS turbidity", "CAST(230 + o_custkey % 40 AS INT) AS colour",
    f"{GRADE.format(' High', 'MEDIUM', 'low ')} AS grade",
]
INVENTORY = [
    "o_orderkey AS batch_id", f"{PID} AS product_id", f"{ORDER_DATE} AS production_date",
    "CAST(o_custkey % 24 AS INT) AS production_hour",
    "CAST(floor(o_totalprice / 5000.0D) AS BIGINT) + 20 AS initial_stock_liters",
    "CAST(floor(o_totalprice / 5000.0D) AS BIGINT) AS current_stock_liters",
    "CAST(floor(o_totalprice / 50000.0D) AS BIGINT) AS reorder_level_liters",
    "CAST(floor(o_totalprice / 20000.0D) AS BIGINT) AS reorder_quantity_liters",
    "concat('W', CAST(o_orderkey % 4 AS STRING)) AS warehouse_location",
    "CAST(4 + o_orderkey % 9 AS DOUBLE) / 2.0D AS storage_temperature_c",
]
SALES = [
    "l_orderkey AS batch_id", f"{PID} AS product_id", "concat('S', CAST(l_suppkey % 10 + 1 AS STRING)) AS store_id",
    f"{LINE_DATE} AS sale_date", "CAST(8 + l_linenumber AS INT) AS sale_hour",
    "CAST(l_quantity AS BIGINT) AS units_sold",
    "CASE WHEN l_discount >= 0.08D THEN 1 ELSE 0 END AS promotion_flag",
    "CASE WHEN l_tax >= 0.05D THEN 1.125D ELSE 1.0D END AS seasonality_factor",
]
FACTORY = [
    "o_orderkey AS batch_id", f"{PID} AS product_id", f"{ORDER_DATE} AS production_date",
    "CAST(o_custkey % 24 AS INT) AS production_hour", "concat('L', CAST(o_orderkey % 5 + 1 AS STRING)) AS line_id",
    "CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 64 END AS BIGINT) AS quantity_produced_liters",
    "CAST(1 + o_orderkey % 3 AS INT) AS lead_time_days",
    "CAST(CASE WHEN o_orderkey % 7 <> 0 THEN 10 + o_orderkey % 23 END AS BIGINT) AS max_capacity_per_day_liters",
    "CAST(80 + o_orderkey % 16 AS DOUBLE) AS energy_consumption_kwh",
]
LOGISTICS = [
    "l_orderkey AS batch_id", f"{PID} AS product_id", f"{LINE_DATE} AS transport_date",
    "CAST(8 + l_suppkey % 13 AS INT) AS transport_hour", "CAST(l_linenumber AS DOUBLE) AS transport_time_hours",
    "CASE WHEN l_partkey % 9 <> 0 THEN CAST(8 + l_suppkey % 17 AS DOUBLE) / 4.0D END AS transport_temperature_c",
    "CAST(2 + l_linenumber AS DOUBLE) * 2.5D AS energy_consumption_kwh",
    "concat('W', CAST(l_suppkey % 4 AS STRING)) AS warehouse_location",
]
LINE_COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
                "l_returnflag"]
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate"]


def _typed(df: DataFrame, schema) -> DataFrame:
    """Pin the canonical types (a no-op cast when the expressions already produce them)."""
    return df.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema.fields])


def production(orders: DataFrame) -> DataFrame:
    return _typed(orders.selectExpr(*PRODUCTION), schemas.PRODUCTION)


def quality_raw(orders: DataFrame) -> DataFrame:
    """Quality rows before cleaning: grades need trim/lower, flags and colour need clipping."""
    return _typed(orders.selectExpr(*QUALITY), schemas.QUALITY)


def inventory(orders: DataFrame, holes: bool = True) -> DataFrame:
    """Inventory of every batch, or with holes for what handles batches without one (joins, orphans, lookups)."""
    return _typed((orders.filter("o_orderkey % 20 <> 0") if holes else orders).selectExpr(*INVENTORY), schemas.INVENTORY)


def factory(orders: DataFrame, holes: bool = True) -> DataFrame:
    return _typed((orders.filter("o_orderkey % 13 <> 0") if holes else orders).selectExpr(*FACTORY), schemas.FACTORY)


def _line_orders(lineitem: DataFrame, orders: DataFrame, line_filter: str | None = None) -> DataFrame:
    li = lineitem.select(*LINE_COLUMNS)
    if line_filter is not None:
        li = li.filter(line_filter)
    return li.join(orders.select(*ORDER_COLUMNS), F.col("l_orderkey") == F.col("o_orderkey"), "inner")


def sales_columns(table: DataFrame) -> DataFrame:
    """The columns of line items or orders that sales are made of."""
    return table.select(*(c for c in table.columns if any(re.search(rf"\b{c}\b", e) for e in [*SALES, "l_orderkey", "o_orderkey"])))


def sales_of(joined: DataFrame) -> DataFrame:
    """Sales of line items that already carry their order's columns (null where they have none)."""
    return _typed(joined.selectExpr(*SALES), schemas.SALES)


def sales(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return sales_of(_line_orders(lineitem, orders))


def logistics(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    return _typed(_line_orders(lineitem, orders, "l_returnflag = 'R'").selectExpr(*LOGISTICS), schemas.LOGISTICS)


def product_catalog(orders: DataFrame) -> DataFrame:
    """Product dimension: one row per product id seen in the orders."""
    return orders.selectExpr(f"{PID} AS product_id").distinct() \
        .selectExpr("product_id", "concat('type_', CAST(product_id AS STRING)) AS product_type")


class DomainTables:
    """The operational tables of one data set, as lazy DataFrames (built on first use)."""

    NAMES = ("production", "quality", "inventory", "sales", "factory", "logistics", "product_catalog")

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem")

    @cached_property
    def production(self) -> DataFrame:
        return production(self.orders)

    @cached_property
    def quality(self) -> DataFrame:
        return quality_raw(self.orders)

    @cached_property
    def inventory(self) -> DataFrame:
        return inventory(self.orders)

    @cached_property
    def sales(self) -> DataFrame:
        return sales(self.lineitem, self.orders)

    @cached_property
    def factory(self) -> DataFrame:
        return factory(self.orders)

    @cached_property
    def logistics(self) -> DataFrame:
        return logistics(self.lineitem, self.orders)

    @cached_property
    def product_catalog(self) -> DataFrame:
        return product_catalog(self.orders)

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in self.NAMES}

    def whole(self) -> dict[str, DataFrame]:
        """The tables without holes, for checks that look at one table at a time."""
        return {**self.as_dict(), "inventory": inventory(self.orders, holes=False), "factory": factory(self.orders, holes=False)}


def load_domain(spark: SparkSession, sf_dir: str) -> DomainTables:
    """Domain tables over ``<sf_dir>/{orders,lineitem}.parquet``."""
    return DomainTables(spark, sf_dir)
