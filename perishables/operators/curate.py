"""Curation ETL: catalog, daily sales, daily logistics, merge chain, derivations.

Plan shape at scale: daily sales are pre-aggregated map-side (partial
aggregation) before one shuffle on the four sales keys; the three batch-keyed
dimensions and the daily logistics join on (batch_id, product_id[, date]) —
sort-merge joins that AQE may turn into broadcasts when the measured side is
small, and split when one batch key is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from perishables import schemas
from perishables.functions.coerce import (add_missing_columns, date_expr, id_expr, number_expr,
                                          rename_first_present, require_columns, text_expr, units_expr)
from perishables.functions.nulls import clip_lower0, flag, min_with_cap, sum0
from perishables.functions.scalars import NEAR_EXPIRY_DAYS, expiry_date

SALES_KEYS = ["batch_id", "product_id", "store_id", "date"]
# --- fixed values: the columns that each join brings into the curated table ---
CATALOG_COLUMNS = ["batch_id", "product_id", "product_type", "shelf_life_days", "production_date"]
INVENTORY_COLUMNS = ["initial_stock_liters", "current_stock_liters", "reorder_level_liters",
                     "reorder_quantity_liters", "warehouse_location", "storage_temperature_c",
                     "production_date", "production_hour"]
FACTORY_COLUMNS = ["line_id", "quantity_produced_liters", "lead_time_days",
                   "max_capacity_per_day_liters", "energy_consumption_kwh"]


def catalog(production: DataFrame) -> DataFrame:
    """Distinct (batch, product, type, shelf life, production date) rows.

    The distinct and the (batch, product) join downstream each shuffle the production table (one
    row per batch, narrow columns): a partitioning of our own would save one of the two,
    but AQE does not split a hot batch of the sales side against it.
    """
    return production.select(*CATALOG_COLUMNS).dropna(how="all").dropDuplicates()


def map_sales(sales: DataFrame, *, null_store: str = "literal", on_missing: str = "raise") -> DataFrame:
    """Canonical sales rows with ``date`` and ``units_sold``, coerced, no null keys.

    Accepts legacy names (``ds`` for the date, ``units`` or ``y`` for units) and
    raw text columns: ids must be integral, dates start with an ISO day, units
    parse as numbers (bad or missing -> 0, truncated).  On typed input every
    coercion is a no-op.  Rows without a store stay under the text "None"
    (``null_store="drop"`` removes them); a missing needed column is an error, or with
    ``on_missing="empty"`` makes the result empty, as in the reference.
    """
    df = rename_first_present(sales, "date", ["sale_date", "ds", "date"])
    df = rename_first_present(df, "units_sold", ["units", "y", "units_sold"])
    needed = ["batch_id", "product_id", "store_id", "date", "units_sold"]
    if require_columns(df, needed, on_missing) is None:
        df = add_missing_columns(df, {c: None for c in needed}).limit(0)
    df = add_missing_columns(df, {"sale_hour": 12, "promotion_flag": 0, "seasonality_factor": 1.0})
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    df = df.withColumns({
        "batch_id": id_expr(F.col("batch_id"), types["batch_id"]),
        "product_id": id_expr(F.col("product_id"), types["product_id"]),
        "store_id": text_expr(F.col("store_id"), null_literal=(null_store == "literal")),
        "date": date_expr(F.col("date"), types["date"]),
        "units_sold": units_expr(F.col("units_sold"), types["units_sold"]),
    })
    if null_store == "literal":
        return df.dropna(subset=["batch_id", "product_id", "date"])
    return df.dropna(subset=["batch_id", "product_id", "date", "store_id"])


def daily_sales_aggs() -> list:
    """E1 measures: sum units (0 if none), max promotion flag, mean seasonality."""
    return [sum0("units_sold").cast("bigint").alias("units_sold"),
            F.max("promotion_flag").alias("promotion_flag"),
            F.avg("seasonality_factor").alias("seasonality_factor")]


def daily_sales(sales: DataFrame, *, null_store: str = "literal") -> DataFrame:
    """Hourly -> daily per (batch, product, store, date): sum units, max promotion, mean seasonality."""
    return map_sales(sales, null_store=null_store).groupBy(*SALES_KEYS).agg(*daily_sales_aggs())


def daily_logistics(logistics: DataFrame) -> DataFrame:
    """Per (batch, product, day): sum hours, mean temperature, sum energy.

    The day is ``transport_date`` (or a legacy ``date`` column); ids, dates and
    measures are coerced like the sales columns; rows without a key are dropped.
    """
    df = logistics
    if "transport_date" in df.columns:
        df = df.withColumn("date", F.col("transport_date"))
    df = add_missing_columns(df, {"transport_time_hours": None, "transport_temperature_c": None,
                                  "energy_consumption_kwh": None})
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    df = df.withColumns({
        "batch_id": id_expr(F.col("batch_id"), types["batch_id"]),
        "product_id": id_expr(F.col("product_id"), types["product_id"]),
        "date": date_expr(F.col("date"), types["date"]),
        **{c: number_expr(F.col(c), types[c])
           for c in ("transport_time_hours", "transport_temperature_c", "energy_consumption_kwh")},
    })
    return (df.dropna(subset=["batch_id", "product_id", "date"])
            .groupBy("batch_id", "product_id", "date")
            .agg(sum0("transport_time_hours").cast("double").alias("transport_time_hours"),
                 F.avg("transport_temperature_c").alias("transport_temperature_c"),
                 sum0("energy_consumption_kwh").cast("double").alias("energy_consumption_kwh")))


def join_catalog(daily: DataFrame, cat: DataFrame) -> DataFrame:
    """Left join the catalog on (batch, product)."""
    return daily.join(cat, schemas.BATCH_KEYS, "left")


def join_inventory(cur: DataFrame, inventory: DataFrame, *, missing: str = "null") -> DataFrame:
    """Left join inventory; a clashing ``production_date`` arrives as ``production_date_inv``.

    A batch without an inventory row has unknown stock; ``missing="zero"`` makes its litres 0 (T16: what a
    run without any inventory table amounts to in the source pipeline).
    """
    inv = inventory.select(*schemas.BATCH_KEYS, *INVENTORY_COLUMNS)
    clash = [c for c in INVENTORY_COLUMNS if c in cur.columns]
    inv = inv.withColumnsRenamed({c: f"{c}_inv" for c in clash})
    joined = cur.join(inv, schemas.BATCH_KEYS, "left")
    return joined.fillna(0, subset=[c for c in INVENTORY_COLUMNS if "liters" in c]) if missing == "zero" else joined


def join_factory(cur: DataFrame, factory: DataFrame) -> DataFrame:
    """D3: left join the factory columns on (batch, product)."""
    fac = factory.select(*schemas.BATCH_KEYS, *FACTORY_COLUMNS)
    clash = [c for c in FACTORY_COLUMNS if c in cur.columns]
    fac = fac.withColumnsRenamed({c: f"{c}_fac" for c in clash})
    return cur.join(fac, schemas.BATCH_KEYS, "left")


def join_logistics(cur: DataFrame, logistics_daily: DataFrame) -> DataFrame:
    """Left join daily logistics on (batch, product, date); clashes get ``_log``."""
    keys = ["batch_id", "product_id", "date"]
    clash = [c for c in logistics_daily.columns if c not in keys and c in cur.columns]
    return cur.join(logistics_daily.withColumnsRenamed({c: f"{c}_log" for c in clash}), keys, "left")


def derive(cur: DataFrame) -> DataFrame:
    """Available stock, days to expiration, suggested production, expiration risk."""
    available = clip_lower0(F.col("current_stock_liters") - F.col("units_sold"))
    days = clip_lower0(F.datediff(expiry_date(F.col("production_date"), F.col("shelf_life_days")), F.col("date")))
    cur = cur.withColumns({"available_stock": available, "days_to_expiration": days})
    gap = clip_lower0(F.col("units_sold") - F.col("available_stock"))
    return cur.withColumns({
        "suggested_production": min_with_cap(gap, F.col("max_capacity_per_day_liters")),
        "expiration_risk": flag((F.col("days_to_expiration") <= NEAR_EXPIRY_DAYS) & (F.col("available_stock") > 0)),
    })


def order_curated(cur: DataFrame) -> DataFrame:
    """Preferred columns first, then the rest in arrival order."""
    preferred = [c for c in schemas.CURATED_PREFERRED if c in cur.columns]
    rest = [c for c in cur.columns if c not in schemas.CURATED_PREFERRED]
    return cur.select(*preferred, *rest)


def curated_sales(production: DataFrame, inventory: DataFrame, sales: DataFrame, factory: DataFrame,
                  logistics: DataFrame, *, null_store: str = "literal",
                  missing_inventory: str = "null") -> DataFrame:
    """The curated sales fact: E1 -> D1 -> D2 -> D3 -> D4 -> J1-J5 -> B13 (30 columns)."""
    cur = join_catalog(daily_sales(sales, null_store=null_store), catalog(production))
    cur = join_inventory(cur, inventory, missing=missing_inventory)
    cur = join_factory(cur, factory)
    cur = join_logistics(cur, daily_logistics(logistics))
    return order_curated(derive(cur))


def curated_from(tables) -> DataFrame:
    """``curated_sales`` over a ``DomainTables``-like object."""
    return curated_sales(tables.production, tables.inventory, tables.sales, tables.factory, tables.logistics)
