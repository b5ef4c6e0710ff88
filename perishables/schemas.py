"""Canonical table schemas (after name normalisation) and table keys."""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S, DT = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PRODUCTION = _schema(
    ("batch_id", L), ("product_id", L), ("product_type", S), ("production_date", DT),
    ("production_hour", I), ("grade", S), ("shelf_life_days", I),
)
QUALITY = _schema(
    ("batch_id", L), ("ph", D), ("temperature", D), ("taste", I), ("odor", I), ("fat", I),
    ("turbidity", I), ("colour", I), ("grade", S),
)
INVENTORY = _schema(
    ("batch_id", L), ("product_id", L), ("production_date", DT), ("production_hour", I),
    ("initial_stock_liters", L), ("current_stock_liters", L), ("reorder_level_liters", L),
    ("reorder_quantity_liters", L), ("warehouse_location", S), ("storage_temperature_c", D),
)
SALES = _schema(
    ("batch_id", L), ("product_id", L), ("store_id", S), ("sale_date", DT), ("sale_hour", I),
    ("units_sold", L), ("promotion_flag", I), ("seasonality_factor", D),
)
FACTORY = _schema(
    ("batch_id", L), ("product_id", L), ("production_date", DT), ("production_hour", I),
    ("line_id", S), ("quantity_produced_liters", L), ("lead_time_days", I),
    ("max_capacity_per_day_liters", L), ("energy_consumption_kwh", D),
)
LOGISTICS = _schema(
    ("batch_id", L), ("product_id", L), ("transport_date", DT), ("transport_hour", I),
    ("transport_time_hours", D), ("transport_temperature_c", D), ("energy_consumption_kwh", D),
    ("warehouse_location", S),
)
PRODUCT_CATALOG = _schema(("product_id", L), ("product_type", S))
FORECAST = _schema(
    ("product_id", L), ("store_id", S), ("forecast_date", DT), ("forecasted_sales", D),
    ("predicted_waste", D), ("suggested_production", D), ("expiration_risk", I),
    ("predicted_logistics_cost", D),
)
TABLES: dict[str, T.StructType] = {
    "production": PRODUCTION,
    "quality": QUALITY,
    "inventory": INVENTORY,
    "sales": SALES,
    "factory": FACTORY,
    "logistics": LOGISTICS,
    "product_catalog": PRODUCT_CATALOG,
    "forecast": FORECAST,
}

# --- fixed values: keys, date columns and profiled columns by table, and the curated column order ---
# Composite keys checked for duplicates; the forecast key is the real one
# (product, store, date), not a batch id.
PRIMARY_KEYS: dict[str, list[str]] = {
    "inventory": ["batch_id", "product_id"],
    "sales": ["batch_id", "product_id", "store_id", "sale_date", "sale_hour"],
    "factory": ["batch_id", "product_id"],
    "logistics": ["batch_id", "product_id", "transport_date", "transport_hour"],
    "forecast": ["product_id", "store_id", "forecast_date"],
}

# Date column checked per table (range and ISO checks).
DATE_COLUMNS: dict[str, str] = {
    "production": "production_date",
    "inventory": "production_date",
    "sales": "sale_date",
    "factory": "production_date",
    "logistics": "transport_date",
    "forecast": "forecast_date",
}

# Key columns whose stored types are profiled.
TYPE_CHECK_COLUMNS: dict[str, list[str]] = {
    "production": ["batch_id", "product_id", "production_date", "production_hour"],
    "quality": ["batch_id", "grade"],
    "inventory": ["batch_id", "product_id", "production_date", "production_hour"],
    "sales": ["batch_id", "product_id", "store_id", "sale_date", "sale_hour"],
    "factory": ["batch_id", "product_id", "production_date", "production_hour"],
    "logistics": ["batch_id", "product_id", "transport_date", "transport_hour"],
    "forecast": ["product_id", "store_id", "forecast_date"],
}

FORECAST_KEYS = ["product_id", "store_id", "forecast_date"]
SERIES_KEYS = ["product_id", "store_id"]
BATCH_KEYS = ["batch_id", "product_id"]

# Column contract of the curated sales table: preferred order first, then the
# remaining columns in the order the merge chain produces them.
CURATED_PREFERRED = [
    "batch_id", "product_id", "store_id", "date",
    "product_type", "production_date", "shelf_life_days",
    "units_sold", "available_stock", "days_to_expiration",
    "suggested_production", "expiration_risk",
    "max_capacity_per_day_liters", "energy_consumption_kwh",
    "transport_time_hours", "transport_temperature_c",
    "warehouse_location", "storage_temperature_c",
    "line_id", "lead_time_days", "quantity_produced_liters",
    "reorder_level_liters", "reorder_quantity_liters",
]
CURATED_REST = [
    "promotion_flag", "seasonality_factor", "initial_stock_liters", "current_stock_liters",
    "production_date_inv", "production_hour", "energy_consumption_kwh_log",
]
CURATED_COLUMNS = CURATED_PREFERRED + CURATED_REST
