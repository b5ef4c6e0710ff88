"""Dashboard KPIs and reports over the forecast and the curated sales fact.

Each function is ``(DataFrame, ...) -> DataFrame``.  Scalar thresholds (the
first forecast day, the last history day) are uncorrelated scalar subqueries:
Spark runs them as one small job and inlines the value, so no window without
``partitionBy`` and no cross join is needed.  Sums of forecast doubles use
exact decimal accumulation so totals do not depend on how rows are split
across tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables.functions.aggregates import EXACT_SUM_TYPE, exact_sum, exact_sum0
from perishables.functions.nulls import div_or_null, sum0
from perishables.functions.scalars import (NEAR_EXPIRY_DAYS, iso_date_text, product_label, product_name,
                                           risk_score, store_sort_number, store_sort_prefix)
from perishables.operators import forecast as forecast_ops
from perishables.session import cut_lineage
from perishables.settings import ForecastSettings, ReportFilters

MAX_MATRIX_STORES = 2000   # columns of the risk matrix

# --- fixed values (drill-down report headings, in display order) ---
DRILLDOWN_COLUMNS = {
    "batch_id": "Batch ID",
    "product_id": "Product",
    "store_id": "Store",
    "date": "Date",
    "production_date": "Production Date",
    "shelf_life_days": "Shelf-life (days)",
    "days_to_expiration": "Days to Expiration",
    "available_stock": "Available Stock (L)",
    "warehouse_location": "Warehouse",
    "storage_temperature_c": "Storage Temp (ºC)",
    "transport_temperature_c": "Transport Temp (ºC)",
    "energy_consumption_kwh": "Energy (kWh)",
}
# --------------------------------------------------------------------


# ---------------------------------------------------------------- filters
def apply_filters(df: DataFrame, filters: ReportFilters) -> DataFrame:
    """Optional product and store equality filters (store compared as text)."""
    if filters.product_id is not None and "product_id" in df.columns:
        df = df.filter(F.col("product_id") == F.lit(int(filters.product_id)))
    if filters.store_id is not None and "store_id" in df.columns:
        df = df.filter(F.col("store_id").cast("string") == F.lit(str(filters.store_id)))
    return df


def restrict_horizon(df: DataFrame, date_col: str, days: int | None) -> DataFrame:
    """C4: rows within the first ``days`` days from the minimum date of ``date_col``."""
    if days is None:
        return df
    start = df.select(F.min(date_col)).scalar()
    return df.filter(F.col(date_col).between(start, F.date_add(start, int(days) - 1)))


def forecast_window(forecast: DataFrame, filters: ReportFilters) -> DataFrame:
    """C3 + C4: the forecast rows a dashboard view summarises."""
    return restrict_horizon(apply_filters(forecast, filters), "forecast_date", filters.horizon_days)


# ---------------------------------------------------------------- product map
def product_map(catalog: DataFrame) -> DataFrame:
    """Most frequent product type per product id (ties: the smallest type)."""
    return (catalog.select("product_id", F.col("product_type").cast("string").alias("product_type"))
            .dropna(subset=["product_id", "product_type"])
            .groupBy("product_id")
            .agg(F.mode("product_type", deterministic=True).alias("product_type")))


def product_labels(pmap: DataFrame) -> DataFrame:
    """Product id, display name and "id • Name" label."""
    return pmap.select("product_id",
                       product_name(F.col("product_id"), F.col("product_type")).alias("product_name"),
                       product_label(F.col("product_id"), F.col("product_type")).alias("product_label"))


def _with_labels(df: DataFrame, pmap: DataFrame) -> DataFrame:
    """Left join of product labels; unknown ids get the default ``Product <id>`` name."""
    joined = df.join(pmap.select("product_id", "product_type"), "product_id", "left")
    return joined.withColumns({
        "product_name": product_name(F.col("product_id"), F.col("product_type")),
        "product_label": product_label(F.col("product_id"), F.col("product_type")),
    }).drop("product_type")


# ---------------------------------------------------------------- KPIs
def kpi_overview(fcw: DataFrame, sc: DataFrame) -> DataFrame:
    """Forecast total, waste total (horizon window), rows near expiry, stock total (empty -> 0)."""
    near = sc.select(F.count_if(F.col("days_to_expiration") <= NEAR_EXPIRY_DAYS).cast("bigint")).scalar()
    stock = sc.select(F.coalesce(F.sum("available_stock").cast("double"), F.lit(0.0))).scalar()
    return fcw.agg(exact_sum0(F.col("forecasted_sales")).alias("total_forecast_units"),
                   exact_sum0(F.col("predicted_waste")).alias("total_predicted_waste")) \
        .select("*", near.alias("near_expiration_rows"), stock.alias("current_available_stock"))


def forecast_daily(fcw: DataFrame) -> DataFrame:
    """Forecast demand per day."""
    return fcw.groupBy("forecast_date").agg(exact_sum(F.col("forecasted_sales")).alias("forecasted_units"))


def asof_stock(sc: DataFrame) -> DataFrame:
    """stock summed over the rows of the last history day (0 when there is none); one pass, by day and then over the days."""
    days = sc.dropna(subset=["date"]).groupBy("date").agg(F.sum("available_stock").cast("double").alias("stock"))
    return days.agg(F.coalesce(F.max_by("stock", "date"), F.lit(0.0)).alias("asof_stock"))


def projected_stock(fcw: DataFrame, sc: DataFrame) -> DataFrame:
    """Per forecast day: demand, cumulative demand, max(as-of stock - cumulative, 0).

    The running total orders the per-day rows (at most one per horizon day), so
    the single-partition window holds a horizon's worth of rows, not data volume.
    """
    daily = fcw.groupBy("forecast_date").agg(F.sum(F.col("forecasted_sales").cast(EXACT_SUM_TYPE)).alias("d"))
    last = sc.select(F.max("date")).scalar()
    stock = sc.filter(F.col("date") == last).select(
        F.coalesce(F.sum("available_stock").cast("double"), F.lit(0.0))).scalar()
    w = Window.orderBy("forecast_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = F.sum("d").over(w).cast("double")
    proj = stock - cum
    return daily.select(
        F.col("forecast_date").alias("date"),
        F.col("d").cast("double").alias("forecasted_units"),
        cum.alias("cumulative_forecast"),
        F.when(proj > 0, proj).otherwise(F.lit(0.0)).alias("projected_stock"))


def kpi_sustainability(sc: DataFrame) -> DataFrame:
    """Factory kWh per litre, mean transport temperature, mean daily energy.

    ``avg_daily_energy_kwh`` sums the column the source pipeline uses (factory
    energy, repeated per store-day); ``avg_daily_logistics_energy_kwh`` is the
    corrected variant over the logistics energy column.
    """
    per_litre = div_or_null("energy_consumption_kwh", "quantity_produced_liters").cast(EXACT_SUM_TYPE)
    temperature = F.col("transport_temperature_c").cast(EXACT_SUM_TYPE)
    # one pass: sums and counts per day, then over the days (rows without a date count for the means over rows only)
    per_day = sc.groupBy("date").agg(
        F.sum(per_litre).alias("kl"), F.count(per_litre).alias("n_kl"), F.sum(temperature).alias("t"),
        F.count(temperature).alias("n_t"), sum0("energy_consumption_kwh").alias("e"),
        sum0("energy_consumption_kwh_log").alias("e_log"))

    def mean(total: str, n: str) -> Column:
        return F.coalesce(F.sum(total).cast("double") / F.nullif(F.sum(n), F.lit(0)).cast("double"), F.lit(0.0))

    def daily_mean(column: str) -> Column:
        return F.coalesce(F.avg(F.when(F.col("date").isNotNull(), F.col(column))), F.lit(0.0))

    return per_day.agg(
        mean("kl", "n_kl").alias("factory_kwh_per_liter"), mean("t", "n_t").alias("avg_transport_temperature_c"),
        daily_mean("e").alias("avg_daily_energy_kwh"), daily_mean("e_log").alias("avg_daily_logistics_energy_kwh"))


# ---------------------------------------------------------------- one pass over curated and forecast
def summary_days(curated: DataFrame, filters: ReportFilters = ReportFilters(), settings: ForecastSettings = ForecastSettings()) -> DataFrame:
    """E8, E9, F3, F5 and J10 from one evaluation of the curated table: one row per forecast day.

    Levels of grouping instead of scalars that run the chain again: what the KPIs need of the curated rows (rows near expiry, stock)
    is counted along with the daily series, summed along with the series' scalars, and rides on each series' first forecast row.
    That row lies on the day after the series' last one, so the as-of stock is what the latest such day carries.
    Per forecast day: ``units``, ``waste``, and of the series that begin there ``n_first``, ``near``, ``stock`` and ``last_stock``.
    """
    near = F.count_if(F.col("days_to_expiration") <= NEAR_EXPIRY_DAYS).alias("near_rows")
    daily = forecast_ops.product_store_daily(apply_filters(curated, filters), [near])
    profile = forecast_ops.series_profile(daily, settings.baseline_window,
                                          [F.sum("near_rows").alias("near_rows"), F.sum("available_stock").alias("stock_total")]) \
        .withColumn("day_stock", F.col("last_stock"))
    rows = forecast_ops.forecast_from_profile(profile, None, settings, ["step", "near_rows", "stock_total", "day_stock"])
    first = F.col("step") == 1

    def of_first(column: str) -> Column:
        return F.sum(F.when(first, F.col(column)))

    return rows.groupBy("forecast_date").agg(
        F.sum(F.col("forecasted_sales").cast(EXACT_SUM_TYPE)).alias("units"), F.sum(F.col("predicted_waste").cast(EXACT_SUM_TYPE)).alias("waste"),
        F.count_if(first).alias("n_first"), of_first("near_rows").alias("near"), of_first("stock_total").alias("stock"),
        of_first("day_stock").alias("last_stock"))


def _whole(days: DataFrame, horizon: int | None) -> DataFrame:
    """The summary's days with ``inside`` (the horizon) and ``asof`` (the stock of the last history day); one row per
    forecast day, so the window over all of them holds a calendar, not data."""
    every = Window.partitionBy(F.lit(1))
    inside = F.lit(True) if horizon is None else F.col("forecast_date") < F.date_add(F.min("forecast_date").over(every), int(horizon))
    asof = F.max_by("last_stock", F.when(F.col("n_first") > 0, F.col("forecast_date"))).over(every)
    return days.withColumns({"inside": inside, "asof": F.coalesce(asof, F.lit(0.0))})


def summary_kpis(days: DataFrame, horizon: int | None) -> DataFrame:
    """E8 from ``summary_days``."""
    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("inside"), F.col(column))).cast("double"), F.lit(0.0))

    return _whole(days, horizon).agg(
        total("units").alias("total_forecast_units"), total("waste").alias("total_predicted_waste"),
        F.coalesce(F.sum("near"), F.lit(0)).cast("bigint").alias("near_expiration_rows"),
        F.coalesce(F.sum("stock").cast("double"), F.lit(0.0)).alias("current_available_stock"))


def summary_demand(days: DataFrame, horizon: int | None) -> DataFrame:
    """E9 from ``summary_days``."""
    return _whole(days, horizon).filter("inside").select("forecast_date", F.col("units").cast("double").alias("forecasted_units"))


def summary_stock(days: DataFrame, horizon: int | None) -> DataFrame:
    """F3/J10 from ``summary_days``."""
    cum = F.sum("units").over(Window.partitionBy(F.lit(1)).orderBy("forecast_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)).cast("double")
    left = F.col("asof") - F.col("cumulative_forecast")
    return _whole(days, horizon).filter("inside").withColumn("cumulative_forecast", cum).select(
        F.col("forecast_date").alias("date"), F.col("units").cast("double").alias("forecasted_units"), "cumulative_forecast",
        F.when(left > 0, left).otherwise(F.lit(0.0)).alias("projected_stock"))


# ---------------------------------------------------------------- tables
def batch_drilldown(sc: DataFrame, *, rename: bool = True) -> DataFrame:
    """Lot-level table, first row per (batch, date, store), sorted, headed.

    "First" follows the curated order, i.e. the smallest product id.
    """
    cols = [c for c in DRILLDOWN_COLUMNS if c in sc.columns]
    key = [c for c in ("batch_id", "date", "store_id") if c in cols]
    order = [F.col("product_id").asc_nulls_last()] if "product_id" in cols else [F.lit(1)]
    w = Window.partitionBy(*key).orderBy(*order)
    drill = sc.select(*cols).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    drill = drill.withColumns({c: iso_date_text(F.col(c)) for c in ("date", "production_date") if c in cols})
    drill = drill.orderBy("date", "batch_id")
    return drill.withColumnsRenamed({c: DRILLDOWN_COLUMNS[c] for c in cols}) if rename else drill


def risk_pairs(sc: DataFrame) -> DataFrame:
    """Worst risk score (2 high, 1 medium, 0 low) per (product, store)."""
    return (sc.select("product_id", "store_id", "days_to_expiration")
            .dropna()
            .groupBy("product_id", "store_id")
            .agg(F.max(risk_score(F.col("days_to_expiration"))).alias("risk_score")))


def store_order(sc: DataFrame) -> DataFrame:
    """Distinct stores with their natural sort keys."""
    return (sc.select(F.col("store_id").cast("string").alias("store_id")).dropna().distinct()
            .select("store_id", store_sort_prefix(F.col("store_id")).alias("sort_prefix"),
                    store_sort_number(F.col("store_id")).alias("sort_number")))


def product_options(pmap: DataFrame) -> DataFrame:
    """Product ids offered by the product filter, numerically ordered."""
    return pmap.select("product_id").distinct().orderBy("product_id")


def risk_heatmap(sc: DataFrame, pmap: DataFrame) -> DataFrame:
    """H4: product x store matrix of the worst risk (missing pair -> 0), stores in natural order.

    The pairs (one row each) are written once; the stores and the matrix come from them.  A matrix of
    more than ``MAX_MATRIX_STORES`` columns is refused: ``risk_pairs`` has the same content in long form.
    Rows are keyed by product id, so products sharing a name do not clash.
    """
    pairs = cut_lineage(risk_pairs(sc))
    stores = [r["store_id"] for r in
              store_order(pairs).orderBy("sort_prefix", "sort_number", "store_id")
              .limit(MAX_MATRIX_STORES + 1).collect()]
    if len(stores) > MAX_MATRIX_STORES:
        raise ValueError(f"more than {MAX_MATRIX_STORES} stores: use risk_pairs")
    heat = pairs.groupBy("product_id").pivot("store_id", stores).agg(F.max("risk_score"))
    heat = heat.fillna(0, subset=stores) if stores else heat
    heat = _with_labels(heat, pmap)
    return heat.select("product_id", F.col("product_name").alias("product"), *stores).orderBy("product_id")


def production_plan(fcw: DataFrame, pmap: DataFrame) -> DataFrame:
    """Date, product label, store, suggested production, sorted by date, label, store."""
    plan = _with_labels(fcw.select("forecast_date", "product_id", "store_id", "suggested_production"), pmap)
    return plan.select(
        F.col("forecast_date").alias("Date"),
        F.col("product_label").alias("Product"),
        F.col("store_id").cast("string").alias("Store"),
        F.col("suggested_production").alias("Suggested Production (L/day)"),
    ).orderBy("Date", "Product", "Store")
