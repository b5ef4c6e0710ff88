"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query reads the provided tables of ``sf_dir`` (through the domain views)
in full; parameters below are fixed so a query is reproducible.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables import schemas
from perishables.functions import coerce
from perishables.functions.nulls import clip_range
from perishables.functions.scalars import PRODUCT_TYPES, expiry_date, shelf_life_days, weekday_factor
from perishables.operators import curate, forecast, holt_winters, quality, reports
from perishables.session import scratch_path
from perishables.settings import ForecastSettings, ReportFilters
from perishables.sources import domain_views, forecast_months, forecast_store, incremental, tables
from perishables.streaming import forecast_stream, incremental_sales, late_orders

# --- fixed query parameters ---
DASHBOARD_FILTERS = ReportFilters(product_id=None, store_id=None, horizon_days=14)
FILTERED = ReportFilters(product_id=3, store_id="S7", horizon_days=14)
BASELINE = ForecastSettings(model="baseline")
ETS = ForecastSettings(model="ets")
CHOICE = ForecastSettings(model="ets", min_history_days=950)
FALLBACK_AS_OF = dt.date(2001, 8, 20)
NEW_BATCH_CUTOFF = dt.date(1998, 1, 1)   # batches produced before it count as loaded
DONE_STEPS = 20                          # forecast steps already stored in the incremental queries
SAMPLE_ROWS = 5
# days on which the second and third load of the forecast stream begin; the second is shorter than the horizon
JOIN_LOADS = [dt.datetime(1997, 3, 4), dt.datetime(1999, 6, 20)]   # where the second and third load of the two streams begin
LOAD_STARTS = [dt.date(1996, 1, 1), dt.date(1996, 1, 11)]

Query = Callable[[SparkSession, str], DataFrame]


def _domain(spark: SparkSession, sf: str) -> domain_views.DomainTables:
    return domain_views.load_domain(spark, sf)


def _curated(spark: SparkSession, sf: str) -> DataFrame:
    return curate.curated_from(_domain(spark, sf))


def _read(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


# ------------------------------------------------------------ raw text input
def raw_sales_text(spark: SparkSession, sf: str) -> DataFrame:
    """Text-typed sales fields derived from every line item (ids with blanks/decimals/letters,
    mixed date texts, signed decimal and bad unit texts) for the coercion queries."""
    li = _read(spark, sf, "lineitem")
    key = F.col("l_orderkey").cast("string")
    qty = F.col("l_quantity").cast("bigint").cast("string")
    day = F.to_date("l_shipdate").cast("string")
    r4 = (F.col("l_linenumber") % 4).cast("int")
    d9 = (F.col("l_suppkey") % 9).cast("int")
    u4 = (F.col("l_partkey") % 4).cast("int")
    return li.select(
        "l_orderkey", "l_linenumber",
        F.when(r4 == 0, F.concat(F.lit(" "), key, F.lit(" "))).when(r4 == 1, key)
        .when(r4 == 2, F.concat(key, F.lit(".7"))).otherwise(F.concat(F.lit("b"), key)).alias("batch_id"),
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey").cast("string")).alias("product_id"),
        F.when(d9 == 0, day).when(d9 == 1, F.concat(day, F.lit(" 10:00")))
        .when(d9 == 2, F.year("l_shipdate").cast("string")).when(d9 == 3, F.lit("x"))
        .when(d9 == 5, F.replace(day, F.lit("-"), F.lit("/"))).when(d9 == 6, F.replace(day, F.lit("-"), F.lit("")))
        .when(d9 == 7, F.concat(day, F.lit("T23:30:00+02:00"))).when(d9 == 8, F.concat(day, F.lit("1"))).alias("sale_date"),
        F.when(u4 == 0, F.concat(qty, F.lit(".7"))).when(u4 == 1, F.concat(F.lit("-"), qty, F.lit(".9")))
        .when(u4 == 2, F.lit("abc")).alias("units"),
    )


def _parsed_raw(spark: SparkSession, sf: str) -> DataFrame:
    raw = raw_sales_text(spark, sf)
    s = T.StringType()  # every raw column is text
    return raw.select(
        "l_orderkey", "l_linenumber",
        coerce.id_expr(F.col("batch_id"), s).alias("batch_id"),
        coerce.id_expr(F.col("product_id"), s).alias("product_id"),
        coerce.date_expr(F.col("sale_date"), s).alias("sale_date"),
        coerce.number_expr(F.col("units"), s).alias("units_value"),
        coerce.units_expr(F.col("units"), s).alias("units_sold"),
    )


def q_coerce_ids(spark, sf):
    p = _parsed_raw(spark, sf)
    return p.select("l_orderkey", "l_linenumber", "batch_id", "product_id")


def q_parse_dates(spark, sf):
    return _parsed_raw(spark, sf).select("l_orderkey", "l_linenumber", "sale_date")


def q_parse_numbers(spark, sf):
    return _parsed_raw(spark, sf).select("l_orderkey", "l_linenumber", "units_value")


def q_units_int(spark, sf):
    return _parsed_raw(spark, sf).select("l_orderkey", "l_linenumber", "units_sold")


def q_drop_nulls(spark, sf):
    return _parsed_raw(spark, sf).dropna(subset=["batch_id", "product_id", "sale_date"]) \
        .select("l_orderkey", "l_linenumber", "batch_id", "product_id", "sale_date")


def q_bytes_to_int(spark, sf):
    li = _read(spark, sf, "lineitem")
    # the whole key in as few bytes as it takes, lowest first, then n zero bytes; line 7 has none, line 6 nine high ones
    size = F.ceil(F.length(F.hex("l_orderkey")) / 2).cast("int")
    low_first = F.array_join(F.transform(F.sequence(F.lit(1), size), lambda i: F.hex(
        F.substring(F.unhex(F.lpad(F.hex("l_orderkey"), 16, "0")), 9 - i, 1))), "")
    raw = F.when(F.col("l_linenumber") == 7, F.unhex(F.lit(""))).when(F.col("l_linenumber") == 6, F.unhex(F.lit("FF" * 9))) \
        .otherwise(F.unhex(F.concat(low_first, F.repeat(F.lit("00"), F.col("l_linenumber").cast("int")))))
    return li.select("l_orderkey", "l_linenumber", coerce.bytes_le_to_long(raw).alias("batch_id"))


def q_normalize_names(spark, sf):
    li = _read(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias(" Batch ID "), F.col("l_partkey").alias("Product ID"),
        F.col("l_linenumber").alias("Line Number"), F.col("l_quantity").alias("UNITS"))
    return coerce.normalize_column_names(li)


def q_alias_columns(spark, sf):
    s = _domain(spark, sf).sales.withColumnsRenamed({"sale_date": "ds", "units_sold": "y"})
    return curate.map_sales(s).select("batch_id", "product_id", "store_id", "date", "sale_hour", "units_sold")


def q_default_columns(spark, sf):
    s = _domain(spark, sf).sales.drop("sale_hour", "promotion_flag", "seasonality_factor")
    return curate.map_sales(s).select("batch_id", "product_id", "store_id", "date", "units_sold", "sale_hour",
                                      "promotion_flag", "seasonality_factor")


# ------------------------------------------------------------ sources / sinks
def q_scan_sales(spark, sf):
    return _domain(spark, sf).sales


def q_quality_clean(spark, sf):
    return tables.clean_quality(_domain(spark, sf).quality)


def q_clip_range(spark, sf):
    q = _domain(spark, sf).quality
    return q.select("batch_id", *[clip_range(F.col(c), 0, 1).alias(c) for c in ("taste", "odor", "fat", "turbidity")],
                    clip_range(F.col("colour"), 0, 255).alias("colour"))


def q_shelf_life(spark, sf):
    q = tables.clean_quality(_domain(spark, sf).quality)
    return q.select("batch_id", "grade", "ph", "temperature",
                    shelf_life_days(F.col("grade"), F.col("temperature"), F.col("ph")).alias("shelf_life_days"))


def q_stored_legacy_sales(spark, sf):
    """Line items stored as text under legacy names, read back as a stored table, then aggregated."""
    s = _domain(spark, sf).sales
    path = scratch_path(spark, "legacy-sales")
    s.select(F.col("batch_id").cast("string"), F.col("product_id").cast("string"), "store_id",
             F.date_format("sale_date", "yyyy/MM/dd").alias("ds"), F.col("units_sold").cast("string").alias("y"),
             "promotion_flag", F.col("seasonality_factor").alias(" Seasonality Factor ")).write.parquet(path)
    return curate.daily_sales(tables.load_table(spark, path, "sales"))


def q_stored_legacy_logistics(spark, sf):
    """Transports stored with a text ``date`` only, read back as a stored table, then aggregated."""
    path = scratch_path(spark, "legacy-logistics")
    moved = _domain(spark, sf).logistics.withColumn("date", F.date_format("transport_date", "yyyyMMdd"))
    moved.drop("transport_date").write.parquet(path)
    return curate.daily_logistics(tables.load_table(spark, path, "logistics"))


def q_daily_sales_null_store(spark, sf):
    """Sales whose store is not known; their rows stay, under the text "None"."""
    s = _domain(spark, sf).sales
    return curate.daily_sales(s.withColumn("store_id", F.when(F.col("sale_hour") % 4 != 1, F.col("store_id"))))


def q_weekday_factor(spark, sf):
    return _domain(spark, sf).sales.select(F.col("sale_date").alias("date")).distinct() \
        .select("date", weekday_factor(F.col("date")).alias("demand_factor"))


def q_expiry_date(spark, sf):
    c = curate.catalog(_domain(spark, sf).production)
    return c.select("batch_id", "production_date", "shelf_life_days",
                    expiry_date(F.col("production_date"), F.col("shelf_life_days")).alias("expiry_date"))


def _forecast(spark, sf, settings=BASELINE, existing=None, cur=None):
    return forecast.forecast_rows(_curated(spark, sf) if cur is None else cur, existing, settings)


def _done(cur: DataFrame) -> DataFrame:
    """Forecast keys already stored: the first DONE_STEPS days after each series' history."""
    f = forecast.future_dates(forecast.series_scalars(forecast.product_store_daily(cur)), DONE_STEPS)
    return f.select(*schemas.FORECAST_KEYS)


def q_forecast_export(spark, sf):
    return forecast_store.export_rows(_forecast(spark, sf))


def q_forecast_json_roundtrip(spark, sf):
    path = scratch_path(spark, "forecast-json")
    forecast_store.write_json(_forecast(spark, sf), path)
    return forecast_store.read_json(spark, path)


def q_forecast_upsert(spark, sf):
    cur = _curated(spark, sf)
    existing = forecast.forecast_rows(cur, None, ForecastSettings(model="baseline", horizon_days=30))
    newer = forecast.forecast_rows(cur, None, ForecastSettings(model="baseline", horizon_days=40))
    newer = newer.join(_done(cur), schemas.FORECAST_KEYS, "left_anti")
    return forecast.upsert(existing, newer)


def _newer(cur: DataFrame) -> DataFrame:
    """A longer forecast without the days already stored."""
    rows = forecast.forecast_rows(cur, None, ForecastSettings(model="baseline", horizon_days=40))
    return rows.join(_done(cur), schemas.FORECAST_KEYS, "left_anti")


def q_forecast_month_upsert(spark, sf):
    """The forecast stored in month folders; the upsert reads and writes the months that its rows fall into."""
    cur, path = _curated(spark, sf), scratch_path(spark, "forecast-by-month")
    forecast_months.upsert_months(spark, path, forecast.forecast_rows(cur, None, BASELINE))
    forecast_months.upsert_months(spark, path, _newer(cur))
    return forecast_months.read_months(spark, path)


def q_forecast_migration(spark, sf):
    """A stored forecast of the legacy schema (per batch) makes way for the first upsert."""
    path = scratch_path(spark, "forecast-legacy")
    old = _curated(spark, sf).select("batch_id", F.col("date").cast("string").alias("forecast_date"), F.col("units_sold").cast("double").alias("forecasted_sales"))
    tables.write_table(old, path)
    forecast_months.upsert_months(spark, path, _forecast(spark, sf))
    return forecast_months.read_months(spark, path)


def q_forecast_compact(spark, sf):
    """steps counted over the days still to forecast, so the fitted trend and season start anew there."""
    cur = _curated(spark, sf)
    return _forecast(spark, sf, ForecastSettings(model="ets", step_mode="compact"), _done(cur), cur)


def q_rejected_dates(spark, sf):
    """How many date texts of the raw sales no format reads, so that no row goes unreported."""
    return quality.rejected_dates({"sales": raw_sales_text(spark, sf)})


def q_curated_bucketed(spark, sf):
    """The curated inputs stored in buckets by batch; the whole chain then runs without an exchange."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = {}
    for name, df in _domain(spark, sf).as_dict().items():
        if "batch_id" in df.columns and name != "quality":
            stored[name] = tables.write_bucketed(df, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, f"bucketed-{name}"), ["batch_id"], buckets)
    return curate.curated_sales(*(stored[n] for n in ("production", "inventory", "sales", "factory", "logistics")))


def q_forecast_fallback(spark, sf):
    return forecast_store.fallback_window(_stored_forecast(spark, sf), 30, FALLBACK_AS_OF)


def _loaded_and_new(spark, sf):
    p = _domain(spark, sf).production
    loaded = p.filter(F.col("production_date") < F.lit(NEW_BATCH_CUTOFF))
    return p, loaded


def q_new_batches(spark, sf):
    p, loaded = _loaded_and_new(spark, sf)
    return incremental.new_rows_after(p, "production_date", loaded)


def q_append_union(spark, sf):
    p, loaded = _loaded_and_new(spark, sf)
    new = incremental.new_rows_after(p, "production_date", loaded).drop("grade")
    return incremental.append(loaded, new)


def q_last_date(spark, sf):
    return incremental.last_date(_domain(spark, sf).production, "production_date")


def q_ensure_dimension(spark, sf):
    existing = _domain(spark, sf).product_catalog
    kinds = [*PRODUCT_TYPES, *(f"{t} organic" for t in PRODUCT_TYPES)]  # the second half is not in the table yet
    seed = spark.createDataFrame([(i + 1, t) for i, t in enumerate(kinds)], schemas.PRODUCT_CATALOG)
    return incremental.ensure_dimension(existing, seed, ["product_id"])


def q_assign_ids(spark, sf):
    p, loaded = _loaded_and_new(spark, sf)
    new = p.filter(F.col("production_date") >= F.lit(NEW_BATCH_CUTOFF)) \
        .select(F.col("batch_id").alias("source_batch_id"), "product_id", "production_date")
    start = incremental.high_water_mark(loaded, "batch_id", 0)
    return incremental.assign_ids(new, "new_batch_id", ["production_date", "source_batch_id"], start)


def q_produced_quantity(spark, sf):
    d = _domain(spark, sf)
    return incremental.produced_quantity(d.production.select("batch_id", "product_id"), d.inventory)


def q_batch_stock(spark, sf):
    d = _domain(spark, sf)
    return incremental.batch_stock(d.production.select("batch_id", "product_id"), d.inventory)


# ------------------------------------------------------------ curation
def q_catalog(spark, sf):
    return curate.catalog(_domain(spark, sf).production)


def q_daily_sales(spark, sf):
    return curate.daily_sales(_domain(spark, sf).sales)


def q_daily_logistics(spark, sf):
    return curate.daily_logistics(_domain(spark, sf).logistics)


def q_curated_join_catalog(spark, sf):
    d = _domain(spark, sf)
    return curate.join_catalog(curate.daily_sales(d.sales), curate.catalog(d.production))


def q_curated_join_inventory(spark, sf):
    return curate.join_inventory(q_curated_join_catalog(spark, sf), _domain(spark, sf).inventory)


def q_curated_join_factory(spark, sf):
    return curate.join_factory(q_curated_join_inventory(spark, sf), _domain(spark, sf).factory)


def q_curated_join_logistics(spark, sf):
    d = _domain(spark, sf)
    return curate.join_logistics(q_curated_join_factory(spark, sf), curate.daily_logistics(d.logistics))


def q_curated_sales(spark, sf):
    return _curated(spark, sf)


# ------------------------------------------------------------ forecasting
def q_product_store_daily(spark, sf):
    """E3 + G1: sorted by product, store, date at output (series x days rows; a range-partitioned sort)."""
    return forecast.product_store_daily(_curated(spark, sf)).orderBy("product_id", "store_id", "date")


def q_history_length(spark, sf):
    return forecast.history_length(forecast.product_store_daily(_curated(spark, sf)))


def q_series_scalars(spark, sf):
    return forecast.series_scalars(forecast.product_store_daily(_curated(spark, sf)))


def q_baseline_mean(spark, sf):
    return forecast.baseline_mean(forecast.product_store_daily(_curated(spark, sf)))


def q_future_dates(spark, sf):
    s = forecast.series_scalars(forecast.product_store_daily(_curated(spark, sf)))
    return forecast.future_dates(s, 30)


def q_incremental_dates(spark, sf):
    cur = _curated(spark, sf)
    s = forecast.series_scalars(forecast.product_store_daily(cur))
    return forecast.remaining_dates(forecast.future_dates(s, 30), _done(cur))


def q_model_choice(spark, sf):
    s = forecast.series_scalars(forecast.product_store_daily(_curated(spark, sf)))
    return forecast.model_choice(s, CHOICE)


def q_baseline_forecast(spark, sf):
    return _forecast(spark, sf).select("product_id", "store_id", "forecast_date", "forecasted_sales")


def q_forecast_rows(spark, sf):
    cur = _curated(spark, sf)
    return _forecast(spark, sf, BASELINE, _done(cur), cur)


def q_holt_winters(spark, sf):
    return _forecast(spark, sf, ETS)


def q_holt_winters_fixed(spark, sf):
    """K2 under fixed parameters: daily histories (with a weekly season) and yearly ones (trend only)."""
    daily = forecast.product_store_daily(_curated(spark, sf)).select("product_id", "store_id", "date", "units_sold")
    yearly = daily.groupBy("product_id", "store_id", F.trunc("date", "year").alias("date")).agg(F.sum("units_sold").alias("units_sold"))
    both = daily.select(F.lit("daily").alias("kind"), "*").unionByName(yearly.select(F.lit("yearly").alias("kind"), "*"))
    history = F.transform(F.array_sort(F.collect_list(F.struct("date", F.col("units_sold").cast("double").alias("y")))), lambda x: x["y"])
    rows = both.groupBy("kind", "product_id", "store_id").agg(history.alias("history")).withColumn("use", F.lit(True))
    states = holt_winters.attach_state(rows, "use", partial(holt_winters.smooth_series, alpha=0.3, beta=0.05, gamma=0.1))
    step = F.explode(F.sequence(F.lit(1), F.lit(10))).alias("step")
    return states.select("kind", "product_id", "store_id", F.size("history").alias("n_values"), "model_state", step) \
        .select("kind", "product_id", "store_id", "n_values", "step", F.round(holt_winters.forecast_expr(F.col("step")), 6).alias("forecast"))


def q_forecast_stocked(spark, sf):
    """E6/J7/J8 where every branch occurs: large stock (waste), small capacity (a binding cap), distant expiry (no risk)."""
    daily = forecast.product_store_daily(_curated(spark, sf)).withColumns({
        "available_stock": F.when(F.col("product_id") <= 2, F.col("available_stock") + 5000).otherwise(F.col("available_stock")),
        "max_capacity_per_day_liters": F.when(F.col("product_id") == 3, F.lit(0)).when(F.col("product_id") == 4, (F.col("units_sold") == 1).cast("bigint"))
        .otherwise(F.col("max_capacity_per_day_liters")),
        "days_to_expiration": F.when(F.col("product_id") >= 4, F.col("days_to_expiration") + 4).otherwise(F.col("days_to_expiration"))})
    return forecast.forecast_from_daily(daily, None, BASELINE)


def q_product_map_competing(spark, sf):
    """E7/T14 with several types for one product: the grades of its batches."""
    made = _domain(spark, sf).production.select("product_id", F.col("grade").alias("product_type"))
    return reports.product_map(made)


def q_daily_absent_inputs(spark, sf):
    """The daily series of a curated table without energy, transport and capacity columns."""
    cur = _curated(spark, sf).drop("energy_consumption_kwh", "transport_time_hours", "max_capacity_per_day_liters")
    return forecast.product_store_daily(cur)


def q_quality_csv(spark, sf):
    """A2: quality rows written as CSV under the known misspelt header, read back and cleaned."""
    path = scratch_path(spark, "quality-csv")
    q = _domain(spark, sf).quality
    named = {"ph": "pH", "temperature": "Temprature", "taste": "Taste", "odor": "Odor", "fat": "Fat ", "turbidity": "Turbidity",
             "colour": "Colour", "grade": "Grade"}
    q.select("batch_id", *(F.col(c).alias(n.strip()) for c, n in named.items())).write.option("header", True) \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return tables.clean_quality(tables.load_quality_csv(spark, path))


def q_curated_by_month(spark, sf):
    """Curated sales written by month and read back between two days (whole folders pruned)."""
    path = scratch_path(spark, "curated-by-month")
    tables.write_curated_sales(_curated(spark, sf), path)
    return tables.read_curated(spark, path, dt.date(1995, 3, 10), dt.date(1996, 2, 5))


def q_non_iso_samples(spark, sf):
    """The first few raw date texts that are no ISO days (the sample size is the feature)."""
    return quality.non_iso_samples(raw_sales_text(spark, sf), "sale_date", SAMPLE_ROWS)


def q_key_range(spark, sf):
    """The batches whose ids lie between two marks."""
    return incremental.rows_between(_domain(spark, sf).production, "batch_id", 1000, 9000)


def q_curated_zero_stock(spark, sf):
    """The curated table where a batch without an inventory row counts as empty."""
    d = _domain(spark, sf)
    cur = curate.curated_sales(d.production, d.inventory, d.sales, d.factory, d.logistics, missing_inventory="zero")
    return cur.select("batch_id", "product_id", "store_id", "date", "units_sold", "initial_stock_liters", "available_stock",
                      "suggested_production", "expiration_risk")


def q_type_histogram_raw(spark, sf):
    """E17 over text columns: nulls, whole numbers, fractions and other text."""
    raw = raw_sales_text(spark, sf)
    return quality.type_histogram({"raw": raw}, {"raw": ["batch_id", "product_id", "sale_date", "units"]})


# ------------------------------------------------------------ reports
def _stored_forecast(spark, sf):
    """The forecast as reports read it: a written table, so that its first day does not run the chain again."""
    path = scratch_path(spark, "forecast")
    tables.write_table(_forecast(spark, sf), path)
    return spark.read.parquet(path)


def q_filtered_view(spark, sf):
    sc = reports.apply_filters(_curated(spark, sf), FILTERED)
    return sc.select("batch_id", "product_id", "store_id", "date", "units_sold", "available_stock")


def q_horizon(spark, sf):
    return reports.forecast_window(_stored_forecast(spark, sf), DASHBOARD_FILTERS)


def _summary(spark, sf):
    return reports.summary_days(_curated(spark, sf), DASHBOARD_FILTERS, BASELINE)


def q_kpi_overview(spark, sf):
    return reports.summary_kpis(_summary(spark, sf), DASHBOARD_FILTERS.horizon_days)


def q_forecast_daily(spark, sf):
    return reports.summary_demand(_summary(spark, sf), DASHBOARD_FILTERS.horizon_days)


def q_asof_stock(spark, sf):
    return reports.asof_stock(reports.apply_filters(_curated(spark, sf), DASHBOARD_FILTERS))


def q_projected_stock(spark, sf):
    return reports.summary_stock(_summary(spark, sf), DASHBOARD_FILTERS.horizon_days)


def q_batch_drilldown(spark, sf):
    return reports.batch_drilldown(_curated(spark, sf))


def q_risk_pairs(spark, sf):
    return reports.risk_pairs(_curated(spark, sf))


def q_product_map(spark, sf):
    return reports.product_map(curate.catalog(_domain(spark, sf).production))


def q_product_labels(spark, sf):
    return reports.product_labels(q_product_map(spark, sf))


def q_natural_sort(spark, sf):
    return reports.store_order(_curated(spark, sf))


def q_filter_options(spark, sf):
    stores = reports.store_order(_curated(spark, sf)).select(F.lit("store").alias("kind"),
                                                             F.col("store_id").alias("value"))
    products = reports.product_options(q_product_map(spark, sf)).select(
        F.lit("product").alias("kind"), F.col("product_id").cast("string").alias("value"))
    return stores.unionByName(products)


def q_risk_heatmap(spark, sf):
    d = _domain(spark, sf)
    cur = curate.curated_from(d)
    return reports.risk_heatmap(cur, reports.product_map(curate.catalog(d.production)))


def q_production_plan(spark, sf):
    return reports.production_plan(q_horizon(spark, sf), reports.product_map(curate.catalog(_domain(spark, sf).production)))


def q_kpi_sustainability(spark, sf):
    return reports.kpi_sustainability(_curated(spark, sf))


def q_table_sample(spark, sf):
    """The first rows of the sales table in key order (the sample size is the feature)."""
    return _domain(spark, sf).sales.orderBy(*schemas.PRIMARY_KEYS["sales"], "units_sold", "promotion_flag",
                                            "seasonality_factor").limit(SAMPLE_ROWS)


def q_seeded_sample(spark, sf):
    """Deterministic seeded sample of 100 quality rows (order of a digest of key and seed)."""
    q = _domain(spark, sf).quality
    return q.orderBy(F.md5(F.concat_ws("-", "batch_id", F.lit("42"))), "batch_id").limit(100)


# ------------------------------------------------------------ quality
def _ops(spark, sf, stored=False) -> dict[str, DataFrame]:
    """The operational tables for the profiling checks, lazily: each check prunes them to its columns.
    A report that looks at the forecast several times has it ``stored``."""
    rows = _stored_forecast(spark, sf) if stored else _forecast(spark, sf)
    return {**{k: v for k, v in _domain(spark, sf).whole().items() if k != "product_catalog"}, "forecast": rows}


def q_row_counts(spark, sf):
    return quality.row_counts(_ops(spark, sf))


def q_type_histogram(spark, sf):
    return quality.type_histogram(_ops(spark, sf))


def q_date_ranges(spark, sf):
    return quality.date_ranges(_ops(spark, sf))


def q_non_iso_dates(spark, sf):
    t = _ops(spark, sf)
    raw = raw_sales_text(spark, sf).select("sale_date")
    return quality.non_iso_dates({**t, "raw_sales_text": raw}, {**schemas.DATE_COLUMNS, "raw_sales_text": "sale_date"})


def q_pk_duplicates(spark, sf):
    return quality.pk_duplicates(_ops(spark, sf))


def q_join_health(spark, sf):
    d = _domain(spark, sf)
    return quality.join_health(d.inventory, d.sales, d.factory, d.logistics)


def q_orphan_checks(spark, sf):
    d = _domain(spark, sf)
    return quality.orphan_checks(d.inventory, d.sales, d.factory, d.logistics)


def q_constraint_checks(spark, sf):
    d = _domain(spark, sf)
    return quality.constraint_checks(d.quality, d.production)


def q_quality_report(spark, sf):
    return quality.quality_report(_ops(spark, sf, stored=True), related=_domain(spark, sf).as_dict())


def q_stored_statistics(spark, sf):
    """The operational tables written, then asked for rows, days and last ids, which their footers answer."""
    found = {}
    for name, df in _domain(spark, sf).whole().items():
        path = scratch_path(spark, f"stored-{name}")
        tables.write_table(df, path)
        found[name] = tables.stored_scan(spark, path)
    return quality.stored_statistics(found)


def q_inspection_samples(spark, sf):
    """Head rows, odd dates and duplicated keys of the operational tables (the sample size is the feature)."""
    raw = raw_sales_text(spark, sf).select(F.col("l_orderkey").alias("batch_id"), "sale_date", "units")
    ops = {k: v for k, v in _domain(spark, sf).whole().items() if k != "product_catalog"}
    return quality.inspection_samples(ops, SAMPLE_ROWS).unionByName(
        quality.inspection_samples({"sales": raw}, SAMPLE_ROWS).withColumn("table_name", F.lit("raw_sales_text")))


# ------------------------------------------------------------ streaming
def q_stream_daily_sales(spark, sf):
    """M1: line items arrive in two loads, each read as a file stream, joined to the static orders and aggregated
    into the groups of the load before (the second load holds late rows of every day)."""
    items, orders = _read(spark, sf, "lineitem"), _read(spark, sf, "orders")
    arrived, state, out = (scratch_path(spark, f"daily-sales-{n}") for n in ("arrived", "state", "sink"))
    for load in (F.col("l_linenumber") % 2 == 0, F.col("l_linenumber") % 2 == 1):
        items.filter(load).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(items.schema).parquet(arrived)
        sink = incremental_sales.run_daily_sales_stream(spark, domain_views.sales(stream, orders), out, state)
    return sink.read()


def q_stream_late_orders(spark, sf):
    """M1 where both sides are streams: lines are recorded 1-7 days after their order's day, every ninth order ten days after it,
    so that orders follow their lines, also into the next load; the sales that the streams' join resolves, aggregated by day.
    Only what sales are made of arrives and is kept in the streams' state."""
    items, orders = (domain_views.sales_columns(_read(spark, sf, name)) for name in ("lineitem", "orders"))
    late = F.when(F.col("o_orderkey") % 9 == 0, 10).otherwise(0)
    noted = orders.withColumn("recorded", F.col("o_orderdate") + F.make_dt_interval(late))
    day = orders.select("o_orderkey", "o_orderdate")
    sold = items.join(day, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey") \
        .withColumn("recorded", F.col("o_orderdate") + F.make_dt_interval("l_linenumber")).drop("o_orderdate")
    at = {n: scratch_path(spark, f"late-orders-{n}") for n in ("lines", "orders", "state", "sink")}
    for start, end in zip((None, *JOIN_LOADS), (*JOIN_LOADS, None)):
        load = F.lit(True) if start is None else F.col("recorded") >= F.lit(start)
        load = load if end is None else load & (F.col("recorded") < F.lit(end))
        sold.filter(load).write.mode("append").parquet(at["lines"])
        noted.filter(load).write.mode("append").parquet(at["orders"])
        late_orders.run_sales_join(spark, spark.readStream.schema(sold.schema).parquet(at["lines"]),
                                   spark.readStream.schema(noted.schema).parquet(at["orders"]), at["sink"], at["state"])
    return curate.daily_sales(domain_views.sales_of(spark.read.parquet(at["sink"])))


def q_stream_forecast(spark, sf):
    """M2: the daily series arrive in three loads; after each, the touched series are forecast from their kept state."""
    arrived, state, out = (scratch_path(spark, f"forecast-stream-{n}") for n in ("arrived", "state", "sink"))
    path = scratch_path(spark, "forecast-stream-daily")
    forecast.product_store_daily(_curated(spark, sf)).write.parquet(path)
    daily = spark.read.parquet(path)
    day = F.col("date")
    for load in (day < LOAD_STARTS[0], (day >= LOAD_STARTS[0]) & (day < LOAD_STARTS[1]), day >= LOAD_STARTS[1]):
        daily.filter(load).write.mode("append").parquet(arrived)
        sink = forecast_stream.run_forecast_stream(spark, spark.readStream.schema(daily.schema).parquet(arrived), out, state, settings=ETS)
    kept = sink.read()
    return kept.select(*(F.round(c, 6).alias(c) if kind == "double" else F.col(c) for c, kind in kept.dtypes))


QUERIES: dict[str, Query] = {
    # sources, sinks, table maintenance
    "scan_sales": q_scan_sales,
    "stored_legacy_sales": q_stored_legacy_sales,
    "stored_legacy_logistics": q_stored_legacy_logistics,
    "quality_clean": q_quality_clean,
    "forecast_json_roundtrip": q_forecast_json_roundtrip,
    "forecast_export": q_forecast_export,
    "forecast_upsert": q_forecast_upsert,
    "append_union": q_append_union,
    "new_batches": q_new_batches,
    "last_date": q_last_date,
    "ensure_dimension": q_ensure_dimension,
    "assign_ids": q_assign_ids,
    "forecast_fallback": q_forecast_fallback,
    # projections, coercions, scalar functions
    "normalize_names": q_normalize_names,
    "alias_columns": q_alias_columns,
    "default_columns": q_default_columns,
    "coerce_ids": q_coerce_ids,
    "bytes_to_int": q_bytes_to_int,
    "parse_dates": q_parse_dates,
    "parse_numbers": q_parse_numbers,
    "units_int": q_units_int,
    "clip_range": q_clip_range,
    "shelf_life": q_shelf_life,
    "weekday_factor": q_weekday_factor,
    "expiry_date": q_expiry_date,
    "product_labels": q_product_labels,
    "natural_sort": q_natural_sort,
    # filters
    "drop_nulls": q_drop_nulls,
    "catalog": q_catalog,
    "filtered_view": q_filtered_view,
    "horizon": q_horizon,
    "incremental_dates": q_incremental_dates,
    "non_iso_dates": q_non_iso_dates,
    # joins
    "curated_join_catalog": q_curated_join_catalog,
    "curated_join_inventory": q_curated_join_inventory,
    "curated_join_factory": q_curated_join_factory,
    "curated_join_logistics": q_curated_join_logistics,
    "join_health": q_join_health,
    "orphan_checks": q_orphan_checks,
    "produced_quantity": q_produced_quantity,
    "batch_stock": q_batch_stock,
    # aggregations
    "daily_sales": q_daily_sales,
    "daily_sales_null_store": q_daily_sales_null_store,
    "daily_logistics": q_daily_logistics,
    "product_store_daily": q_product_store_daily,
    "history_length": q_history_length,
    "series_scalars": q_series_scalars,
    "product_map": q_product_map,
    "kpi_overview": q_kpi_overview,
    "forecast_daily": q_forecast_daily,
    "risk_pairs": q_risk_pairs,
    "kpi_sustainability": q_kpi_sustainability,
    "filter_options": q_filter_options,
    "row_counts": q_row_counts,
    "type_histogram": q_type_histogram,
    "date_ranges": q_date_ranges,
    "pk_duplicates": q_pk_duplicates,
    # windows
    "baseline_mean": q_baseline_mean,
    "projected_stock": q_projected_stock,
    "asof_stock": q_asof_stock,
    # sort / limit / sample
    "production_plan": q_production_plan,
    "table_sample": q_table_sample,
    "seeded_sample": q_seeded_sample,
    # reshaping
    "risk_heatmap": q_risk_heatmap,
    "future_dates": q_future_dates,
    # business derivations
    "curated_sales": q_curated_sales,
    "batch_drilldown": q_batch_drilldown,
    # forecasting
    "baseline_forecast": q_baseline_forecast,
    "holt_winters": q_holt_winters,
    "holt_winters_fixed": q_holt_winters_fixed,
    "forecast_stocked": q_forecast_stocked,
    "daily_absent_inputs": q_daily_absent_inputs,
    "product_map_competing": q_product_map_competing,
    "quality_csv": q_quality_csv,
    "curated_by_month": q_curated_by_month,
    "non_iso_samples": q_non_iso_samples,
    "key_range": q_key_range,
    "curated_zero_stock": q_curated_zero_stock,
    "type_histogram_raw": q_type_histogram_raw,
    "model_choice": q_model_choice,
    "forecast_rows": q_forecast_rows,
    # streaming
    "stream_daily_sales": q_stream_daily_sales,
    "stream_late_orders": q_stream_late_orders,
    "stream_forecast": q_stream_forecast,
    # data quality
    "constraint_checks": q_constraint_checks,
    "quality_report": q_quality_report,
    "stored_statistics": q_stored_statistics,
    "inspection_samples": q_inspection_samples,
    "rejected_dates": q_rejected_dates,
    "forecast_month_upsert": q_forecast_month_upsert,
    "forecast_migration": q_forecast_migration,
    "forecast_compact": q_forecast_compact,
    "curated_bucketed": q_curated_bucketed,
}
