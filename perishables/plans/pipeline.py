"""End-to-end runs: ETL -> curated tables -> incremental forecast -> JSON export.

Stages write their results as tables (parquet) under an output root and the
next stage reads them back: this cuts lineage at the stage boundary, survives
lost executors without recomputing the whole chain, and lets several reports
share one curated scan.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.operators import curate, forecast
from perishables.settings import ForecastSettings
from perishables.sources import forecast_store, tables


@dataclass(frozen=True)
class PipelinePaths:
    root: str

    @property
    def catalog(self) -> str:
        return f"{self.root}/catalog_curated"

    @property
    def curated(self) -> str:
        return f"{self.root}/sales_curated"

    @property
    def forecast(self) -> str:
        return f"{self.root}/forecast"

    @property
    def export(self) -> str:
        return f"{self.root}/dashboard_output"


def run_etl(domain, paths: PipelinePaths) -> tuple[DataFrame, DataFrame]:
    """Stages 2-8: catalog and curated sales written, then read back from the written tables."""
    spark = domain.production.sparkSession
    tables.write_table(curate.catalog(domain.production), paths.catalog)
    tables.write_curated_sales(curate.curated_from(domain), paths.curated)
    return spark.read.parquet(paths.catalog), tables.read_curated(spark, paths.curated)


def run_forecast(spark: SparkSession, curated: DataFrame, paths: PipelinePaths,
                 settings: ForecastSettings = ForecastSettings()) -> DataFrame:
    """Stage 9: forecast dates not yet in the store and upsert them; returns the new rows (as written)."""
    store = forecast_store.ForecastStore(spark, paths.forecast)
    existing = store.read()
    new_rows = forecast.forecast_rows(curated, existing, settings)
    staged = f"{paths.root}/forecast_new_{len(store.versions()) + 1:06d}"
    new_rows.write.mode("overwrite").parquet(staged)
    new_rows = spark.read.parquet(staged)
    store.upsert(new_rows)
    return new_rows


def run_pipeline(spark: SparkSession, domain, root: str, settings: ForecastSettings = ForecastSettings(),
                 as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """Stages 1-11; the fallback window is used when the run added no forecast rows."""
    paths = PipelinePaths(root.rstrip("/"))
    catalog, curated = run_etl(domain, paths)
    new_rows = run_forecast(spark, curated, paths, settings)
    shown = new_rows
    if new_rows.isEmpty():
        stored = forecast_store.ForecastStore(spark, paths.forecast).read()
        shown = forecast_store.fallback_window(stored, settings.horizon_days, as_of or dt.date.today())
    forecast_store.write_json(shown, paths.export)
    return {"catalog": catalog, "curated": curated, "forecast": shown.withColumn(
        "forecast_date", F.col("forecast_date").cast("date"))}
