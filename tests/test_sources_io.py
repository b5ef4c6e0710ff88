"""Typed scans (A1), quality CSV (A2), required-column guard (B3), compact step mode."""
from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from perishables import schemas
from perishables.functions import coerce
from perishables.operators import forecast
from perishables.session import scratch_path
from perishables.settings import ForecastSettings
from perishables.sources import tables
from perishables.sources.domain_views import load_domain
from tests.conftest import SF_SMALL


def test_load_table_normalises_and_conforms(spark):
    path = scratch_path(spark, "raw-sales")
    d = load_domain(spark, SF_SMALL)
    # stored the way a legacy writer would: mixed-case names with spaces, ids and dates as text
    d.sales.select(F.col("batch_id").cast("string").alias("Batch ID"), F.col("product_id").alias("Product_ID"),
                   F.col("store_id").alias("Store_ID"), F.col("sale_date").cast("string").alias("Sale_Date"),
                   F.col("units_sold").cast("double").alias("Units_Sold")).write.parquet(path)
    out = tables.load_table(spark, path, "sales")
    assert out.schema == schemas.SALES
    # absent optional columns get their defaults
    assert out.exceptAll(d.sales.withColumns({"sale_hour": F.lit(12), "promotion_flag": F.lit(0),
                                              "seasonality_factor": F.lit(1.0)})).count() == 0
    empty = tables.load_table(spark, scratch_path(spark, "missing"), "inventory", optional=True)
    assert empty.count() == 0 and empty.schema == schemas.INVENTORY


def test_quality_csv_header_typo_and_required_columns(spark, tmp_path):
    good = tmp_path / "q.csv"
    good.write_text("pH,Temprature,Taste,Odor,Fat,Turbidity,Colour,Grade\n6.6,35,1,0,1,0,254,high\n"
                    "6.8,abc,2,1,1,1,300, Medium\n")
    q = tables.load_quality_csv(spark, str(good))
    assert q.schema == schemas.QUALITY
    clean = tables.clean_quality(q).collect()
    assert len(clean) == 1 and clean[0].grade == "high" and clean[0].temperature == 35.0
    bad = tmp_path / "bad.csv"
    bad.write_text("pH,Taste\n6.6,1\n")
    with pytest.raises(ValueError):
        tables.load_quality_csv(spark, str(bad))
    assert os.path.exists(good)


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "batch_id long, product_id long")
    assert coerce.require_columns(df, ["batch_id"]) is df
    assert coerce.require_columns(df, ["store_id"], on_missing="empty") is None
    with pytest.raises(ValueError):
        coerce.require_columns(df, ["store_id"])


def test_compact_step_mode_matches_reference_phasing(spark):
    start = dt.date(2025, 1, 1)
    rows = [(1, "S1", start + dt.timedelta(d), 10 + (d % 7) * 3, 5, 10, 80.0, 1.0, 3.0, 9) for d in range(40)]
    daily = spark.createDataFrame(rows, "product_id long, store_id string, date date, units_sold long, "
                                        "available_stock long, max_capacity_per_day_liters long, "
                                        "energy_consumption_kwh double, transport_time_hours double, "
                                        "transport_temperature_c double, days_to_expiration int")
    cal = ForecastSettings(model="ets", min_history_days=14, horizon_days=10, step_mode="calendar")
    cmp_ = ForecastSettings(model="ets", min_history_days=14, horizon_days=10, step_mode="compact")
    full = forecast.forecast_from_daily(daily, None, cal)
    done = full.orderBy("forecast_date").limit(4)
    a = {r.forecast_date: r.forecasted_sales for r in forecast.forecast_from_daily(daily, done, cal).collect()}
    b = {r.forecast_date: r.forecasted_sales for r in forecast.forecast_from_daily(daily, done, cmp_).collect()}
    f = {r.forecast_date: r.forecasted_sales for r in full.collect()}
    assert sorted(a) == sorted(b) and len(a) == 6
    assert all(a[d] == f[d] for d in a)          # calendar: same step as a fresh run
    first_left = min(b)
    assert b[first_left] == f[min(f)]            # compact: remaining dates restart at step 1


def test_cli_pipeline_over_stored_tables(spark):
    from perishables.plans import cli
    root = scratch_path(spark, "operational")
    d = load_domain(spark, SF_SMALL)
    for name, df in d.as_dict().items():
        df.write.parquet(f"{root}/{name}")
    out = scratch_path(spark, "cli-out")
    assert cli.main(["pipeline", "--tables", root, "--out", out, "--model", "baseline", "--horizon", "3"]) == 0
    assert spark.read.json(f"{out}/dashboard_output").count() > 0
    assert cli.main(["inspect", "--tables", root, "--show", "5"]) == 0


def test_scale_conf_from_input(spark):
    from perishables.session import input_bytes, scale_conf
    assert input_bytes(spark, SF_SMALL) > 0
    conf = scale_conf(100 * 2**40, 8000)
    assert conf["spark.sql.shuffle.partitions"] == str(100 * 2**40 // (256 * 2**20))
    assert scale_conf(10, 8)["spark.sql.shuffle.partitions"] == "24"
