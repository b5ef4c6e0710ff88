"""Stored tables: footers instead of scans, month folders, legacy schemas, buckets, samples and rejected values."""
from __future__ import annotations

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

from perishables import schemas
from perishables.functions import coerce
from perishables.operators import curate, forecast, quality
from perishables.plans.registered import QUERIES
from perishables.session import scratch_path
from perishables.sources import forecast_months, tables
from tests.conftest import SF_SMALL
from tests.test_plans import _exchanges, _final_plan

DAY = dt.date(2025, 1, 30)


def test_counts_and_ranges_come_from_footers(spark):
    path = scratch_path(spark, "test-stored")
    spark.range(100).select(F.col("id").alias("batch_id"), F.date_add(F.lit(DAY), F.col("id").cast("int")).alias("sale_date"), F.lit("x").alias("text")) \
        .repartition(3).write.parquet(path)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    old = spark.conf.get("spark.sql.parquet.aggregatePushdown")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    found = quality.stored_statistics({"sales": tables.stored_scan(spark, path)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), MIN\(sale_date\), MAX\(sale_date\), MAX\(batch_id\)\]", plan)
    assert tuple(found.first()) == ("sales", 100, DAY, DAY + dt.timedelta(99), 99)
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before
    # other tables: no date column, no key
    other = quality.stored_statistics({"product_catalog": tables.stored_scan(spark, path).select("text")})
    assert tuple(other.first()) == ("product_catalog", 100, None, None, None)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", old)


def rows(spark, *keys, value=1.0):
    return spark.createDataFrame([(p, s, d, value, 0.0, 0.0, 0, 1.0) for p, s, d in keys], schemas.FORECAST)


def files(path):
    path = path.removeprefix("file:")
    return {d: sorted(f for f in os.listdir(f"{path}/{d}") if f.startswith("part")) for d in os.listdir(path) if d.startswith("month")}


def test_an_upsert_leaves_other_months_alone(spark):
    path = scratch_path(spark, "test-months")
    days = [DAY + dt.timedelta(n) for n in range(0, 90, 5)]
    assert forecast_months.read_months(spark, path).count() == 0
    assert forecast_months.upsert_months(spark, path, rows(spark)) == []
    forecast_months.upsert_months(spark, path, rows(spark, *[(1, "S1", d) for d in days], (1, "S1", None)))
    before = files(path)
    touched = forecast_months.upsert_months(spark, path, rows(spark, (1, "S1", dt.date(2025, 2, 4)), (2, "S1", dt.date(2025, 2, 5)), (None, None, dt.date(2025, 2, 6)), value=9.0))
    after = files(path)
    assert touched == ["2025-02"] and before.keys() == after.keys()
    assert {m for m in before if before[m] != after[m]} == {"month=2025-02"}
    got = {(r["product_id"], r["store_id"], r["forecast_date"]): r["forecasted_sales"] for r in forecast_months.read_months(spark, path).collect()}
    assert len(got) == len(days) + 2 and got[(1, "S1", dt.date(2025, 2, 4))] == 9.0 and got[(1, "S1", days[0])] == 1.0
    # the same upsert again changes nothing but the files of its month
    forecast_months.upsert_months(spark, path, rows(spark, (2, "S1", dt.date(2025, 2, 5)), (2, "S1", dt.date(2025, 2, 5)), value=9.0))
    assert forecast_months.read_months(spark, path).count() == len(got)


@pytest.mark.parametrize("old, recreated", [
    ({"batch_id": "bigint", "forecast_date": "date"}, True), ({"Batch_ID": "bigint", "product_id": "bigint", "store_id": "string", "forecast_date": "date", "month": "string"}, True),
    ({"product_id": "bigint", "store_id": "string", "forecast_date": "date"}, True),
    ({"product_id": "bigint", "store_id": "string", "forecast_date": "date", "month": "string"}, False)])
def test_a_legacy_table_makes_way(spark, old, recreated):
    path = scratch_path(spark, "test-legacy")
    values = {"bigint": F.lit(7).cast("bigint"), "string": F.lit("2025-01"), "date": F.lit(DAY)}
    table = spark.range(1).select(*(values[kind].alias(name) for name, kind in old.items()))
    (table.write.partitionBy("month") if "month" in old else table.write).parquet(path)
    columns = forecast_months.stored_columns(spark, path)
    assert forecast_months.needs_recreation(columns) == recreated
    forecast_months.upsert_months(spark, path, rows(spark, (1, "S1", DAY)))
    got = forecast_months.read_months(spark, path)
    assert got.count() == (1 if recreated else 2) and got.columns == [f.name for f in schemas.FORECAST.fields]


def test_bucketed_inputs_join_without_exchanges(spark):
    plan = _final_plan(spark, "curated_bucketed")
    assert _exchanges(plan) == 0 and "BroadcastExchange" not in plan and "SortMergeJoin" in plan


def test_reports_evaluate_the_chain_once(spark):
    one = _final_plan(spark, "forecast_rows")   # it reads the history twice: what is done is given by the history
    scans = {n: len(re.findall(r"FileScan parquet", _final_plan(spark, n))) for n in ("kpi_overview", "projected_stock", "forecast_daily", "baseline_forecast")}
    assert len(set(scans.values())) == 1 and scans["kpi_overview"] <= len(re.findall(r"FileScan parquet", one))
    assert _exchanges(_final_plan(spark, "kpi_overview")) <= 14
    tail = _final_plan(spark, "baseline_mean")
    assert tail.count("WindowGroupLimit") == 2 and "row_number" in tail


def test_the_tail_is_bounded_and_right(spark):
    days = [(p, "S1", DAY + dt.timedelta(n * p), n) for p in (1, 2) for n in range(40)] + [(3, "S1", DAY, 5), (4, "S1", DAY, -5)]
    daily = spark.createDataFrame(days, "product_id long, store_id string, date date, units_sold long")
    got = {r["product_id"]: r["baseline"] for r in forecast.baseline_mean(daily).collect()}
    assert got == {1: 36.0, 2: 36.0, 3: 5.0, 4: 0.0}
    assert forecast.last_days(daily, 3).count() == 3 + 3 + 1 + 1 and forecast.baseline_mean(daily.limit(0)).count() == 0


def test_samples_of_the_report(spark):
    sales = spark.createDataFrame([(1, 1, "S1", "2025-01-0%d" % (i % 3), 8, i) for i in range(9)] + [(None, 2, None, "x", 9, 9), (2, 1, "S1", None, 8, 1)],
                                  "batch_id long, product_id long, store_id string, sale_date string, sale_hour int, units_sold long")
    got = quality.inspection_samples({"sales": sales, "product_catalog": sales.select("product_id").limit(0)}, 2).collect()
    assert [(r["check_name"], r["item"], r["value"]) for r in got if r["table_name"] == "sales"] == [
        ("head_row", "1", "<null>|2|<null>|x|9|9"), ("head_row", "2", "1|1|S1|2025-01-00|8|0"), ("non_iso_sample", "1", "x"),
        ("duplicate_key", "1", "1|1|S1|2025-01-00|8 x 3"), ("duplicate_key", "2", "1|1|S1|2025-01-01|8 x 3")]
    assert [r for r in got if r["table_name"] != "sales"] == []
    checks = {r["check_name"] for r in quality.quality_report({"sales": sales}, samples=2).collect()}
    assert {"head_row", "non_iso_sample", "duplicate_key", "row_count"} <= checks
    assert not {"head_row"} & {r["check_name"] for r in quality.quality_report({"sales": sales}).collect()}


def test_dates_with_names_and_months_first(spark):
    texts = {"Jan 3 2025": dt.date(2025, 1, 3), "january 13, 2025": dt.date(2025, 1, 13), "03-01-2025": dt.date(2025, 3, 1), "3/1/2025": dt.date(2025, 3, 1),
             "13-01-2025": None, "Foo 3 2025": None, "Feb 30 2025": None, "2025-01-03": dt.date(2025, 1, 3), "": None, None: None}
    df = spark.createDataFrame([(t,) for t in texts], "sale_date string")
    got = {r["sale_date"]: r["d"] for r in df.select("sale_date", coerce.date_expr(F.col("sale_date"), df.schema["sale_date"].dataType).alias("d")).collect()}
    assert got == texts
    assert tuple(quality.rejected_dates({"sales": df, "quality": df}).collect()[0]) == ("sales", "sale_date", 9, 4)


def test_missing_columns_can_make_the_result_empty(spark):
    sales = spark.createDataFrame([(1, 2, dt.date(2025, 1, 1), 3)], "batch_id long, product_id long, ds date, y long")
    with pytest.raises(ValueError):
        curate.map_sales(sales)
    got = curate.map_sales(sales, on_missing="empty")
    assert got.count() == 0 and {"batch_id", "product_id", "store_id", "date", "units_sold", "sale_hour"} <= set(got.columns)


def test_new_queries_are_registered():
    assert {"stored_statistics", "inspection_samples", "forecast_month_upsert", "forecast_migration", "forecast_compact", "curated_bucketed",
            "stream_forecast", "stream_late_orders", "rejected_dates"} <= set(QUERIES) and SF_SMALL
