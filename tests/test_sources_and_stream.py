"""Forecast store, JSON round trip, incremental helpers, streaming equals batch."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from perishables import schemas
from perishables.operators import curate, reports
from perishables.plans.registered import QUERIES
from perishables.session import scratch_path
from perishables.sources import forecast_store, incremental
from tests.conftest import SF_SMALL


def _fc(spark, day, value):
    return spark.createDataFrame([(1, "S1", day, value, 0.0, 0.0, 0, 1.0)], schemas.FORECAST)


def test_forecast_store_versions_and_legacy(spark):
    root = scratch_path(spark, "store-test")
    store = forecast_store.ForecastStore(spark, root)
    assert store.read().count() == 0
    d = dt.date(2025, 1, 1)
    assert store.upsert(_fc(spark, d, 1.0)) == 1
    assert store.upsert(_fc(spark, d, 2.0).unionByName(_fc(spark, d + dt.timedelta(1), 3.0))) == 2
    got = sorted((r.forecast_date, r.forecasted_sales) for r in store.read().collect())
    assert got == [(d, 2.0), (d + dt.timedelta(1), 3.0)]
    legacy = forecast_store.ForecastStore(spark, scratch_path(spark, "legacy"))
    spark.createDataFrame([(1, 1, "S1")], "batch_id long, product_id long, store_id string") \
        .write.parquet(f"{legacy.root}/version=000001")
    assert legacy.read().count() == 0


def test_json_roundtrip_and_bad_dates(spark):
    path = scratch_path(spark, "json-test")
    rows = _fc(spark, dt.date(2025, 3, 1), 4.5)
    forecast_store.write_json(rows, path)
    back = forecast_store.read_json(spark, path).collect()
    assert len(back) == 1 and back[0].forecast_date == dt.date(2025, 3, 1) and back[0].forecasted_sales == 4.5
    bad = scratch_path(spark, "json-bad")
    spark.createDataFrame([("x",), ("2025-02-01",)], "forecast_date string").write.json(bad)
    assert [r.forecast_date for r in forecast_store.read_json(spark, bad).collect()] == [dt.date(2025, 2, 1)]


def test_fallback_window(spark):
    base = dt.date(2025, 1, 1)
    stored = spark.createDataFrame([(1, "S1", base + dt.timedelta(i), 1.0, 0.0, 0.0, 0, 1.0) for i in range(10)],
                                   schemas.FORECAST)
    fut = forecast_store.fallback_window(stored, 3, base + dt.timedelta(4)).collect()
    assert sorted(r.forecast_date for r in fut) == [base + dt.timedelta(i) for i in (4, 5, 6)]
    past = forecast_store.fallback_window(stored, 3, base + dt.timedelta(30)).collect()
    assert sorted(r.forecast_date for r in past) == [base + dt.timedelta(i) for i in (7, 8, 9)]


def test_assign_ids_consecutive(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("k")).repartition(5)
    out = incremental.assign_ids(df, "new_id", ["k"], 100).collect()
    pairs = sorted((r.k, r.new_id) for r in out)
    assert [p[1] for p in pairs] == list(range(101, 1101))


def test_ensure_dimension_and_last_date(spark):
    existing = spark.createDataFrame([(1, "a")], schemas.PRODUCT_CATALOG)
    seed = spark.createDataFrame([(1, "x"), (2, "b")], schemas.PRODUCT_CATALOG)
    got = sorted(tuple(r) for r in incremental.ensure_dimension(existing, seed, ["product_id"]).collect())
    assert got == [(1, "a"), (2, "b")]
    empty = spark.createDataFrame([], schemas.PRODUCTION)
    assert incremental.last_date(empty, "production_date").first()[0] == dt.date(2025, 1, 1)


def test_mode_tie_and_same_name_pivot(spark):
    cat = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "a")], "product_id long, product_type string")
    pmap = reports.product_map(cat)
    assert {r.product_id: r.product_type for r in pmap.collect()} == {1: "a", 2: "a"}
    sc = spark.createDataFrame([(1, "S1", 1), (2, "S2", 5)], "product_id long, store_id string, days_to_expiration int")
    heat = reports.risk_heatmap(sc, pmap).collect()
    assert [(r.product_id, r.product, r.S1, r.S2) for r in heat] == [(1, "A", 2, 0), (2, "A", 0, 0)]


def test_stream_equals_batch(spark):
    streamed = QUERIES["stream_daily_sales"](spark, SF_SMALL)
    batch = QUERIES["daily_sales"](spark, SF_SMALL)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch.select(*streamed.columns)).count() == 0


def test_curated_keeps_left_rows(spark):
    from perishables.sources.domain_views import load_domain
    d = load_domain(spark, SF_SMALL)
    assert curate.curated_from(d).count() == curate.daily_sales(d.sales).count()


def test_pipeline_rerun_adds_nothing_and_falls_back(spark):
    from perishables.plans import pipeline
    from perishables.settings import ForecastSettings
    from perishables.sources.domain_views import load_domain

    root = scratch_path(spark, "pipeline-test")
    settings = ForecastSettings(model="ets", horizon_days=7)
    first = pipeline.run_pipeline(spark, load_domain(spark, SF_SMALL), root, settings)
    n_first = first["forecast"].count()
    assert n_first > 0 and first["curated"].count() == QUERIES["curated_sales"](spark, SF_SMALL).count()
    second = pipeline.run_pipeline(spark, load_domain(spark, SF_SMALL), root, settings,
                                   as_of=dt.date(1990, 1, 1))
    # nothing new: the fallback shows the stored window starting at the first date on/after as_of
    shown = second["forecast"].collect()
    assert 0 < len(shown) <= n_first
    exported = spark.read.json(f"{root}/dashboard_output")
    assert exported.count() == len(shown)


def test_forecast_touched_series(spark):
    from perishables.settings import ForecastSettings
    from perishables.sources.forecast_store import ForecastStore
    from perishables.streaming.incremental_sales import forecast_touched_series

    cur = QUERIES["curated_sales"](spark, SF_SMALL)
    store = ForecastStore(spark, scratch_path(spark, "touched"))
    batch = cur.filter((F.col("product_id") == 1) & (F.col("store_id") == "S1")).limit(1)
    forecast_touched_series(batch, cur, store, ForecastSettings(model="baseline", horizon_days=5))
    got = store.read().select("product_id", "store_id").distinct().collect()
    assert [(r.product_id, r.store_id) for r in got] == [(1, "S1")]
    assert store.read().count() == 5


def test_stream_late_rows_update_old_days(spark):
    """Two micro-batches; the second carries more rows for days the first already aggregated."""
    from perishables.operators.curate import daily_sales
    from perishables.sources import domain_views
    from perishables.streaming.incremental_sales import run_daily_sales_stream

    src = scratch_path(spark, "late-src")
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    li.filter("l_linenumber % 2 = 1").coalesce(1).write.parquet(f"{src}/part=1")
    li.filter("l_linenumber % 2 = 0").coalesce(1).write.parquet(f"{src}/part=2")
    stream = spark.readStream.schema(li.schema).option("maxFilesPerTrigger", 1) \
        .option("recursiveFileLookup", "true").parquet(src)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    epochs = []
    sink = run_daily_sales_stream(spark, domain_views.sales(stream, orders), scratch_path(spark, "late-sink"),
                                  on_batch=lambda b, e: epochs.append(e))
    assert len(epochs) == 2
    batch = daily_sales(domain_views.sales(li, orders))
    got = sink.read()
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
    # a new base replaces the log; a replayed or later epoch still adds to it
    assert len(sink.versions()) == 2
    sink.compact()
    sink.expire()
    assert sink.versions() == [] and sink.read().exceptAll(batch.select(*got.columns)).count() == 0
    one = sink.read().limit(1).cache()
    sink.upsert_batch(one.withColumn("units_sold", F.lit(-5).cast("bigint")), epochs[-1] + 1)
    changed = sink.read()
    assert changed.count() == batch.count() and changed.filter("units_sold = -5").count() == 1


def test_watermarked_stream_equals_batch_when_nothing_is_late(spark):
    from perishables.operators.curate import daily_sales
    from perishables.sources import domain_views
    from perishables.streaming.incremental_sales import run_daily_sales_stream

    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    stream = spark.readStream.schema(li.schema).option("pathGlobFilter", "lineitem.parquet").parquet(SF_SMALL)
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    sink = run_daily_sales_stream(spark, domain_views.sales(stream, orders), scratch_path(spark, "wm-sink"),
                                  watermark_delay="3650 days")
    batch = daily_sales(domain_views.sales(li, orders))
    got = sink.read()
    assert got.count() == batch.count() and got.exceptAll(batch.select(*got.columns)).count() == 0


def test_dashboard_views_run(spark):
    from perishables.operators import forecast
    from perishables.plans.dashboard import dashboard_views
    from perishables.settings import ForecastSettings, ReportFilters
    from perishables.sources.domain_views import load_domain

    d = load_domain(spark, SF_SMALL)
    cur = curate.curated_from(d)
    fc = forecast.forecast_rows(cur, None, ForecastSettings(model="baseline"))
    views = dashboard_views(fc, cur, curate.catalog(d.production), ReportFilters(product_id=1, horizon_days=7))
    assert set(views) >= {"kpi_overview", "projected_stock", "batch_drilldown", "risk_heatmap", "production_plan"}
    assert views["kpi_overview"].count() == 1
    assert views["projected_stock"].count() <= 7
    assert all(r.Product.startswith("1 •") for r in views["production_plan"].collect())
