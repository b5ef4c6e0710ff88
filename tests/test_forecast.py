"""Forecast operators: Holt-Winters against an independent recursion, model choice, properties."""
from __future__ import annotations

import datetime as dt
import itertools
import math

import numpy as np
from pyspark.sql import functions as F

from perishables import schemas
from perishables.operators import forecast, holt_winters
from perishables.settings import ForecastSettings

START = dt.date(2025, 1, 1)


def _daily(spark, series: dict[tuple[int, str], list[tuple[int, float]]], stock=5, cap=10, days_left=9):
    rows = [(pid, sid, START + dt.timedelta(days=d), int(y), stock, cap, 80.0, 1.0, 3.0, days_left)
            for (pid, sid), pts in series.items() for d, y in pts]
    return spark.createDataFrame(rows, "product_id long, store_id string, date date, units_sold long, "
                                       "available_stock long, max_capacity_per_day_liters long, "
                                       "energy_consumption_kwh double, transport_time_hours double, "
                                       "transport_temperature_c double, days_to_expiration int")


def _recursion(y, a, b, g, seasonal):
    """Plain-Python additive Holt-Winters, one parameter point."""
    m = 7
    if seasonal:
        level = sum(y[:m]) / m
        season = [v - level for v in y[:m]]
    else:
        level, season = y[0], [0.0] * m
        g = 0.0
    trend, sse = 0.0, 0.0
    for t, v in enumerate(y):
        j = t % m
        s0 = season[j]
        base = level + trend
        sse += (v - base - s0) ** 2
        new_level = a * (v - s0) + (1 - a) * base
        season[j] = g * (v - base) + (1 - g) * s0
        trend = b * (new_level - level) + (1 - b) * trend
        level = new_level
    n = len(y)
    return sse, level, trend, [season[(n + i) % m] for i in range(m)]


def test_holt_winters_matches_independent_recursion_and_grid_minimum():
    rng = np.random.default_rng(7)
    t = np.arange(60)
    y = list(20 + 0.3 * t + 4 * np.sin(2 * math.pi * t / 7) + rng.normal(0, 1, 60))
    fit = holt_winters.fit_series(np.array(y))
    sse, level, trend, season = _recursion(y, fit["alpha"], fit["beta"], fit["gamma"], True)
    assert math.isclose(fit["sse"], sse, rel_tol=1e-9)
    assert math.isclose(fit["l"], level, rel_tol=1e-9) and math.isclose(fit["b"], trend, rel_tol=1e-9, abs_tol=1e-12)
    assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-12) for a, b in zip(fit["s"], season))
    best = min(_recursion(y, a, b, g, True)[0] for a, b, g in
               itertools.product(holt_winters.ALPHAS, holt_winters.BETAS, holt_winters.GAMMAS))
    assert fit["sse"] <= best * (1 + 1e-12)


def test_trend_only_branch_for_short_series():
    y = np.array([5.0, 6, 7, 8, 9, 10, 11, 12, 13, 14])
    fit = holt_winters.fit_series(y)
    assert not fit["seasonal"] and fit["gamma"] == 0.0 and fit["s"] == [0.0] * 7
    assert fit["b"] > 0


def test_model_choice_and_ets_rows(spark):
    # short_series: 1, 2, 3, 13, 14 and 30 observed days (with gaps); weekly series: 60 days
    series = {(1, f"S{n}"): [(2 * d, 10 + d % 3) for d in range(n)] for n in (1, 2, 3, 13, 14, 30)}
    rng = np.random.default_rng(3)
    series[(2, "S1")] = [(d, round(30 + 0.3 * d + 5 * math.sin(2 * math.pi * d / 7) + rng.normal(0, 1)))
                         for d in range(60)]
    daily = _daily(spark, series)
    settings = ForecastSettings(model="ets", min_history_days=14, horizon_days=10)
    prof = forecast.series_profile(daily)
    choice = {(r.product_id, r.store_id): r.model for r in forecast.model_choice(prof, settings).collect()}
    assert choice[(1, "S13")] == "baseline" and choice[(1, "S14")] == "ets" and choice[(2, "S1")] == "ets"
    rows = forecast.forecast_from_daily(daily, None, settings).collect()
    assert len(rows) == 7 * 10
    assert all(r.forecasted_sales >= 0 and math.isfinite(r.forecasted_sales) for r in rows)
    base = {(r.product_id, r.store_id): r.baseline for r in prof.select("product_id", "store_id", "baseline").collect()}
    for r in rows:
        if choice[(r.product_id, r.store_id)] == "baseline":
            assert r.forecasted_sales == base[(r.product_id, r.store_id)]
    weekly = sorted((r.forecast_date, r.forecasted_sales) for r in rows if r.product_id == 2)
    assert len({round(v, 6) for _, v in weekly}) > 1  # seasonal shape, not a constant


def test_baseline_is_mean_of_last_seven_observed_days(spark):
    pts = [(0, 100), (5, 1), (6, 2), (7, 3), (9, 4), (10, 5), (20, 6), (21, 7)]
    daily = _daily(spark, {(1, "S1"): pts})
    b = forecast.baseline_mean(daily).first().baseline
    assert b == sum([1, 2, 3, 4, 5, 6, 7]) / 7


def test_incremental_rerun_adds_nothing_and_partial_forecast(spark):
    series = {(1, "S1"): [(d, 5 + d % 4) for d in range(40)]}
    daily = _daily(spark, series)
    s = ForecastSettings(model="baseline", horizon_days=30)
    first = forecast.forecast_from_daily(daily, None, s)
    assert first.count() == 30
    assert forecast.forecast_from_daily(daily, first, s).count() == 0
    partial = first.orderBy("forecast_date").limit(20)  # partial_forecast fixture: 20 of 30 dates stored
    rest = forecast.forecast_from_daily(daily, partial, s).collect()
    assert len(rest) == 10
    assert min(r.forecast_date for r in rest) == START + dt.timedelta(days=39 + 21)


def test_capacity_cap_binds(spark):
    # demand ~ 50/day, stock 0, capacity 1 on each of 3 history days: cap_sum 3 * horizon 2 = 6 total
    daily = _daily(spark, {(1, "S1"): [(0, 50), (1, 50), (2, 50)]}, stock=0, cap=1, days_left=1)
    rows = forecast.forecast_from_daily(daily, None, ForecastSettings(model="baseline", horizon_days=2)).collect()
    assert [r.suggested_production for r in rows] == [3.0, 3.0]
    assert all(r.predicted_waste == 0.0 and r.expiration_risk == 0 for r in rows)


def test_waste_and_risk(spark):
    daily = _daily(spark, {(1, "S1"): [(0, 1), (1, 1)]}, stock=100, cap=10, days_left=2)
    rows = forecast.forecast_from_daily(daily, None, ForecastSettings(model="baseline", horizon_days=4)).collect()
    assert all(r.predicted_waste == (100 - 4) / 4 and r.expiration_risk == 1 for r in rows)


def test_upsert_replaces_keys(spark):
    s = schemas.FORECAST
    old = spark.createDataFrame([(1, "S1", START, 1.0, 0.0, 0.0, 0, 1.0), (1, "S1", START + dt.timedelta(1), 1.0, 0.0, 0.0, 0, 1.0)], s)
    new = spark.createDataFrame([(1, "S1", START + dt.timedelta(1), 9.0, 0.0, 0.0, 1, 1.0), (1, "S1", START + dt.timedelta(2), 9.0, 0.0, 0.0, 1, 1.0)], s)
    out = forecast.upsert(old, new)
    got = sorted((r.forecast_date, r.forecasted_sales) for r in out.collect())
    assert got == [(START, 1.0), (START + dt.timedelta(1), 9.0), (START + dt.timedelta(2), 9.0)]
    assert out.groupBy(*schemas.FORECAST_KEYS).count().filter(F.col("count") > 1).count() == 0


def test_stocked_forecast_reaches_every_branch(spark):
    from perishables.plans.registered import q_forecast_stocked
    from tests.conftest import SF_ORACLE

    rows = q_forecast_stocked(spark, SF_ORACLE).collect()
    assert {r["predicted_waste"] > 0 for r in rows} == {True, False}
    assert {r["expiration_risk"] for r in rows} == {0, 1}
    assert {r["suggested_production"] > 0 for r in rows} == {True, False}
    need = {}
    for r in rows:  # product 4's capacity binds somewhere: less is suggested than demand lacks
        need.setdefault((r["product_id"], r["store_id"]), []).append(r)
    assert any(k[0] == 4 and 0 < v[0]["suggested_production"] < v[0]["forecasted_sales"] - 1 for k, v in need.items())


def test_a_failing_fit_falls_back_to_the_baseline(spark):
    import datetime as dt

    from perishables.settings import ForecastSettings

    days = [(1, "S1", dt.date(2025, 1, 1) + dt.timedelta(i), 5 + i % 3, 9) for i in range(40)]
    days += [(2, "S1", d, 4, 9) for _, _, d, _, _ in days]
    daily = forecast.product_store_daily(spark.createDataFrame(
        days, "product_id long, store_id string, date date, units_sold long, available_stock long"))

    def fitter(history):
        if history[0] == 4.0:
            raise ValueError("no fit")
        return holt_winters.smooth_series(history, 0.3, 0.05, 0.1)

    own = {(r["product_id"], r["forecast_date"]): r["forecasted_sales"]
           for r in forecast.forecast_from_daily(daily, None, ForecastSettings(model="ets", fitter=fitter)).collect()}
    base = {(r["product_id"], r["forecast_date"]): r["forecasted_sales"]
            for r in forecast.forecast_from_daily(daily, None, ForecastSettings(model="baseline")).collect()}
    assert own.keys() == base.keys()
    assert all(own[k] == base[k] for k in own if k[0] == 2) and any(own[k] != base[k] for k in own if k[0] == 1)


def test_native_fit_is_the_best_of_its_points(spark):
    rng = np.random.default_rng(11)
    histories = [(20 + 0.2 * t + 4 * np.sin(2 * math.pi * t / 7) + rng.normal(0, 1, len(t))).tolist() for t in map(np.arange, (14, 15, 40, 100))]
    histories += [[5.0, 6.0, 7.0, 8.0, 9.0, 10.0], [3.0], [0.0] * 20, [7.0] * 13]
    rows = spark.createDataFrame([(i, h) for i, h in enumerate(histories)], "i int, h array<double>")
    for r in rows.select("i", holt_winters.fitted_state(F.col("h")).alias("fit")).collect():
        y, fit = histories[r["i"]], r["fit"]
        seasonal = len(y) >= 14
        sse, level, trend, season = _recursion(y, fit["alpha"], fit["beta"], fit["gamma"], seasonal)
        assert fit["seasonal"] == seasonal and math.isclose(fit["sse"], sse, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(fit["l"], level, rel_tol=1e-9) and math.isclose(fit["b"], trend, rel_tol=1e-9, abs_tol=1e-9)
        assert all(math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9) for a, b in zip(fit["s"], season))
        points = itertools.product(holt_winters.ALPHA_GRID, holt_winters.BETA_GRID, holt_winters.GAMMA_GRID if seasonal else [0.0])
        assert fit["sse"] <= min(_recursion(y, *p, seasonal)[0] for p in points) * (1 + 1e-9) + 1e-9
        # the Python fitter tries more than twice as many points; over a long history its errors are hardly smaller
        if len(y) >= 40:
            assert fit["sse"] <= holt_winters.fit_series(np.array(y))["sse"] * 1.02


def test_native_fit_of_odd_histories(spark):
    nan, inf = float("nan"), float("inf")
    cases = {0: None, 1: [], 2: [None], 3: [nan, inf, -inf, 4.0], 4: [0.0, 0.0, 0.0, 4.0], 5: [1e308] * 20}
    rows = spark.createDataFrame(list(cases.items()), "i int, h array<double>").select("i", holt_winters.fitted_state(F.col("h")).alias("fit"))
    fits = {r["i"]: r["fit"] for r in rows.collect()}
    assert fits[0] is None and fits[1] is None and fits[2]["l"] == 0.0 and fits[3] == fits[4] and fits[5] is not None


def test_native_fit_keeps_rows_in_the_jvm_and_apart(spark):
    from perishables.plans.registered import QUERIES
    from tests.conftest import SF_SMALL

    df = QUERIES["holt_winters"](spark, SF_SMALL)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Pandas" not in plan and "Python" not in plan and "Arrow" not in plan
    # the fits' own exchange is there, and not the one that the rows come with
    assert f"{2 * int(spark.conf.get('spark.sql.shuffle.partitions')) + 1}), REPARTITION_BY_NUM" in plan
