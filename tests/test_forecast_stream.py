"""The forecast stream: state kept per series against the batch forecast of everything seen so far."""
from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from perishables.operators import forecast, holt_winters
from perishables.settings import ForecastSettings
from perishables.session import scratch_path
from perishables.streaming import forecast_stream as S

START = dt.date(2025, 1, 1)
SCHEMA = ("product_id long, store_id string, date date, units_sold long, available_stock long, max_capacity_per_day_liters long, "
          "energy_consumption_kwh double, days_to_expiration int")


def rows(series, days, rng):
    return [(*series, START + dt.timedelta(d), rng.randrange(50), rng.randrange(9), rng.randrange(3), rng.choice([None, 80.0, 81.5]), rng.randrange(2, 9))
            for d in days]


def plain(values, p):
    """Holt-Winters over a whole history, one value after the other."""
    seasonal = len(values) >= 14
    level = sum(values[:7]) / 7 if seasonal else values[0]
    season, trend, gamma = [v - level for v in values[:7]] if seasonal else [0.0] * 7, 0.0, p.gamma if seasonal else 0.0
    for t, v in enumerate(values):
        e = v - (level + trend + season[t % 7])
        level, trend, season[t % 7] = level + trend + p.alpha * e, trend + p.alpha * p.beta * e, season[t % 7] + gamma * e
    return level, trend, [season[(len(values) + i) % 7] for i in range(7)]


@pytest.mark.parametrize("cuts", [(1, 2, 3), (5, 13, 14, 15), (13, 40), (14, 28), (40,), ()])
def test_state_advanced_in_parts_is_that_of_the_whole(cuts):
    rng, p = random.Random(len(cuts)), S.Smoothing()
    values = [float(rng.randrange(100)) for _ in range(60)]
    model = (0, [], 0.0, 0.0, [0.0] * 7)
    for a, b in zip((0, *cuts), (*cuts, 60)):
        model = S.advance(model, values[a:b], p)
        level, trend, season = plain(values[:b], p)
        assert model[0] == b and len(model[1]) == (b if b < 14 else 0)
        assert model[2:4] == (pytest.approx(level), pytest.approx(trend, abs=1e-9)) and list(model[4]) == pytest.approx(season, abs=1e-9)


def test_two_loads_equal_the_batch_forecast(spark):
    rng = random.Random(3)
    first = rows((1, "S1"), range(60), rng) + rows((2, "S1"), range(0, 20, 2), rng) + rows((3, "S1"), range(40), rng)
    second = rows((1, "S1"), range(60, 71), rng) + rows((2, "S1"), range(20, 60), rng) + rows((4, "S2"), range(3), rng)
    second += [(None, "S1", START, 1, 1, 1, 1.0, 1), (1, None, START, 1, 1, 1, 1.0, 1), (1, "S1", None, 1, 1, 1, 1.0, 1)]
    settings = ForecastSettings(model="ets", min_history_days=14, horizon_days=20)
    arrived, state, out = (scratch_path(spark, f"test-forecast-{n}") for n in ("arrived", "state", "sink"))

    def batch(loaded, existing):
        """The forecast operator over whole histories, with the stream's parameters."""
        daily = spark.createDataFrame([r for r in loaded if None not in r[:3]], SCHEMA)
        p = S.Smoothing()
        y, few = F.col("history"), F.size("history") < 14
        fitted = holt_winters.fold(y, holt_winters.start_state(y, ~few), F.lit(p.alpha), F.lit(p.beta), F.when(few, F.lit(0.0)).otherwise(F.lit(p.gamma)))
        profile = forecast.series_profile(daily).withColumn("st", F.when(F.col("n_days") >= 14, fitted)) \
            .withColumn("model_state", F.when(F.col("st").isNotNull(), F.struct("st.l", "st.b", F.array(*(f"st.{s}" for s in holt_winters.RING)).alias("s"))))
        return forecast.rows_from_states(profile, existing, settings)

    def run(load):
        spark.createDataFrame(load, SCHEMA).repartition(3).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(SCHEMA).parquet(arrived)
        return S.run_forecast_stream(spark, stream, out, state, settings=settings).read()

    def values(df):
        return {(r["product_id"], r["store_id"], r["forecast_date"]): tuple(round(r[c], 6) for c in (
            "forecasted_sales", "predicted_waste", "suggested_production", "expiration_risk", "predicted_logistics_cost")) for r in df.collect()}

    one = batch(first, None)
    assert values(run(first)) == values(one) and one.count() == 60
    both = values(one) | values(batch(first + second, one).filter("NOT (product_id = 3)"))
    got = run(second)
    assert values(got) == both and got.count() == len(both) == 60 + 11 + 20 + 20
    # nothing new: nothing is forecast again
    assert S.run_forecast_stream(spark, spark.readStream.schema(SCHEMA).parquet(arrived), out, state, settings=settings).read().count() == got.count()


def test_late_days_count_in_the_scalars_only(spark):
    rng = random.Random(4)
    arrived, state, out = (scratch_path(spark, f"test-late-{n}") for n in ("arrived", "state", "sink"))
    settings = ForecastSettings(model="ets", min_history_days=14, horizon_days=5)
    seen = []
    for load in (rows((1, "S1"), range(20), rng), [(1, "S1", START, 9, 9, 1000, 80.0, 9)] + rows((1, "S1"), [20], rng)):
        spark.createDataFrame(load, SCHEMA).write.mode("append").parquet(arrived)
        states = S.series_states(spark.readStream.schema(SCHEMA).parquet(arrived), settings)
        query = states.writeStream.option("checkpointLocation", state).foreachBatch(lambda b, _: seen.extend(b.collect())) \
            .trigger(availableNow=True).start()
        query.awaitTermination()
    before, after = seen
    assert (before["late_days"], after["late_days"], after["n_days"]) == (0, 1, 21)
    assert after["cap_sum"] >= before["cap_sum"] + 1000 and after["last_date"] == START + dt.timedelta(20)
    assert after["done_until"] == before["last_date"] + dt.timedelta(5)
