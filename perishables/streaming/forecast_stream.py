"""M2 as a stream: demand forecasts that follow every load, from state kept per series.

The input is a stream of daily series rows (E3), each load holding the days that are new.  Per (product, store) series the state
store keeps what a forecast needs and nothing that grows with the history: Holt-Winters level, trend and the ring of seven seasonal
values under fixed parameters, the last seven demands for the baseline, and the scalars (last day and stock, capacity sum, near-expiry
flag, energy sum and count, last forecast day).  A load advances the state by its new days only; the result equals that of the batch
operator over all days so far with the same parameters.  The touched series leave the stateful operator as one row each, and the forecast
rows are built from them by the batch operator's own plan in ``foreachBatch``.

Before a series has 14 days it keeps them, as its season cannot start yet.  Days not after the last one are late: the level, trend
and season have gone on, so they count in the scalars and in ``late_days`` only.  Series that stay quiet longer than ``idle`` are forgotten
(state TTL; for periodic triggers, since a run that ends when its input does would wait for them).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from perishables import schemas
from perishables.functions.scalars import NEAR_EXPIRY_DAYS
from perishables.operators import forecast
from perishables.operators.holt_winters import MIN_SEASONAL_POINTS, PERIOD
from perishables.session import scratch_path
from perishables.settings import ForecastSettings
from perishables.streaming.incremental_sales import VersionedSink

MODEL = "n bigint, head array<double>, l double, b double, s array<double>"
SCALARS = ("last_date date, recent array<double>, last_stock double, cap_sum double, risk int, energy_sum double, energy_n bigint, "
           "until date, late bigint")
OUT = ("product_id bigint, store_id string, n_days bigint, last_date date, last_stock double, cap_sum double, expiration_risk int, "
       "avg_energy double, baseline double, l double, b double, s array<double>, done_until date, late_days bigint")
INPUTS = ["product_id", "store_id", "date", "units_sold", "available_stock", "max_capacity_per_day_liters", "energy_consumption_kwh",
          "days_to_expiration"]


@dataclass(frozen=True)
class Smoothing:
    """Holt-Winters parameters that a stream keeps (fit them in batch, e.g. ``holt_winters.fitted_state``)."""

    alpha: float = 0.3
    beta: float = 0.05
    gamma: float = 0.1


def advance(model: tuple, values: list[float], p: Smoothing) -> tuple:
    """The model ``(n, head, l, b, s)`` after further values; ``head`` holds all values while they are fewer than 14."""
    n, head, level, trend, season = model
    n += len(values)
    if n < MIN_SEASONAL_POINTS:
        head = values = [*head, *values]
        gamma, level, trend, season = 0.0, (values[0] if values else 0.0), 0.0, [0.0] * PERIOD
    else:
        gamma = p.gamma
        if n - len(values) < MIN_SEASONAL_POINTS:
            values = [*head, *values]
            level, trend = sum(values[:PERIOD]) / float(PERIOD), 0.0
            season = [v - level for v in values[:PERIOD]]
        head = []
    season = list(season)
    for v in values:
        base = level + trend
        e = v - (base + season[0])
        level, trend = base + p.alpha * e, trend + (p.alpha * p.beta) * e
        season = [*season[1:], season[0] + gamma * e]
    return n, list(head), level, trend, season


class SeriesForecaster(StatefulProcessor):
    """One series per key: its new days in, its state as one row out."""

    def __init__(self, settings: ForecastSettings, smoothing: Smoothing, idle: dt.timedelta | None):
        self.settings, self.smoothing = settings, smoothing
        self.ttl = None if idle is None else int(idle.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.model = handle.getValueState("model", MODEL, self.ttl)
        self.scalars = handle.getValueState("scalars", SCALARS, self.ttl)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        days = pd.concat(list(rows)).sort_values("date", kind="stable")   # at most one row per day
        model = tuple(self.model.get()) if self.model.exists() else (0, [], 0.0, 0.0, [0.0] * PERIOD)
        last, recent, stock, cap, risk, energy, counted, until, late = (
            tuple(self.scalars.get()) if self.scalars.exists() else (None, [], 0.0, 0.0, 0, 0.0, 0, None, 0))
        done = until
        fresh: list[float] = []
        for day in days.itertuples(index=False):
            cap += float(day.max_capacity_per_day_liters)
            if not pd.isna(day.energy_consumption_kwh):
                energy, counted = energy + float(day.energy_consumption_kwh), counted + 1
            near = not pd.isna(day.days_to_expiration) and day.days_to_expiration <= NEAR_EXPIRY_DAYS and day.available_stock > 0
            risk = max(risk, int(near))
            if last is not None and day.date <= last:
                late += 1
                continue
            last, stock = day.date, float(day.available_stock)
            fresh.append(float(day.units_sold))
        model = advance(model, fresh, self.smoothing)
        recent = [*recent, *fresh][-self.settings.baseline_window:]
        until = max(d for d in (until, last + dt.timedelta(self.settings.horizon_days)) if d is not None)
        self.model.update(model)
        self.scalars.update((last, recent, stock, cap, risk, energy, counted, until, late))
        n, _, level, trend, season = model
        baseline = max(0.0, sum(recent) / len(recent)) if recent else 0.0
        yield pd.DataFrame({"product_id": [key[0]], "store_id": [key[1]], "n_days": [n], "last_date": [last], "last_stock": [stock], "cap_sum": [cap],
                            "expiration_risk": [risk], "avg_energy": [energy / counted if counted else None], "baseline": [baseline],
                            "l": [level], "b": [trend], "s": [season], "done_until": [done], "late_days": [late]})

    def close(self) -> None:
        pass


def series_states(daily: DataFrame, settings: ForecastSettings = ForecastSettings(), smoothing: Smoothing = Smoothing(),
                  idle: dt.timedelta | None = None) -> DataFrame:
    """The stream of touched series' rows, with ``model_state`` (null where K3 chooses the baseline)."""
    keyed = daily.dropna(subset=[*schemas.SERIES_KEYS, "date"]).select(*INPUTS).groupBy(*schemas.SERIES_KEYS)
    rows = keyed.transformWithStateInPandas(SeriesForecaster(settings, smoothing, idle), OUT, "Append", "None" if idle is None else "ProcessingTime")
    use_ets = F.lit(settings.model.lower() == "ets") & (F.col("n_days") >= max(3, settings.min_history_days))
    return rows.withColumn("model_state", F.when(use_ets, F.struct("l", "b", "s"))).drop("l", "b", "s")


def run_forecast_stream(spark: SparkSession, daily: DataFrame, sink_root: str, checkpoint: str | None = None, *,
                        settings: ForecastSettings = ForecastSettings(), smoothing: Smoothing = Smoothing()) -> VersionedSink:
    """Forecast after the loads that are there (``availableNow``), then stop; the rows are keyed by series and day in the sink."""
    sink = VersionedSink(spark, sink_root, schemas.FORECAST_KEYS)

    def write(batch: DataFrame, epoch_id: int) -> None:
        sink.upsert_batch(forecast.rows_from_states(batch, None, settings), epoch_id)

    query = (series_states(daily, settings, smoothing).writeStream.outputMode("append")
             .option("checkpointLocation", checkpoint or scratch_path(spark, "forecast-ckpt"))
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()
    return sink
