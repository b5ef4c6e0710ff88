"""Incremental demand forecast per (product, store) series.

Data flow (one Spark plan, the curated fact is scanned once):

    curated --E3 groupBy(product, store, date)--------> daily series
            --profile groupBy(product, store)---------> scalars, baseline, date-ordered history
            --K2 fold of the history, in the row-------> Holt-Winters state (chosen series only)
            --H5 explode(sequence(1, horizon))--------> future dates
            --C6 left_anti existing keys--------------> dates still to forecast
            --J7-J9 per-series totals, joined back----> forecast rows

After E3 every step is keyed by the series and keeps the series partitioning.
E3 has map-side partial aggregation, so a hot series or batch never reaches
one task with more than one row per calendar day.  The largest per-series
object is the history array, bounded by the number of observed days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from perishables import schemas
from perishables.functions.aggregates import EXACT_SUM_TYPE, exact_avg
from perishables.functions.coerce import add_missing_columns
from perishables.functions.nulls import flag, sum0
from perishables.functions.scalars import NEAR_EXPIRY_DAYS
from perishables.operators import holt_winters
from perishables.settings import ForecastSettings

SERIES = schemas.SERIES_KEYS
# --- fixed values (the inputs of the daily series, by name) ---
DAILY_INPUTS = ["units_sold", "available_stock", "max_capacity_per_day_liters", "energy_consumption_kwh",
                "transport_time_hours", "transport_temperature_c", "days_to_expiration"]


def product_store_daily(curated: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """One row per (product, store, date); sums, mean temperature, closest expiry, and ``extra`` aggregates.

    Absent inputs are added as 0; rows with a null key are dropped (T5).
    """
    d = add_missing_columns(curated, {c: 0 for c in DAILY_INPUTS})
    return (d.dropna(subset=[*SERIES, "date"])
            .groupBy(*SERIES, "date")
            .agg(sum0("units_sold").cast("bigint").alias("units_sold"),
                 sum0("available_stock").cast("bigint").alias("available_stock"),
                 sum0("max_capacity_per_day_liters").cast("bigint").alias("max_capacity_per_day_liters"),
                 sum0(F.col("energy_consumption_kwh").cast("double")).cast("double").alias("energy_consumption_kwh"),
                 sum0(F.col("transport_time_hours").cast("double")).cast("double").alias("transport_time_hours"),
                 exact_avg(F.col("transport_temperature_c").cast("double")).alias("transport_temperature_c"),
                 F.min("days_to_expiration").alias("days_to_expiration"), *(extra or [])))


def history_length(daily: DataFrame) -> DataFrame:
    """E5: observed days per series (rows are unique per day, so a count)."""
    return daily.groupBy(*SERIES).agg(F.count(F.lit(1)).alias("n_days"))


def _scalar_aggs() -> list[Column]:
    near = (F.col("days_to_expiration") <= NEAR_EXPIRY_DAYS) & (F.col("available_stock") > 0)
    return [
        F.count(F.lit(1)).alias("n_days"),
        F.max("date").alias("last_date"),
        F.max_by("available_stock", "date").cast("double").alias("last_stock"),
        sum0("max_capacity_per_day_liters").cast("double").alias("cap_sum"),
        F.max(flag(near)).alias("expiration_risk"),
        exact_avg(F.col("energy_consumption_kwh")).alias("avg_energy"),
    ]


def series_scalars(daily: DataFrame) -> DataFrame:
    """Last date, last stock, capacity sum, near-expiry-with-stock flag, mean energy."""
    return daily.groupBy(*SERIES).agg(*_scalar_aggs())


def _tail_mean(history: Column, window: int) -> Column:
    """Mean of the last ``window`` history values (left-to-right sum), clipped at 0."""
    n = F.size(history)
    tail = F.slice(history, F.greatest(n - F.lit(window - 1), F.lit(1)), window)
    mean = F.aggregate(tail, F.lit(0.0), lambda acc, v: acc + v) / F.size(tail).cast("double")
    return F.when(F.size(tail) == 0, F.lit(0.0)).when(mean < 0, F.lit(0.0)).otherwise(mean)


def series_profile(daily: DataFrame, window: int = 7, extra: list[Column] | None = None) -> DataFrame:
    """One row per series: E6 scalars, F1 baseline, the date-ordered demand history, and ``extra`` aggregates."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col("date"), F.col("units_sold").cast("double").alias("y"))))
    prof = daily.groupBy(*SERIES).agg(*_scalar_aggs(), pairs.alias("h"), *(extra or []))
    history = F.transform("h", lambda x: x["y"])
    return (prof.withColumn("history", history)
            .withColumn("baseline", _tail_mean(F.col("history"), window))
            .drop("h"))


def last_days(daily: DataFrame, window: int = 7) -> DataFrame:
    """The last ``window`` observed days of every series.

    The rank's bound goes below the exchange as a window group limit: a task hands on at most ``window`` days of a series.
    """
    place = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.col("date").desc()))
    return daily.select(*SERIES, "date", "units_sold").withColumn("place", place).filter(F.col("place") <= window)


def baseline_mean(daily: DataFrame, window: int = 7) -> DataFrame:
    """F1/K1: mean of the last ``window`` observed days per series, clipped at 0; no history is collected."""
    days = last_days(daily, window).groupBy(*SERIES).agg(
        F.array_sort(F.collect_list(F.struct("date", F.col("units_sold").cast("double").alias("y")))).alias("h"))
    return days.select(*SERIES, _tail_mean(F.transform("h", lambda d: d["y"]), window).alias("baseline"))


def future_dates(scalars: DataFrame, horizon_days: int) -> DataFrame:
    """H5: the next ``horizon_days`` calendar days after each series' last day."""
    step = F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("step")
    return (scalars.select(*SERIES, "last_date", step)
            .select(*SERIES, F.date_add("last_date", F.col("step")).alias("forecast_date"), "step"))


def remaining_dates(future: DataFrame, existing: DataFrame | None) -> DataFrame:
    """Drop (product, store, date) keys already forecast."""
    if existing is None:
        return future
    done = existing.select(*schemas.FORECAST_KEYS).dropna()
    return future.join(done, schemas.FORECAST_KEYS, "left_anti")


def model_choice(scalars: DataFrame, settings: ForecastSettings) -> DataFrame:
    """K3: baseline when history < max(3, min_history_days) or the model is not "ets"."""
    threshold = max(3, settings.min_history_days)
    use_ets = (F.col("n_days") >= threshold) & F.lit(settings.model.lower() == "ets")
    return scalars.select(*SERIES, "n_days",
                          F.when(use_ets, F.lit("ets")).otherwise(F.lit("baseline")).alias("model"))


def _yhat(settings: ForecastSettings) -> Column:
    baseline = F.coalesce(F.col("baseline"), F.lit(0.0))
    if settings.model.lower() != "ets":
        return baseline
    ets = holt_winters.forecast_expr(F.col("step"))
    finite = ets.isNotNull() & ~F.isnan(ets) & (F.abs(ets) != F.lit(float("inf")))
    return F.when(F.col("model_state").isNotNull() & finite, F.when(ets < 0, F.lit(0.0)).otherwise(ets)) \
        .otherwise(baseline)


def forecast_from_profile(profile: DataFrame, existing: DataFrame | None,
                          settings: ForecastSettings, keep: list[str] | None = None) -> DataFrame:
    """H5 -> C6 -> F6 -> K1/K2/K3 -> J7-J9 as one linear plan over per-series rows.

    The fitted state travels with the series row
    and the per-series totals are a window partitioned by series, so the
    profile is consumed once and nothing joins back to it.
    """
    prof = profile
    if settings.model.lower() == "ets":
        threshold = max(3, settings.min_history_days)
        # The fit is CPU-bound per series while the profile is small in bytes, so AQE would coalesce it into a few
        # partitions and run the fits one after another.  An explicit partition count keeps them apart; it is not the
        # session's own, as an exchange to the partitioning that the rows already have is dropped.
        parts = 2 * int(prof.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1
        spread = prof.repartition(parts, *SERIES)
        use_ets = F.col("n_days") >= threshold
        if settings.fitter is None:
            prof = spread.withColumn("model_state", F.when(use_ets, holt_winters.fitted_state(F.col("history"))))
        else:
            prof = holt_winters.attach_state(spread.withColumn("use_ets", use_ets), "use_ets", settings.fitter)
    else:
        prof = prof.withColumn("model_state", F.lit(None))
    return rows_from_states(prof, existing, settings, keep)


def rows_from_states(states: DataFrame, existing: DataFrame | None, settings: ForecastSettings, keep: list[str] | None = None) -> DataFrame:
    """H5 -> C6 -> J7-J9 over per-series rows that carry their ``model_state`` (null: the baseline).

    Dates in ``existing``, or up to the row's ``done_until`` where there is such a column, are not forecast again.
    Columns to ``keep`` stay beside the forecast's own.
    """
    done = [F.col("done_until")] if "done_until" in states.columns else []
    rows = states.select(*SERIES, "last_stock", "cap_sum", "expiration_risk", "avg_energy", "baseline",
                       "model_state", F.explode(F.sequence(F.lit(1), F.lit(settings.horizon_days))).alias("step"),
                       F.col("last_date"), *done, *(keep or []))
    rows = rows.withColumn("forecast_date", F.date_add("last_date", F.col("step")))
    if done:
        rows = rows.filter(F.col("done_until").isNull() | (F.col("forecast_date") > F.col("done_until")))
    rows = remaining_dates(rows, existing)
    series = Window.partitionBy(*SERIES)
    if settings.step_mode == "compact":
        rows = rows.withColumn("step", F.row_number().over(series.orderBy("forecast_date")))
    rows = rows.withColumn("forecasted_sales", _yhat(settings).cast("double"))
    rows = rows.withColumns({
        "n_rem": F.count(F.lit(1)).over(series),
        "total_forecast": F.coalesce(F.sum(F.col("forecasted_sales").cast(EXACT_SUM_TYPE)).over(series).cast("double"),
                                     F.lit(0.0)),
    })
    n = F.greatest(F.col("n_rem"), F.lit(1)).cast("double")
    waste = F.col("last_stock") - F.col("total_forecast")
    gap = F.col("total_forecast") - F.col("last_stock")
    sugg = F.when(gap > 0, gap).otherwise(F.lit(0.0))
    sugg = F.when(F.col("cap_sum") > 0, F.least(sugg, F.col("cap_sum") * F.col("n_rem"))).otherwise(sugg)
    return rows.select(
        *SERIES, "forecast_date", "forecasted_sales",
        (F.when(waste > 0, waste).otherwise(F.lit(0.0)) / n).alias("predicted_waste"),
        (sugg / n).alias("suggested_production"),
        F.col("expiration_risk").cast("int").alias("expiration_risk"),
        F.col("avg_energy").cast("double").alias("predicted_logistics_cost"), *(keep or []))


def forecast_from_daily(daily: DataFrame, existing: DataFrame | None = None,
                        settings: ForecastSettings = ForecastSettings()) -> DataFrame:
    return forecast_from_profile(series_profile(daily, settings.baseline_window), existing, settings)


def forecast_rows(curated: DataFrame, existing: DataFrame | None = None,
                  settings: ForecastSettings = ForecastSettings()) -> DataFrame:
    """K4 without the write: the new forecast rows for dates not yet forecast."""
    return forecast_from_daily(product_store_daily(curated), existing, settings)


def upsert(existing: DataFrame, new: DataFrame, keys: list[str] = schemas.FORECAST_KEYS) -> DataFrame:
    """Keyed upsert: rows of ``new`` replace same-key rows of ``existing``; new keys are added.

    ``new`` is first reduced to one row per key (largest values win, deterministically).
    """
    cols = new.columns
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in cols if c not in keys])
    new1 = new.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
    kept = existing.join(new1.select(*keys), keys, "left_anti")
    return kept.select(*cols).unionByName(new1.select(*cols))
