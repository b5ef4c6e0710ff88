"""K2: additive Holt-Winters (additive trend, additive weekly season) fitted per series.

The fit is one expression over a series' date-ordered history (``array<double>``, one value per observed day, bounded by the
calendar): ``aggregate`` folds the history into a state of level, trend and season for a point of parameters, ``transform`` does so for
every point of a grid, and the least of the resulting structs, which begin with the squared error, is the fit.  So the rows neither
leave the JVM nor multiply, and the fit adds no shuffle.

Recursion (period m = 7, one-step error e = v - (l + b + s)):
    l' = (l + b) + a e,   b' = b + (a B) e,   s' = s + g e
The season is a ring of seven: a step uses its first value and puts the new one behind the last, so the ring always begins with the next day.
Start: l = mean of the first 7 values, b = 0, s_i = y_i - l.  Series shorter than 14 values fit the trend only (g = 0, s = 0, l = first
value).  The grid point with the least squared error wins (ties: smaller a, B, g); rounds of local search around it (3x3x3
neighbours, halving steps) refine the parameters.
Forecast h steps ahead: l + h b + s[(h - 1) mod 7].

``attach_state`` is the hook for another model: a Python function per history, run in ``mapInPandas``.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables import schemas

SERIES = schemas.SERIES_KEYS
PERIOD = 7
MIN_SEASONAL_POINTS = 2 * PERIOD
ALPHAS = [0.01, 0.05, 0.1, 0.2, 0.3, 0.5, 0.7, 0.9]
BETAS = [0.001, 0.01, 0.05, 0.1, 0.3]
GAMMAS = [0.01, 0.05, 0.1, 0.3, 0.5]


REFINE_ROUNDS = 4          # local search after the grid: 3x3x3 neighbourhood, step halves each round

# the native fit: fewer points than the Python one, as every step of a fold is interpreted; its errors are as small
ALPHA_GRID, BETA_GRID, GAMMA_GRID = [0.02, 0.1, 0.3, 0.7], [0.001, 0.02, 0.1], [0.01, 0.1, 0.4]
ROUNDS = 3
STEPS = (0.05, 0.02, 0.05)   # of alpha, beta and gamma in the first round
RING = [f"s{i}" for i in range(1, PERIOD + 1)]


# ---------------------------------------------------------------- native fit
def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _points(points: list[tuple[float, float, float]]) -> Column:
    return F.array(*(F.struct(*(F.lit(float(v)).alias(n) for n, v in zip("abg", p))) for p in points))


def start_state(y: Column, seasonal: Column) -> Column:
    """The state before the first value: ``l``, ``b``, the ring and ``sse``."""
    mean = F.aggregate(F.slice(y, 1, PERIOD), F.lit(0.0), lambda acc, v: acc + v) / F.lit(float(PERIOD))
    level = F.when(seasonal, mean).otherwise(F.coalesce(F.get(y, F.lit(0)), F.lit(0.0)))
    return _let(level, lambda l0: F.struct(
        l0.alias("l"), F.lit(0.0).alias("b"),
        *(F.when(seasonal, F.get(y, F.lit(i)) - l0).otherwise(F.lit(0.0)).alias(s) for i, s in enumerate(RING)), F.lit(0.0).alias("sse")))


def fold(y: Column, start: Column, a: Column, b: Column, g: Column) -> Column:
    """The state after the values ``y`` under one point of parameters."""
    def step(state: Column, v: Column) -> Column:
        base = state["l"] + state["b"]
        return _let(v - (base + state["s1"]), lambda e: F.struct(
            (base + a * e).alias("l"), (state["b"] + (a * b) * e).alias("b"),
            *(state[later].alias(s) for s, later in zip(RING, RING[1:])), (state["s1"] + g * e).alias(RING[-1]),
            (state["sse"] + e * e).alias("sse")))

    return F.aggregate(y, start, step)


def fitted_state(history: Column, rounds: int = ROUNDS) -> Column:
    """The fitted state of a history (``STATE_TYPE``); null for a null or empty one.  Null, NaN and infinite values count as 0."""
    clean = F.transform(history.cast("array<double>"), lambda v: F.when(
        v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")), F.lit(0.0)).otherwise(v))

    def of(y: Column) -> Column:
        seasonal = F.size(y) >= MIN_SEASONAL_POINTS

        def with_start(start: Column) -> Column:
            def tried(a: Column, b: Column, g: Column) -> Column:
                # the squared error comes first, then the parameters: the least struct is the fit
                return _let(fold(y, start, a, b, g), lambda st: F.struct(
                    st["sse"].alias("sse"), a.alias("a"), b.alias("b"), g.alias("g"), st["l"].alias("level"), st["b"].alias("trend"),
                    F.array(*(st[s] for s in RING)).alias("season")))

            def refined(best: Column, left: int, scale: float) -> Column:
                if not left:
                    return best

                def moved(value: Column, by: Column, step: float) -> Column:
                    return F.least(F.greatest(value + by * F.lit(step * scale), F.lit(0.0)), F.lit(1.0))

                near = _points([o for o in itertools.product((-1.0, 0.0, 1.0), repeat=3) if any(o)])
                return _let(F.array_min(F.concat(F.array(best), F.transform(near, lambda o: tried(
                    moved(best["a"], o["a"], STEPS[0]), moved(best["b"], o["b"], STEPS[1]),
                    F.when(seasonal, moved(best["g"], o["g"], STEPS[2])).otherwise(F.lit(0.0)))))),
                    lambda better: refined(better, left - 1, scale / 2))

            grid = F.when(seasonal, _points(list(itertools.product(ALPHA_GRID, BETA_GRID, GAMMA_GRID)))) \
                .otherwise(_points(list(itertools.product(ALPHA_GRID, BETA_GRID, [0.0]))))
            return _let(F.array_min(F.transform(grid, lambda p: tried(p["a"], p["b"], p["g"]))), lambda best: refined(best, rounds, 1.0))

        return _let(start_state(y, seasonal), with_start)

    return F.when(F.size(history) > 0, _let(_let(clean, of), lambda best: F.struct(
        best["level"].alias("l"), best["trend"].alias("b"), best["season"].alias("s"), best["a"].alias("alpha"), best["b"].alias("beta"),
        best["g"].alias("gamma"), best["sse"].alias("sse"), (F.size(history) >= MIN_SEASONAL_POINTS).alias("seasonal"))))


# ---------------------------------------------------------------- Python fit


def _run(y: np.ndarray, a: np.ndarray, be: np.ndarray, g: np.ndarray, seasonal: bool):
    """The recursion for many parameter points at once; returns sse, level, trend, season arrays."""
    n, size = len(y), len(a)
    if seasonal:
        level0 = float(np.mean(y[:PERIOD]))
        season = np.tile(y[:PERIOD] - level0, (size, 1))
    else:
        level0 = float(y[0]) if n else 0.0
        season = np.zeros((size, PERIOD))
    level = np.full(size, level0)
    trend = np.zeros(size)
    sse = np.zeros(size)
    for t in range(n):
        v = y[t]
        j = t % PERIOD
        s0 = season[:, j]
        base = level + trend
        err = v - (base + s0)
        sse += err * err
        new_level = a * (v - s0) + (1.0 - a) * base
        season[:, j] = g * (v - base) + (1.0 - g) * s0
        trend = be * (new_level - level) + (1.0 - be) * trend
        level = new_level
    return sse, level, trend, season


def _best(sse: np.ndarray, a: np.ndarray, be: np.ndarray, g: np.ndarray) -> int:
    return int(np.lexsort((g, be, a, sse))[0])


def fit_series(y: np.ndarray) -> dict:
    """Fit one series: grid search, then local refinement (numpy, vectorised over candidates)."""
    y = np.nan_to_num(np.asarray(y, dtype=float), nan=0.0, posinf=0.0, neginf=0.0)
    n = len(y)
    seasonal = n >= MIN_SEASONAL_POINTS
    gammas = GAMMAS if seasonal else [0.0]
    grid = np.array(list(itertools.product(ALPHAS, BETAS, gammas)), dtype=float)
    a, be, g = grid[:, 0], grid[:, 1], grid[:, 2]
    sse, level, trend, season = _run(y, a, be, g, seasonal)
    k = _best(sse, a, be, g)
    point, best_sse = np.array([a[k], be[k], g[k]]), sse[k]
    state = (level[k], trend[k], season[k].copy())
    step = np.array([0.05, 0.02, 0.05 if seasonal else 0.0])
    offsets = np.array(list(itertools.product((-1.0, 0.0, 1.0), repeat=3)))
    for _ in range(REFINE_ROUNDS):
        cand = np.clip(point + offsets * step, 0.0, 1.0)
        c_sse, c_level, c_trend, c_season = _run(y, cand[:, 0], cand[:, 1], cand[:, 2], seasonal)
        j = _best(c_sse, cand[:, 0], cand[:, 1], cand[:, 2])
        if c_sse[j] < best_sse:
            point, best_sse = cand[j], c_sse[j]
            state = (c_level[j], c_trend[j], c_season[j].copy())
        step = step / 2.0
    rotated = [float(state[2][(n + i) % PERIOD]) for i in range(PERIOD)]
    return {"l": float(state[0]), "b": float(state[1]), "s": rotated, "alpha": float(point[0]),
            "beta": float(point[1]), "gamma": float(point[2]), "sse": float(best_sse), "seasonal": bool(seasonal)}


Fitter = Callable[[np.ndarray], dict]

STATE_TYPE = T.StructType([
    T.StructField("l", T.DoubleType()), T.StructField("b", T.DoubleType()),
    T.StructField("s", T.ArrayType(T.DoubleType())), T.StructField("alpha", T.DoubleType()),
    T.StructField("beta", T.DoubleType()), T.StructField("gamma", T.DoubleType()),
    T.StructField("sse", T.DoubleType()), T.StructField("seasonal", T.BooleanType()),
])


def smooth_series(y: np.ndarray, alpha: float, beta: float, gamma: float) -> dict:
    """The state after one series under given parameters (no search)."""
    n = len(y)
    seasonal = n >= MIN_SEASONAL_POINTS
    point = np.array([[alpha, beta, gamma if seasonal else 0.0]])
    sse, level, trend, season = _run(np.asarray(y, dtype=float), *point.T, seasonal)
    return {"l": float(level[0]), "b": float(trend[0]), "s": [float(season[0][(n + i) % PERIOD]) for i in range(PERIOD)],
            "alpha": alpha, "beta": beta, "gamma": float(point[0, 2]), "sse": float(sse[0]), "seasonal": seasonal}


def _state_batches(batches: Iterator[pd.DataFrame], flag: str, fitter: Fitter) -> Iterator[pd.DataFrame]:
    def state(history) -> dict | None:
        try:
            return fitter(np.asarray(history, dtype=float))
        except (ArithmeticError, ValueError, np.linalg.LinAlgError):
            return None  # this series falls back to its baseline

    for pdf in batches:
        pdf = pdf.copy()
        pdf["model_state"] = [state(h) if use else None for h, use in zip(pdf["history"], pdf[flag])]
        yield pdf


def attach_state(profile: DataFrame, flag: str = "use_ets", fitter: Fitter = fit_series) -> DataFrame:
    """Per-series rows in, the same rows out plus ``model_state`` (null where ``flag`` is false or the fit fails).

    ``fitter`` turns a history into a state (see ``STATE_TYPE``), so another model of level, trend and
    weekly season can take the place of the built-in one.  Rows pass through unchanged, so the plan
    stays linear: no join back to the profile, and the series partitioning is kept.
    """
    schema = T.StructType(profile.schema.fields + [T.StructField("model_state", STATE_TYPE, True)])
    return profile.mapInPandas(lambda it: _state_batches(it, flag, fitter), schema)


def forecast_expr(step: Column, state: str = "model_state") -> Column:
    """Point forecast ``step`` days ahead from a fitted state column."""
    idx = ((step - F.lit(1)) % F.lit(PERIOD)) + F.lit(1)
    return F.col(f"{state}.l") + step.cast("double") * F.col(f"{state}.b") + F.element_at(F.col(f"{state}.s"), idx)
