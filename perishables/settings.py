"""Run settings as frozen dataclasses (defaults follow the reference configuration)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class ForecastSettings:
    """Forecast run parameters.

    horizon_days      number of future days per series (reference default 30)
    min_history_days  series with fewer observed days use the baseline (default 30)
    model             "ets" (additive Holt-Winters) or "baseline"
    step_mode         "calendar": forecast step = days after the last history day;
                      "compact": steps 1..n over the remaining (not yet forecast) dates,
                      which is how the reference phases incremental runs
    baseline_window   number of last observed days averaged by the baseline
    fitter            another model for "ets": history -> state of level, trend and season
                      (``holt_winters.STATE_TYPE``); a fit that fails falls back to the baseline
    """

    horizon_days: int = 30
    min_history_days: int = 30
    model: str = "ets"
    step_mode: str = "calendar"
    baseline_window: int = 7
    fitter: Callable | None = None

    def __post_init__(self) -> None:
        if self.horizon_days < 1:
            raise ValueError("horizon_days must be >= 1")
        if self.step_mode not in ("calendar", "compact"):
            raise ValueError("step_mode must be 'calendar' or 'compact'")


@dataclass(frozen=True)
class ReportFilters:
    """Dashboard selection: optional product and store, and a horizon in days."""

    product_id: int | None = None
    store_id: str | None = None
    horizon_days: int | None = 14
