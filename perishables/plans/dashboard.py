"""Dashboard read path: every view as a DataFrame from (forecast, curated, catalog, filters)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from perishables.operators import reports
from perishables.settings import ReportFilters


def dashboard_views(forecast: DataFrame, curated: DataFrame, catalog: DataFrame,
                    filters: ReportFilters = ReportFilters()) -> dict[str, DataFrame]:
    """Filtered forecast window and curated rows feed each block of the dashboard."""
    pmap = reports.product_map(catalog)
    fcw = reports.forecast_window(forecast, filters)
    sc = reports.apply_filters(curated, filters)
    return {
        "product_map": pmap,
        "stores": reports.store_order(curated),
        "kpi_overview": reports.kpi_overview(fcw, sc),
        "projected_stock": reports.projected_stock(fcw, sc),
        "batch_drilldown": reports.batch_drilldown(sc),
        "risk_heatmap": reports.risk_heatmap(sc, pmap),
        "production_plan": reports.production_plan(fcw, pmap),
        "kpi_sustainability": reports.kpi_sustainability(sc),
    }
