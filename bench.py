"""Benchmark: headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``.

Each query is executed in full through the ``noop`` sink (every row computed,
nothing collected to the driver).  Three representative queries (ETL, forecast,
reports) first run once on the smallest data set, untimed, so most generated
code is compiled and the JIT is warm before the measured runs.  The end-to-end pipeline (ETL -> curated tables ->
incremental forecast -> JSON export) is timed as ``pipeline_end_to_end``.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from perishables.plans import pipeline  # noqa: E402
from perishables.plans.registered import QUERIES  # noqa: E402
from perishables.session import build_session, scratch_path  # noqa: E402
from perishables.settings import ForecastSettings  # noqa: E402
from perishables.sources.domain_views import load_domain  # noqa: E402

HEADLINE = [
    "curated_sales", "daily_sales", "daily_logistics", "product_store_daily", "baseline_forecast",
    "forecast_rows", "holt_winters", "kpi_overview", "projected_stock", "batch_drilldown", "risk_heatmap",
    "production_plan", "kpi_sustainability", "join_health", "orphan_checks", "pk_duplicates",
    "constraint_checks", "quality_report", "stream_daily_sales",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", app="perishables-bench", shuffle_partitions=int(cpus) * 2,
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    if not spark.conf.get("spark.checkpoint.dir", None):
        path = tempfile.mkdtemp(prefix="perishables-bench-")
        spark.conf.set("spark.checkpoint.dir", path)
        spark.sparkContext.setCheckpointDir(path)

    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        for name in ("curated_sales", "holt_winters", "kpi_overview"):
            run(QUERIES[name](spark, warm))

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    t0 = time.perf_counter()
    out = pipeline.run_pipeline(spark, load_domain(spark, sf_dir), scratch_path(spark, "bench-pipeline"),
                                ForecastSettings(model="ets"))
    run(out["forecast"])
    times["pipeline_end_to_end"] = round(time.perf_counter() - t0, 3)
    curated_rows = out["curated"].count()
    forecast_rows = out["forecast"].count()
    sales_rows = load_domain(spark, sf_dir).lineitem.count()

    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "pipeline": {"sales_rows_in": sales_rows, "curated_rows_out": curated_rows,
                     "forecast_rows_out": forecast_rows,
                     "sales_rows_per_sec": round(sales_rows / times["pipeline_end_to_end"], 1)},
        "driver_memory": spark.conf.get("spark.driver.memory"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
