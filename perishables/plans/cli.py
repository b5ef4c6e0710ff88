"""Command line: run the pipeline or the data-quality inspection.

    python -m perishables pipeline --views /data/sf0.1 --out /shared/run1 [--model ets|baseline] [--horizon 30]
                                   [--cores 8000]   # size partitions from the input size
    python -m perishables pipeline --tables /shared/operational --out /shared/run1
    python -m perishables inspect  --views /data/sf0.1 [--show 50]

``--views`` derives the operational tables from TPC-H-style parquet tables;
``--tables`` reads stored operational tables (one parquet dataset per table).
The Spark session comes from the environment (spark-submit / cluster defaults).
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from perishables.operators import quality
from perishables.plans import pipeline
from perishables.session import size_for_input, tune
from perishables.settings import ForecastSettings
from perishables.sources.domain_views import load_domain
from perishables.sources.tables import OperationalTables


def _tables(spark: SparkSession, args: argparse.Namespace):
    return load_domain(spark, args.views) if args.views else OperationalTables(spark, args.tables)


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="perishables")
    sub = ap.add_subparsers(dest="command", required=True)
    for name in ("pipeline", "inspect"):
        p = sub.add_parser(name)
        src = p.add_mutually_exclusive_group(required=True)
        src.add_argument("--views", help="folder with orders/lineitem parquet tables")
        src.add_argument("--tables", help="folder with stored operational tables")
        p.add_argument("--cores", type=int, default=None,
                       help="total executor cores; sizes shuffle partitions and scan splits from the input size")
        if name == "pipeline":
            p.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
            p.add_argument("--model", default="ets", choices=["ets", "baseline"])
            p.add_argument("--horizon", type=int, default=30)
            p.add_argument("--min-history", type=int, default=30)
            p.add_argument("--as-of", type=dt.date.fromisoformat, default=None)
        else:
            p.add_argument("--show", type=int, default=100, help="rows of the report to print")
            p.add_argument("--samples", type=int, default=5, help="rows of each kind of sample in the report")
    args = ap.parse_args(argv)
    spark = tune(SparkSession.builder.appName("perishables").getOrCreate())
    if args.cores:
        conf = size_for_input(spark, args.views or args.tables, args.cores)
        print(f"partition sizing: {conf}")
    tables = _tables(spark, args)
    if args.command == "pipeline":
        settings = ForecastSettings(model=args.model, horizon_days=args.horizon, min_history_days=args.min_history)
        out = pipeline.run_pipeline(spark, tables, args.out, settings, args.as_of)
        print(f"curated rows: {out['curated'].count()}, forecast rows shown: {out['forecast'].count()}, "
              f"written under {args.out}")
    else:
        ops = {k: v for k, v in tables.as_dict().items() if k != "product_catalog"}
        if args.tables:
            stored = {k: tables.stored_rows(k) for k in ops}
            quality.rejected_dates({k: df for k, df in stored.items() if df is not None}).show(args.show, truncate=False)
        quality.quality_report(ops, args.samples).orderBy("check_name", "table_name", "column_name", "item") \
            .show(args.show, truncate=False)
    return 0
