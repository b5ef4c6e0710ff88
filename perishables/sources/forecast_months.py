"""Forecast table in month folders: a keyed upsert touches the months that its rows fall into (A8), and a stored
table of the legacy schema is dropped and made anew (A9).

New rows name the months; only those folders are read, merged with them and written back by dynamic partition overwrite, so the
work grows with what changed and untouched files keep their names.  The merged months are staged first: the write reads
nothing that it replaces, and a run that failed half-way can be run again.  One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables import schemas
from perishables.operators.forecast import upsert
from perishables.session import scratch_path

MONTH = "month"
FIELDS = [f.name for f in schemas.FORECAST.fields]


def stored_columns(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Columns and types of the stored table, or None where there is none yet."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(where) or not list(fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where, "[!_.]*"))):
        return None
    return {name.lower(): kind for name, kind in spark.read.parquet(path).dtypes}


def needs_recreation(columns: dict[str, str] | None) -> bool:
    """Whether a stored schema is not that of a forecast per product, store and day (the legacy one is per batch)."""
    return columns is not None and ("batch_id" in columns or not set(schemas.FORECAST_KEYS) <= set(columns) or MONTH not in columns)


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """The stored forecast; a missing or legacy table is empty.  Columns that an older table lacks are null."""
    columns = stored_columns(spark, path)
    if columns is None or needs_recreation(columns):
        return spark.createDataFrame([], schemas.FORECAST)
    stored = spark.read.parquet(path)
    return stored.select(*((F.col(f.name) if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.FORECAST.fields))


def upsert_months(spark: SparkSession, path: str, new: DataFrame) -> list[str]:
    """Upsert ``new`` by (product, store, day); returns the months written.  Rows without a day are not stored, as they have no key."""
    month = F.date_format("forecast_date", "yyyy-MM")
    new = new.select(*FIELDS).dropna(subset=["forecast_date"])
    staged_new = scratch_path(spark, "forecast-new")
    new.withColumn(MONTH, month).write.parquet(staged_new)
    new = spark.read.parquet(staged_new)
    months = sorted(r[MONTH] for r in new.select(MONTH).distinct().collect())   # as many as the horizon spans
    if not months:
        return []
    columns = stored_columns(spark, path)
    fresh = columns is None or needs_recreation(columns)
    merged = new.select(*FIELDS)
    if not fresh:
        kept = spark.read.parquet(path).filter(F.col(MONTH).isin(months))   # these folders only
        merged = upsert(kept.select(*((F.col(f) if f in columns else F.lit(None)).cast(schemas.FORECAST[f].dataType).alias(f) for f in FIELDS)), merged)
    else:
        merged = upsert(spark.createDataFrame([], schemas.FORECAST), merged)   # one row per key
    staged = scratch_path(spark, "forecast-months")
    merged.withColumn(MONTH, month).write.parquet(staged)
    rows = spark.read.parquet(staged).hint("rebalance", MONTH)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "static" if fresh else "dynamic").partitionBy(MONTH).parquet(path)
    return months
