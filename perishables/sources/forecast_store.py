"""Forecast table on plain parquet with keyed upserts.

No table format with MERGE is available, so the table is a folder of
immutable versions ``<root>/version=<n>``.  A write reads the current version,
applies the upsert and writes version n+1; readers keep reading the version
they started with, and a failed write leaves no ``_SUCCESS`` marker, so it is
never picked up.  One writer at a time is assumed.  Listing uses the Hadoop
FileSystem of the session, so the root may be any cluster file system.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables import schemas
from perishables.functions.scalars import iso_date_text
from perishables.operators.forecast import upsert

EXPORT_FIELDS = ["product_id", "store_id", "forecast_date", "forecasted_sales", "predicted_waste",
                 "suggested_production", "expiration_risk", "predicted_logistics_cost"]
LEGACY_COLUMN = "batch_id"


def _fs(spark: SparkSession, root: str):
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path, jvm


class ForecastStore:
    """Versioned forecast table rooted at ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def versions(self) -> list[int]:
        fs, path, jvm = _fs(self.spark, self.root)
        if not fs.exists(path):
            return []
        out = []
        for status in fs.listStatus(path):
            name = status.getPath().getName()
            if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
        return sorted(out)

    def _path(self, version: int) -> str:
        return f"{self.root}/version={version:06d}"

    def read(self) -> DataFrame:
        """The current version; a legacy batch-level schema counts as no table."""
        versions = self.versions()
        if not versions:
            return self.spark.createDataFrame([], schemas.FORECAST)
        df = self.spark.read.parquet(self._path(versions[-1]))
        if LEGACY_COLUMN in [c.lower() for c in df.columns]:
            return self.spark.createDataFrame([], schemas.FORECAST)
        return df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.FORECAST.fields])

    def upsert(self, new: DataFrame) -> int:
        """Write ``current upserted with new`` as the next version; returns the version."""
        versions = self.versions()
        nxt = (versions[-1] + 1) if versions else 1
        upsert(self.read(), new.select(*[f.name for f in schemas.FORECAST.fields])) \
            .write.mode("overwrite").parquet(self._path(nxt))
        return nxt

    def expire(self, keep: int = 2) -> list[int]:
        """Remove all but the newest ``keep`` versions (at least one stays); returns what was removed."""
        gone = self.versions()[:-max(1, keep)]
        for version in gone:
            fs, path, _ = _fs(self.spark, self._path(version))
            fs.delete(path, True)
        return gone


def export_rows(forecast: DataFrame) -> DataFrame:
    """The eight dashboard fields, ISO date text, null numbers -> 0."""
    return forecast.select(
        F.col("product_id").cast("bigint").alias("product_id"),
        F.col("store_id").cast("string").alias("store_id"),
        iso_date_text(F.col("forecast_date")).alias("forecast_date"),
        *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
          for c in ("forecasted_sales", "predicted_waste", "suggested_production")],
        F.coalesce(F.col("expiration_risk").cast("int"), F.lit(0)).alias("expiration_risk"),
        F.coalesce(F.col("predicted_logistics_cost").cast("double"), F.lit(0.0)).alias("predicted_logistics_cost"),
    )


def write_json(forecast: DataFrame, path: str) -> None:
    """A7 sink: JSON lines (one object per row, split across tasks)."""
    export_rows(forecast).write.mode("overwrite").json(path)


JSON_SCHEMA = ("product_id bigint, store_id string, forecast_date string, forecasted_sales double, "
               "predicted_waste double, suggested_production double, expiration_risk int, "
               "predicted_logistics_cost double")


def read_json(spark: SparkSession, path: str, *, multi_line: bool = False) -> DataFrame:
    """A4: forecast JSON (lines, or one array with ``multi_line``); bad dates dropped."""
    df = spark.read.schema(JSON_SCHEMA).option("multiLine", multi_line).json(path)
    df = df.withColumn("forecast_date", F.trim(F.col("forecast_date")).try_cast("date"))
    return df.dropna(subset=["forecast_date"])


def fallback_window(stored: DataFrame, horizon_days: int, as_of: dt.date | str) -> DataFrame:
    """Stored rows to show when a run produced none.

    Rows on or after ``as_of`` first: from the first such date through
    ``horizon_days - 1`` days later.  With none, the last ``horizon_days`` days
    up to the latest stored date.  ``as_of`` is a parameter (not today).
    """
    as_of = F.lit(as_of).cast("date")
    rows = stored.dropna(subset=["forecast_date"])
    bounds = rows.agg(F.struct(F.min(F.when(F.col("forecast_date") >= as_of, F.col("forecast_date"))).alias("first"),
                               F.max("forecast_date").alias("last")).alias("b"))
    bound = bounds.scalar()
    first_future, last = bound["first"], bound["last"]
    future_window = F.col("forecast_date").between(first_future, F.date_add(first_future, horizon_days - 1))
    past_window = F.col("forecast_date").between(F.date_sub(last, horizon_days - 1), last)
    return rows.filter(F.when(first_future.isNotNull(), future_window).otherwise(past_window))
