"""Scans and sinks of operational and curated tables.

Operational tables are stored as parquet datasets named after the logical
table.  Every scan normalises names and conforms to the canonical schema, so
downstream code can rely on one typed contract (absent columns become nulls).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from perishables import schemas
from perishables.functions.coerce import (add_missing_columns, conform, normalize_column_names,
                                          rename_first_present, require_columns)
from perishables.functions.nulls import clip_range

# --- fixed values (the quality CSV's expected header and its known misspelling) ---
QUALITY_CSV_COLUMNS = ["pH", "Temperature", "Taste", "Odor", "Fat", "Turbidity", "Colour", "Grade"]
QUALITY_CSV_RENAMES = {"Temprature": "Temperature"}
# legacy names by table and column, in order of precedence; defaults of columns that are absent; needed columns
LEGACY_NAMES = {
    "sales": {"sale_date": ["sale_date", "ds", "date"], "units_sold": ["units", "y", "units_sold"]},
    "logistics": {"transport_date": ["transport_date", "date"]},
}
ABSENT_DEFAULTS = {"sales": {"sale_hour": 12, "promotion_flag": 0, "seasonality_factor": 1.0}}
NEEDED = {
    "sales": ["batch_id", "product_id", "store_id", "sale_date", "units_sold"],
    "logistics": ["batch_id", "product_id", "transport_date"],
    "production": ["batch_id", "product_id"],
}
# ----------------------------------------------------------------------------------


def canonical_names(df: DataFrame, table: str) -> DataFrame:
    """Normalised names, legacy names mapped, absent optional columns with their defaults,
    and an error that names what is missing when a needed column is absent."""
    df = normalize_column_names(df)
    for target, candidates in LEGACY_NAMES.get(table, {}).items():
        found = next((c for c in candidates if c in df.columns), None)
        if found not in (None, target) and target in df.columns:
            df = df.drop(target)  # the legacy name takes precedence
        df = rename_first_present(df, target, candidates)
    return add_missing_columns(require_columns(df, NEEDED.get(table, [])), ABSENT_DEFAULTS.get(table, {}))


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def load_table(spark: SparkSession, path: str, table: str, *, optional: bool = False) -> DataFrame:
    """A1: scan a parquet table, map its names (see ``canonical_names``), conform to its canonical schema.

    A missing dataset raises unless ``optional``; then a typed empty frame is returned.  Anything else that
    is wrong with it (rights, broken files) raises in any case.
    """
    schema = schemas.TABLES[table]
    try:
        raw = spark.read.parquet(path)
    except AnalysisException as missing:
        if not optional or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_frame(spark, schema)
    return conform(canonical_names(raw, table), schema)


def load_quality_csv(spark: SparkSession, path: str) -> DataFrame:
    """A2: quality CSV with the header typo fixed and the required columns checked.

    Values are read as text and parsed with the package's coercion rules.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    for old, new in QUALITY_CSV_RENAMES.items():
        if old in raw.columns and new not in raw.columns:
            raw = raw.withColumnRenamed(old, new)
    missing = [c for c in QUALITY_CSV_COLUMNS if c not in raw.columns]
    if missing:
        raise ValueError(f"quality CSV missing columns: {missing}")
    return conform(normalize_column_names(raw), schemas.QUALITY)


def clean_quality(quality: DataFrame) -> DataFrame:
    """Clip 0/1 flags and colour, lower/trim grade, drop rows lacking pH/temperature/grade.

    Flags and colour stay null when null (clip keeps null); rows are then kept
    only with pH, temperature and grade present.
    """
    q = quality.select(
        "batch_id", "ph", "temperature",
        *[clip_range(F.col(c), 0, 1).cast("int").alias(c) for c in ("taste", "odor", "fat", "turbidity")],
        clip_range(F.col("colour"), 0, 255).cast("int").alias("colour"),
        F.trim(F.lower(F.col("grade"))).alias("grade"),
    )
    return q.dropna(subset=["ph", "temperature", "grade"])


def read_curated(spark: SparkSession, path: str, date_from: dt.date | None = None,
                 date_to: dt.date | None = None) -> DataFrame:
    """A3: scan a curated parquet dataset (schema from the files), without its month folders' column.

    Bounds on the date (inclusive) also bound the month, so whole folders are pruned.
    """
    df = spark.read.parquet(path)
    for bound, keep in ((date_from, lambda c, v: c >= v), (date_to, lambda c, v: c <= v)):
        if bound is not None:
            df = df.filter(keep(F.col("date"), F.lit(bound)))
            if "month" in df.columns:
                df = df.filter(keep(F.col("month"), F.lit(f"{bound:%Y-%m}")))
    return df.drop("month")


def stored_scan(spark: SparkSession, path: str) -> DataFrame:
    """A stored Parquet table as a V2 scan: counts, minima and maxima of whole columns then come from the files' footers.

    For such questions only; other readers keep the session's usual scan.
    """
    key = "spark.sql.sources.useV1SourceList"
    old = spark.conf.get(key)
    try:
        spark.conf.set(key, ",".join(s for s in old.split(",") if s.strip() != "parquet"))
        return spark.read.parquet(path)   # resolved here, under this setting
    finally:
        spark.conf.set(key, old)


def write_table(df: DataFrame, path: str, *, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Parquet sink; ``mode="append"`` adds a batch of rows."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, name: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A5: store a table dealt into ``buckets`` by ``keys`` and sorted in them, as the catalog's table ``name``; returns its scan.

    Tables with as many buckets by the same keys join and group on them (or on more columns) without an exchange, each time they are
    read.  A bucket is one task, which nothing can split: for keys that may hold a large share of the rows keep plain tables, whose
    joins AQE splits.
    """
    df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return df.sparkSession.table(name)


def write_curated_sales(curated: DataFrame, path: str) -> None:
    """Curated sales partitioned by month, so that ``read_curated`` with date bounds prunes whole folders.

    A ``rebalance`` by month routes each month to its own tasks, so a task
    writes one month folder (not tasks x months small files); AQE splits months
    larger than the advisory partition size and merges small ones.  Unlike a
    range repartition it needs no sampling pass over the input.
    """
    monthly = curated.withColumn("month", F.date_format("date", "yyyy-MM")).hint("rebalance", "month")
    write_table(monthly, path, partition_by=["month"])


class OperationalTables:
    """Stored operational tables under ``root/<name>`` (parquet), each conformed on read.

    Same attributes as the fixture views (``production``, ``quality``, ...).  An
    absent core table is an error (as behind a mistyped path); any other absent
    one is a typed empty frame, so every operator still runs.
    """

    NAMES = ("production", "quality", "inventory", "sales", "factory", "logistics", "product_catalog")
    CORE = ("production", "inventory", "sales")

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        for name in self.NAMES:
            setattr(self, name, load_table(spark, f"{self.root}/{name}", name,
                                          optional=name not in self.CORE))

    def stored_rows(self, name: str) -> DataFrame | None:
        """The rows under canonical names, before their values are coerced; None where the table is not stored."""
        path = f"{self.root}/{name}"
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return None
        return canonical_names(self.spark.read.parquet(path), name)

    def as_dict(self) -> dict[str, DataFrame]:
        return {k: getattr(self, k) for k in self.NAMES}
