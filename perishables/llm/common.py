"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.session import scratch_dir, scratch_path

ARROW_ROWS = 256                 # rows of a batch handed to Python; whole texts are in it
ARROW_BYTES = 16 * 1024 * 1024   # and its bytes, for long texts
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# every ASCII byte that is no letter or digit becomes a blank
_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
WORD_TABLE = bytes(c if c in _KEEP or c >= 0x80 else 0x20 for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the batches that Arrow hands to Python, as one row holds a whole text."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared scratch folder and read it back: later steps
    start from files that survive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_and_free(df: DataFrame, name: str) -> DataFrame:
    """``store``, after which Spark deletes the shuffle files of the write at once, not when the driver happens to collect garbage."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLES)
    conf.set(FREE_SHUFFLES, "true")
    try:
        return store(df, name)
    finally:
        conf.set(FREE_SHUFFLES, before)


def discard(spark: SparkSession, folder: str) -> None:
    """Delete the tables stored as ``folder/...``, once no later step reads them."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark).rstrip('/')}/{folder}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def fresh(columns: list[str], *names: str) -> list[str]:
    """The names, lengthened until none clashes (case-insensitively) with ``columns``."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def utf8(column: str) -> Column:
    """Text as UTF-8 bytes; null stays null."""
    return F.col(f"`{column}`").cast("string").cast("binary")


def plain_words(raw: bytes | None) -> list[bytes]:
    """ASCII-lower-cased runs of letters, digits and non-ASCII characters of a UTF-8 text."""
    return raw.translate(WORD_TABLE).lower().split() if raw else []


def with_text(changed: DataFrame, docs: DataFrame, text_col: str, touched: Column) -> DataFrame:
    """The columns of ``docs`` from ``changed`` (``doc``: the old row, ``body``: the new text);
    ``n_chars``, where there is one, follows the text of touched rows."""
    def column(name: str) -> Column:
        old = F.col(f"doc.`{name}`")
        if name == text_col:
            return F.col("body").cast(docs.schema[name].dataType).alias(name)
        if name == "n_chars":
            return F.when(touched, F.char_length("body").cast(docs.schema[name].dataType)).otherwise(old).alias(name)
        return old.alias(name)

    return changed.select(*map(column, docs.columns))
