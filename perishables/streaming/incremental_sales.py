"""Structured Streaming incremental loads (M1, M2).

M1: new sales rows arrive as files; a stateful streaming aggregation keeps the
daily per-(batch, product, store, date) aggregate (sum, max and the running
(sum, count) of the mean), and every micro-batch emits the updated groups
("update" mode).  ``foreachBatch`` writes them to a parquet change log: one folder
per epoch, so a replayed epoch rewrites the same folder (idempotent) and a micro-batch
costs what it changed.  The sink read back equals the batch E1 result.  Late rows for an old day update that day's aggregate; with a
watermark, state older than the watermark is dropped and rows arriving later
than it are ignored (bounded state at scale).

M2: after a load, the forecast is rerun for the series the batch touched.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from perishables.operators.curate import SALES_KEYS, daily_sales_aggs, map_sales
from perishables.session import scratch_path


class VersionedSink:
    """Parquet change log: ``epoch=<n>`` holds the groups that micro-batch n changed, with their new values.

    A micro-batch writes what it changed, not the table.  Readers take each key's row of the highest epoch.
    ``compact`` merges everything up to now into ``base=<n>``, after which readers start there, and
    ``expire`` removes what lies before it.  Only complete folders (``_SUCCESS``) count.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str] = SALES_KEYS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.keys = list(keys)

    def _folders(self, kind: str) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        found = []
        for st in fs.listStatus(path):
            name, _, number = st.getPath().getName().partition("=")
            if name == kind and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                found.append(int(number))
        return sorted(found)

    def _path(self, kind: str, number: int) -> str:
        return f"{self.root}/{kind}={number:012d}"

    def versions(self) -> list[int]:
        """Epochs that readers still merge."""
        base = max(self._folders("base"), default=-1)
        return [n for n in self._folders("epoch") if n > base]

    def read(self, schema=None) -> DataFrame | None:
        bases, epochs = self._folders("base"), self.versions()
        parts = [("base", bases[-1])] if bases else []
        parts += [("epoch", n) for n in epochs]
        if not parts:
            return None if schema is None else self.spark.createDataFrame([], schema)
        frames = [self.spark.read.parquet(self._path(*part)) for part in parts]
        if len(frames) == 1:
            return frames[0]
        columns = frames[0].columns
        rest = F.struct(*(F.col(c) for c in columns if c not in self.keys))
        every = reduce(DataFrame.unionByName, [f.withColumn("_order", F.lit(i)) for i, f in enumerate(frames)])
        last = every.groupBy(*self.keys).agg(F.max_by(rest, "_order").alias("_row"))
        return last.select(*(F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in columns))

    def upsert_batch(self, batch: DataFrame, epoch_id: int) -> None:
        """A replayed epoch overwrites its own folder."""
        batch.write.mode("overwrite").parquet(self._path("epoch", epoch_id))

    def compact(self) -> None:
        """Write the current table as a new base."""
        epochs = self.versions()
        if epochs:
            self.read().write.mode("overwrite").parquet(self._path("base", epochs[-1]))

    def expire(self) -> None:
        """Remove epochs and bases that the newest base has replaced (no reader may still be on them)."""
        jvm = self.spark.sparkContext._jvm
        base = max(self._folders("base"), default=-1)
        for kind, limit in (("epoch", base + 1), ("base", base)):
            for number in self._folders(kind):
                if number < limit:
                    path = jvm.org.apache.hadoop.fs.Path(self._path(kind, number))
                    path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def daily_sales_updates(sales_stream: DataFrame, watermark_delay: str | None = None) -> DataFrame:
    """Streaming E1 on a streaming sales frame.

    With ``watermark_delay`` the sale day (as a timestamp) is the event time
    and part of the group key, so state of days older than the watermark is
    evicted.
    """
    rows = map_sales(sales_stream)
    keys = list(SALES_KEYS)
    if watermark_delay:
        rows = rows.withColumn("day_ts", F.col("date").cast("timestamp")).withWatermark("day_ts", watermark_delay)
        keys.append("day_ts")
    return rows.groupBy(*keys).agg(*daily_sales_aggs()).drop("day_ts")


def run_daily_sales_stream(spark: SparkSession, sales_stream: DataFrame, sink_root: str,
                           checkpoint: str | None = None, *, watermark_delay: str | None = None,
                           on_batch: Callable[[DataFrame, int], None] | None = None) -> VersionedSink:
    """Start M1 with ``availableNow`` (process what is there, then stop) and wait for it.

    Without ``watermark_delay`` the state keeps every group for ever, so that rows of any age still count; set it
    where late rows of that age may be ignored.  ``session.tune`` chooses the state store on local disk.
    """
    sink = VersionedSink(spark, sink_root)
    updates = daily_sales_updates(sales_stream, watermark_delay)

    def write(batch: DataFrame, epoch_id: int) -> None:
        sink.upsert_batch(batch, epoch_id)
        if on_batch is not None:
            on_batch(batch, epoch_id)

    query = (updates.writeStream.outputMode("update")
             .option("checkpointLocation", checkpoint or scratch_path(spark, "daily-sales-ckpt"))
             .foreachBatch(write).trigger(availableNow=True).start())
    query.awaitTermination()
    return sink


def touched_series(batch: DataFrame) -> DataFrame:
    """M2: the (product, store) series a micro-batch changed."""
    return batch.select("product_id", "store_id").dropna().distinct()


def forecast_touched_series(batch: DataFrame, curated: DataFrame, store, settings) -> int:
    """M2: rerun the forecast for the series a micro-batch touched and upsert the new rows.

    ``curated`` is the current curated fact (e.g. the curated table read back);
    it is restricted to the touched series with a semi join, so the work per
    micro-batch is proportional to the series it changed.  Returns the new
    forecast version.
    """
    from perishables.operators import forecast

    scope = curated.join(touched_series(batch), ["product_id", "store_id"], "left_semi")
    new_rows = forecast.forecast_rows(scope, store.read(), settings)
    return store.upsert(new_rows)
