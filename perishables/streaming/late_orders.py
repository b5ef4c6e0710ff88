"""M1 with both sides as streams: line items wait for orders that are recorded after them.

Lines and orders each arrive with the time at which they were recorded, and are joined as streams on the order key within ``gap`` of each
other.  Either side is kept in the state store until the watermark shows that no partner can come any more: the later of the two sides'
times minus ``delay`` decides, and the slower side's watermark counts, so an order that lags a load behind its lines still finds
them, and state does not grow with the table.  A line leaves at once when its order is there; a line whose order never comes leaves with
null order columns once the watermark has passed (an orphan, which E1 drops and ``orphan_lines`` counts).  The file sink is
exactly-once, so the daily aggregation over it equals the batch one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from perishables.session import scratch_path

DELAY, GAP = "15 days", "10 days"
RETAINED = "2"  # batches whose state stays on disk: a restart needs the last one


def joined_lines(lines: DataFrame, orders: DataFrame, delay: str = DELAY, gap: str = GAP) -> DataFrame:
    """Every line with its order's columns; ``recorded`` is the time of both, kept from the line."""
    left = lines.withColumn("recorded", F.col("recorded").cast("timestamp")).withWatermark("recorded", delay)
    right = orders.withColumn("order_recorded", F.col("recorded").cast("timestamp")).drop("recorded").withWatermark("order_recorded", delay)
    near = F.expr(f"l_orderkey = o_orderkey AND order_recorded >= recorded - INTERVAL {gap} AND order_recorded <= recorded + INTERVAL {gap}")
    return left.join(right, near, "left_outer").drop("order_recorded")


def run_sales_join(spark: SparkSession, lines: DataFrame, orders: DataFrame, sink: str, checkpoint: str | None = None,
                   delay: str = DELAY, gap: str = GAP) -> StreamingQuery:
    """Join what is there (``availableNow``) into the Parquet folder ``sink``, then stop; the ended query tells its state's size."""
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", RETAINED)
    query = (joined_lines(lines, orders, delay, gap).writeStream.format("parquet").outputMode("append").option("path", sink)
             .option("checkpointLocation", checkpoint or scratch_path(spark, "late-orders-ckpt")).trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def orphan_lines(joined: DataFrame) -> DataFrame:
    """Lines whose order did not come within the gap."""
    return joined.filter(F.col("o_orderkey").isNull())
