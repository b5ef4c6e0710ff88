"""A third of all line items on one batch key: AQE splits the hot join partition and results stay whole."""
from __future__ import annotations

from perishables.operators import curate
from perishables.session import scratch_path
from perishables.sources.domain_views import load_domain
from tests.conftest import SF_SMALL

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def _skewed_dir(spark) -> str:
    """orders as given; every third line item re-assigned to the smallest order key."""
    out = scratch_path(spark, "skewed")
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    hot = orders.agg({"o_orderkey": "min"}).first()[0]
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    # several files: AQE splits a skewed partition along map-task boundaries, and a
    # single-file table would have a single map task
    li.selectExpr(f"CASE WHEN l_partkey % 3 = 0 THEN CAST({hot} AS BIGINT) ELSE l_orderkey END AS l_orderkey",
                  *[c for c in li.columns if c != "l_orderkey"]).repartition(8).write.parquet(f"{out}/lineitem.parquet")
    orders.write.parquet(f"{out}/orders.parquet")
    return out


def test_hot_batch_is_split_and_result_unchanged(spark):
    src = _skewed_dir(spark)
    expected = sorted(tuple(r) for r in curate.curated_from(load_domain(spark, src)).collect())
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    try:
        for k, v in SKEW_CONF.items():
            spark.conf.set(k, v)
        df = curate.curated_from(load_domain(spark, src))
        got = sorted(tuple(r) for r in df.collect())
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert got == expected
    assert "isSkew=true" in plan or "skew=true" in plan
