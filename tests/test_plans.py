"""Plan shape guards (scale mode: no broadcasts): exchange counts, single scans, no cartesian products."""
from __future__ import annotations

import re

import pytest

from perishables.plans.registered import QUERIES
from tests.conftest import SF_SMALL

SCALE_CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def _final_plan(spark, name: str) -> str:
    old = {k: spark.conf.get(k, None) for k in SCALE_CONF}
    try:
        for k, v in SCALE_CONF.items():
            spark.conf.set(k, v)
        df = QUERIES[name](spark, SF_SMALL)
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _exchanges(plan: str) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan))


def test_curated_chain_shuffles(spark):
    plan = _final_plan(spark, "curated_sales")
    # lineitem+orders (sales), lineitem+orders (logistics), catalog (distinct, then its join), inventory, factory
    assert _exchanges(plan) <= 8
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_forecast_scans_line_items_once(spark):
    plan = _final_plan(spark, "holt_winters")
    assert len(re.findall(r"FileScan parquet \[[^\]]*l_orderkey", plan)) == 1
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize("name", ["kpi_overview", "projected_stock", "risk_heatmap", "join_health",
                                  "orphan_checks", "assign_ids", "forecast_fallback", "new_batches"])
def test_no_cartesian_products(spark, name):
    plan = _final_plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
