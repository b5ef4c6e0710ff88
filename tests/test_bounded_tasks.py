"""What a task of the operational queries takes in stays bounded when the tables grow."""
from __future__ import annotations

import pytest

import __spark_entry__ as E
from perishables import session
from tests.conftest import SF_SMALL

PARTITIONS = "spark.sql.shuffle.partitions"


@pytest.fixture
def settings(spark):
    old = {k: spark.conf.get(k) for k in (*session.TASK_CONF, PARTITIONS)}
    yield spark.conf
    for key, value in old.items():
        spark.conf.set(key, value)


@pytest.mark.parametrize("name", ["curated_sales", "pk_duplicates", "inspection_samples"])
def test_partitions_follow_the_input(spark, settings, monkeypatch, name):
    monkeypatch.setattr(session, "TASK_BYTES", 4096)  # the small tables are many times that
    size = sum(session.input_bytes(spark, f"{SF_SMALL}/{t}.parquet") for t in ("lineitem", "orders"))
    settings.set(PARTITIONS, "8")
    settings.set(session.TASK_CONF[1], "64MB")
    E.queries()[name](spark, SF_SMALL)
    assert size > 8 * 4096 and int(settings.get(PARTITIONS)) == -(-size // 4096)
    assert [settings.get(k) for k in session.TASK_CONF] == ["4096", "4096"]


def test_smaller_tasks_and_more_partitions_stay(spark, settings):
    settings.set(session.TASK_CONF[1], "16k")
    settings.set(PARTITIONS, "211")
    session.bound_tasks(spark, f"{SF_SMALL}/lineitem.parquet", f"{SF_SMALL}/absent.parquet")
    assert settings.get(session.TASK_CONF[1]) == "16k" and settings.get(PARTITIONS) == "211"


@pytest.mark.parametrize("text, size", [("134217728", 1 << 27), ("128MB", 1 << 27), ("64k", 1 << 16), ("1 gb", 1 << 30), ("7b", 7), ("1m", 1 << 20)])
def test_sizes_of_settings(text, size):
    assert session._bytes(text) == size


@pytest.mark.parametrize("name", ["risk_pairs", "batch_drilldown", "product_store_daily", "kpi_sustainability", "curated_join_catalog"])
def test_more_tasks_run_where_the_input_grows(spark, settings, monkeypatch, name):
    def run(group):
        settings.set(PARTITIONS, "4")
        spark.sparkContext.setJobGroup(group, name)
        rows = sorted(map(str, E.queries()[name](spark, SF_SMALL).collect()))
        seen = spark.sparkContext.statusTracker()
        stages = [seen.getStageInfo(s) for j in seen.getJobIdsForGroup(group) for s in seen.getJobInfo(j).stageIds]
        return rows, max(s.numTasks for s in stages if s)

    monkeypatch.setattr(session, "TASK_BYTES", 16 * 1024)
    rows, tasks = run(f"bounded-{name}")
    assert tasks >= -(-session.input_bytes(spark, f"{SF_SMALL}/lineitem.parquet") // (16 * 1024)) > 4
    for key in session.TASK_CONF:
        settings.set(key, "64MB")
    monkeypatch.setattr(E, "bound_tasks", lambda spark, *paths: spark)
    free, few = run(f"free-{name}")
    assert rows == free and few <= 4
