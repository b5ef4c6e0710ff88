"""The registered queries: against DuckDB where there is SQL, else that they give whole results."""
from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from perishables.llm import queries
from tests.conftest import SF_SMALL
from tests.oracle_check import rows

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_and_the_pipeline_are_registered():
    names = set(E.queries())
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, con, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = con.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
