"""Every registered query against its DuckDB oracle (or rows-only) on the smallest data set."""
from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as E
from perishables.plans.registered import QUERIES as CORE
from tests.conftest import SF_SMALL
from tests.oracle_check import TABLES, rows

# the training-data queries have tests of their own
QUERIES = {k: v for k, v in E.queries().items() if k in CORE}
SQL = {k: v for k, v in E.oracle_sql().items() if k in CORE}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_oracle_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) - len(SQL) <= 4


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert len(df.columns) == 30 and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    if name not in SQL:
        assert len(got.columns) > 0
        return
    want = con.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
