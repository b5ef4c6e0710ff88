"""Run registered Spark queries and their DuckDB oracles side by side; report mismatches.

Usage: python tests/oracle_check.py <sf_dir> [names...]
"""
from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
import __spark_entry__ as E  # noqa: E402
from perishables.session import build_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    """Engine-neutral value: null-likes -> None, numbers -> int when integral else repr(float)."""
    if v is None or v is pd.NaT or (not isinstance(v, (str, bytes)) and pd.isna(v)):
        return None
    if hasattr(v, "item") and not isinstance(v, (pd.Timestamp,)):
        v = v.item()
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, pd.Timestamp):
        return v.date().isoformat() if v == v.normalize() else v.isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (int, float)) or hasattr(v, "as_tuple"):
        f = float(v)
        return int(f) if f.is_integer() and abs(f) < 2**53 else repr(f)
    return str(v)


def rows(df: pd.DataFrame) -> list:
    cols = sorted(df.columns)
    out = [tuple(norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def main(sf: str, names: list[str]) -> int:
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sql = E.queries(), E.oracle_sql()
    bad = 0
    for n in names or list(qs):
        t0 = time.time()
        try:
            sp = qs[n](spark, sf).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"SPARK-FAIL {n}: {str(e)[:300]}")
            bad += 1
            continue
        if n not in sql:
            print(f"ROWS-ONLY {n}: {len(sp)} rows {time.time() - t0:.1f}s")
            continue
        try:
            dk = con.execute(sql[n]).df()
        except Exception as e:  # noqa: BLE001
            print(f"SQL-FAIL {n}: {str(e)[:400]}")
            bad += 1
            continue
        if sorted(sp.columns) != sorted(dk.columns):
            print(f"COLS {n}: spark={sorted(sp.columns)} duck={sorted(dk.columns)}")
            bad += 1
            continue
        a, b = rows(sp), rows(dk)
        if a == b:
            print(f"MATCH {n}: {len(a)} rows {time.time() - t0:.1f}s")
        else:
            bad += 1
            diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
            print(f"DIFF {n}: spark={len(a)} duck={len(b)} first={diff}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
