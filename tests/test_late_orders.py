"""Lines and orders as two streams: late partners, orphans and the state's size."""
from __future__ import annotations

import datetime as dt

from perishables.operators import curate
from perishables.session import scratch_path
from perishables.sources import domain_views
from perishables.streaming import late_orders as L

START = dt.datetime(2025, 1, 1)
LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
         "l_returnflag string, recorded timestamp")
ORDERS = "o_orderkey long, o_custkey long, o_orderdate timestamp, recorded timestamp"


def at(day):
    return START + dt.timedelta(day)


def line(order, day, number=1):
    return (order, order * 3, order, number, 5.0, 0.0, 0.0, "R", at(day))


def order(key, day):
    return (key, key, at(0), at(day))


def test_late_orders_find_their_lines_and_state_falls(spark):
    paths = {n: scratch_path(spark, f"test-late-orders-{n}") for n in ("lines", "orders", "state", "sink")}
    loads = [
        ([line(k, k) for k in range(1, 40)] + [line(900, 5), line(901, 39)], [order(k, k) for k in range(1, 36)]),
        # 36..39 come a load after their lines, 40..44 before; 901 comes too late, 900 never
        ([line(k, 45) for k in range(40, 60)] + [line(k, k + 6, 2) for k in range(34, 40)],
         [order(k, k + 6) for k in range(36, 40)] + [order(k, 44) for k in range(40, 60)]),
        ([line(k, 200) for k in range(60, 63)], [order(901, 80)] + [order(k, 201) for k in range(60, 63)]),
        ([line(k, 400) for k in range(63, 65)], [order(k, 400) for k in range(63, 65)]),
    ]
    sizes = []
    for lines, orders in loads:
        spark.createDataFrame(lines, LINES).write.mode("append").parquet(paths["lines"])
        spark.createDataFrame(orders, ORDERS).write.mode("append").parquet(paths["orders"])
        query = L.run_sales_join(spark, spark.readStream.schema(LINES).parquet(paths["lines"]),
                                 spark.readStream.schema(ORDERS).parquet(paths["orders"]), paths["sink"], paths["state"])
        sizes.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    found = spark.read.parquet(paths["sink"])
    got = sorted((r["l_orderkey"], r["l_linenumber"], r["o_orderkey"]) for r in found.filter("o_orderkey IS NOT NULL").collect())
    assert got == sorted((r[0], r[3], r[0]) for lines, _ in loads for r in lines if r[0] < 900)
    assert sorted(r["l_orderkey"] for r in L.orphan_lines(found).collect()) == [900, 901]
    # what the watermark has passed is forgotten: the state holds the last loads, not the table
    assert sizes[-1] < 12 < sizes[0]
    every = [r for lines, _ in loads for r in lines]
    batch = domain_views.sales(spark.createDataFrame(every, LINES), spark.createDataFrame([r for _, orders in loads for r in orders if r[0] < 900], ORDERS))
    assert sorted(curate.daily_sales(domain_views.sales_of(found)).collect()) == sorted(curate.daily_sales(batch).collect())


def test_only_what_sales_are_made_of_goes_through_the_state(spark):
    lines = spark.createDataFrame([(1, 2, 3, 1, 5.0, 9.5, 0.0, 0.0, "R", "F")],
                                  LINES.replace("l_discount", "l_extendedprice double, l_discount").replace("recorded timestamp", "l_linestatus string"))
    orders = spark.createDataFrame([(1, 2, "O", 9.5, at(0))], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp")
    kept = domain_views.sales_columns(lines), domain_views.sales_columns(orders)
    assert not {"l_extendedprice", "l_linestatus", "o_orderstatus", "o_totalprice"} & {c for df in kept for c in df.columns}
    joined = kept[0].join(kept[1], kept[0].l_orderkey == kept[1].o_orderkey)
    assert domain_views.sales_of(joined).collect() == domain_views.sales(lines, orders).collect() != []
