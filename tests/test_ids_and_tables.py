"""Consecutive ids at sizes where ranges merge, the stored-table path, and pruned curated reads."""
from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from perishables.functions import coerce
from perishables.operators import curate
from perishables.sources import incremental, tables


@pytest.mark.parametrize("rows", [0, 150_000, 1_500_000])
@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_ids_are_consecutive(spark, rows, coalesce):
    names = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce, "spark.sql.shuffle.partitions": "200"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        new = spark.range(rows).select(
            F.expr("date_add(date '2020-01-01', cast(id % 3 as int))").alias("d"),  # hot days
            F.expr("(id * 7919) % 10000019").alias("b"), F.concat(F.lit("extra "), "id").alias("extra"))
        got = incremental.assign_ids(new, "n", ["d", "b"])
        r = got.agg(F.count("*").alias("c"), F.countDistinct("n").alias("u"), F.max("n").alias("m"), F.min("n").alias("l"),
                    F.countDistinct("extra").alias("e")).first()
        assert (r["c"], r["u"], r["m"] or 0, r["e"]) == (rows, rows, rows, rows) and (r["l"] or 1) == 1
        if rows == 150_000:
            turned = got.alias("a").join(got.alias("z"), F.col("z.n") == F.col("a.n") + 1) \
                .filter("struct(a.d, a.b) >= struct(z.d, z.b)").count()
            assert turned == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_legacy_rows_survive_the_stored_path(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.createDataFrame([("1", "2", "S1", "2025/01/03", "4.9"), ("1", "2", None, "20250103", "5")],
                          "`Batch ID` string, product_id string, store_id string, ds string, y string").write.parquet(path)
    rows = {r["store_id"]: r for r in curate.map_sales(tables.load_table(spark, path, "sales")).collect()}
    assert set(rows) == {"S1", "None"}
    assert rows["S1"]["date"] == rows["None"]["date"] == dt.date(2025, 1, 3) and rows["S1"]["units_sold"] == 4
    assert (rows["S1"]["sale_hour"], rows["S1"]["promotion_flag"], rows["S1"]["seasonality_factor"]) == (12, 0, 1.0)


def test_missing_columns_and_core_tables_are_errors(spark, tmp_path):
    path = str(tmp_path / "sales")
    spark.createDataFrame([(1, 2)], "batch_id int, product_id int").write.parquet(path)
    with pytest.raises(ValueError, match="missing required columns"):
        tables.load_table(spark, path, "sales")
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        tables.OperationalTables(spark, str(tmp_path / "mistyped"))


def test_fractional_litres_stay(spark, tmp_path):
    path = str(tmp_path / "inventory")
    spark.createDataFrame([(1, 2, 12.7)], "batch_id int, product_id int, initial_stock_liters double").write.parquet(path)
    assert tables.load_table(spark, path, "inventory").first()["initial_stock_liters"] == 12.7


def test_day_texts(spark):
    texts = {"2025-01-03": 3, "2025-1-3": 3, " 2025/01/03 ": 3, "20250103": 3, "2025-01-03 10:00": 3, "2025-01-03T23:00:00+02:00": 3,
             "2025-01-031": None, "2025-01-3x": None, "2025": None, "2025-13-01": None, "x": None, "2025-01/03": None}
    df = spark.createDataFrame([(t,) for t in [*texts, None]], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", coerce.date_expr(F.col("t"), df.schema["t"].dataType).alias("d")).collect()}
    assert {t: d and d.day for t, d in got.items() if t is not None} == texts
    r = coerce.rejected_dates(df, "t").first()
    assert (r["n_values"], r["n_rejected"]) == (len(texts), sum(v is None for v in texts.values()))


def test_bytes_of_every_length(spark):
    rows = [bytes([1] + [0] * n) for n in range(10)] + [b"", None, b"\xff" * 7 + b"\x7f", b"\xff" * 8, b"\xff" * 9, b"\x00" * 20]
    got = [r[0] for r in spark.createDataFrame([(b,) for b in rows], "b binary").select(coerce.bytes_le_to_long(F.col("b"))).collect()]
    assert got == [1] * 10 + [0, None, 2**63 - 1, None, None, 0]


def test_date_bounds_prune_month_folders(spark, tmp_path):
    path = str(tmp_path / "curated")
    rows = spark.range(400).select(F.expr("date_add(date '2024-01-01', cast(id as int))").alias("date"), F.col("id").alias("units_sold"))
    tables.write_curated_sales(rows, path)
    got = tables.read_curated(spark, path, dt.date(2024, 3, 5), dt.date(2024, 4, 2))
    assert sorted(r["date"] for r in got.collect()) == [dt.date(2024, 3, 5) + dt.timedelta(i) for i in range(29)]
    scan = next(x for x in got._jdf.queryExecution().toString().splitlines() if "FileScan" in x)
    assert "month" in scan.split("PartitionFilters: [")[1].split("]")[0] and "month" not in got.columns
    assert tables.read_curated(spark, path).count() == 400
