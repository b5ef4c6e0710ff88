"""T-rules (null semantics, coercions) on hand-written rows."""
from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables.functions import coerce
from perishables.functions.nulls import clip_lower0, div_or_null, flag, min_with_cap, nan_to_null, sum0
from perishables.functions.scalars import (expiry_date, product_label, risk_score, shelf_life_days,
                                           store_sort_number, store_sort_prefix, weekday_factor)


def test_t1_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-3,), (4,)], "x long")
    assert [r[0] for r in df.select(clip_lower0(F.col("x"))).collect()] == [None, 0, 4]


def test_t2_min_with_cap(spark):
    # null_stock fixture: (current_stock, units, capacity)
    rows = [(None, 5, 3), (10, 5, None), (2, 5, 1), (10, 5, 3)]
    df = spark.createDataFrame(rows, "stock long, units long, cap long")
    avail = clip_lower0(F.col("stock") - F.col("units"))
    gap = clip_lower0(F.col("units") - avail)
    out = [r[0] for r in df.select(min_with_cap(gap, F.col("cap"))).collect()]
    assert out == [None, 0, 1, 0]


def test_t3_null_comparison_is_false(spark):
    df = spark.createDataFrame([(None,), (2,), (9,)], "d int")
    assert [r[0] for r in df.select(flag(F.col("d") <= 3)).collect()] == [0, 1, 0]


def test_t4_sum_of_nulls_is_zero(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 3)], "k int, x long")
    got = {r.k: r.s for r in df.groupBy("k").agg(sum0("x").alias("s")).collect()}
    assert got == {1: 0, 2: 3}


def test_t7_nan_is_null_and_t13_zero_division(spark):
    # nan_values fixture
    df = spark.createDataFrame([(float("nan"), 4), (1.0, 0), (2.0, 4)], "e double, q long")
    out = df.select(div_or_null(nan_to_null(F.col("e")), F.col("q")).alias("r"))
    assert [r.r for r in out.collect()] == [None, None, 0.5]
    assert out.agg(F.avg("r")).first()[0] == 0.5


def test_t8_ids_from_text(spark):
    df = spark.createDataFrame([(" 12 ",), ("3.7",), ("abc",), (None,), ("+5",)], "s string")
    got = [r[0] for r in df.select(coerce.id_expr(F.col("s"), T.StringType())).collect()]
    assert got == [12, None, None, None, 5]


def test_t8_ids_from_double(spark):
    df = spark.createDataFrame([(3.7,), (-3.7,), (float("nan"),), (None,)], "d double")
    got = [r[0] for r in df.select(coerce.id_expr(F.col("d"), T.DoubleType())).collect()]
    assert got == [3, -3, None, None]


def test_b6_little_endian_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"\x01\x02"),), (bytearray(b"\x05"),), (bytearray(b""),), (None,)],
                               "b binary")
    got = [r[0] for r in df.select(coerce.bytes_le_to_long(F.col("b"))).collect()]
    assert got == [513, 5, 0, None]


def test_t9_units(spark):
    df = spark.createDataFrame([("3.7",), ("-2.9",), ("abc",), (None,)], "s string")
    got = [r[0] for r in df.select(coerce.units_expr(F.col("s"), T.StringType())).collect()]
    assert got == [3, -2, 0, 0]


def test_t10_dates(spark):
    df = spark.createDataFrame([("2025-01-03",), ("2025-01-03 10:00",), ("2025",), ("x",), (None,)], "s string")
    got = [r[0] for r in df.select(coerce.date_expr(F.col("s"), T.StringType())).collect()]
    assert got == [dt.date(2025, 1, 3), dt.date(2025, 1, 3), None, None, None]


def test_t12_shelf_null_counts_as_zero(spark):
    df = spark.createDataFrame([(dt.date(2025, 1, 1), None), (dt.date(2025, 1, 1), 3), (None, 3)],
                               "p date, s int")
    got = [r[0] for r in df.select(expiry_date(F.col("p"), F.col("s"))).collect()]
    assert got == [dt.date(2025, 1, 1), dt.date(2025, 1, 4), None]


def test_t15_half_even_shelf_life(spark):
    # base 10 (medium), temperature 42.5 -> -0.5, pH 6.8 -> 0: 9.5 rounds to 10 (even)
    # base 15 (high), temperature 47.5 -> -1.5: 13.5 rounds to 14; low grade at 60C clips to 2
    rows = [("medium", 42.5, 6.8), ("high", 47.5, 7.0), ("low", 60.0, 5.0), ("other", 30.0, 7.0)]
    df = spark.createDataFrame(rows, "g string, t double, ph double")
    got = [r[0] for r in df.select(shelf_life_days(F.col("g"), F.col("t"), F.col("ph"))).collect()]

    def py(g, t, ph):
        base = {"high": 15, "medium": 10, "low": 5}.get(g, 7)
        adj = 0.0
        if t > 40:
            adj -= 0.2 * (t - 40)
        if ph < 6.8:
            adj -= 0.5 * (6.8 - ph)
        return int(min(max(round(base + adj), 2), 20))

    assert got == [py(*r) for r in rows]


def test_weekday_factor_and_risk(spark):
    days = [dt.date(2024, 1, d) for d in range(1, 8)]  # Monday..Sunday
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(weekday_factor(F.col("d"))).collect()] == [1.0, 1.0, 1.0, 1.0, 1.1, 1.1, 1.0]
    df2 = spark.createDataFrame([(0,), (1,), (3,), (4,), (None,)], "x int")
    assert [r[0] for r in df2.select(risk_score(F.col("x"))).collect()] == [2, 2, 1, 0, 0]


def test_natural_store_order(spark):
    stores = ["S1", "S2", "S10", "s3", "north", "A-1"]
    df = spark.createDataFrame([(s,) for s in stores], "s string")
    rows = df.select("s", store_sort_prefix(F.col("s")).alias("p"), store_sort_number(F.col("s")).alias("n")) \
        .orderBy("p", "n").collect()

    def key(s):
        import re
        m = re.match(r"^([A-Za-z]*)(\d+)$", s.strip())
        return (m.group(1).upper(), int(m.group(2))) if m else (s.upper(), 0)

    assert [r.s for r in rows] == sorted(stores, key=key)


def test_product_label(spark):
    df = spark.createDataFrame([(1, "whole milk"), (7, None)], "id long, t string")
    got = [r[0] for r in df.select(product_label(F.col("id"), F.col("t"))).collect()]
    assert got == ["1 • Whole Milk", "7 • Product 7"]


def test_conform_adds_typed_nulls(spark):
    from perishables import schemas
    raw = spark.createDataFrame([(" 12 ", "S1", "2025-01-03", "4")], "`Batch ID` string, Store_ID string, "
                                                                     "sale_date string, Units_Sold string")
    out = coerce.conform(raw, schemas.SALES)
    assert out.schema == schemas.SALES
    r = out.first()
    assert (r.batch_id, r.store_id, r.sale_date, r.units_sold, r.sale_hour) == (12, "S1", dt.date(2025, 1, 3), 4, None)


def test_map_sales_accepts_raw_legacy_text(spark):
    from perishables.operators.curate import daily_sales
    raw = spark.createDataFrame(
        [(" 1 ", "2", "S1", "2025-01-03 10:00", "3.7"), ("1", "2", "S1", "2025-01-03", "-2.9"),
         ("1.5", "2", "S1", "2025-01-03", "4"), ("1", "2", None, "2025-01-03", "4"), ("1", "2", "S2", "x", "1"),
         ("1", "2", "S2", "2025-01-04", "abc")],
        "batch_id string, product_id string, store_id string, ds string, y string")
    got = sorted(tuple(r) for r in daily_sales(raw, null_store="drop").select("batch_id", "store_id", "date", "units_sold").collect())
    assert got == [(1, "S1", dt.date(2025, 1, 3), 1), (1, "S2", dt.date(2025, 1, 4), 0)]
    lit = sorted(tuple(r) for r in daily_sales(raw).select("store_id", "units_sold").collect())
    assert ("None", 4) in lit
