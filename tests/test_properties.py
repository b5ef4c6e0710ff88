"""Property tests: Spark null rules and coercions against a plain-Python model of the pandas semantics."""
from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables.functions import coerce
from perishables.functions.nulls import clip_lower0, flag, min_with_cap

maybe_int = st.one_of(st.none(), st.integers(min_value=-10**6, max_value=10**6))
SETTINGS = settings(max_examples=15, deadline=None)


def _clip0(x):
    return None if x is None else max(x, 0)


@SETTINGS
@given(st.lists(st.tuples(maybe_int, maybe_int, maybe_int), min_size=1, max_size=20))
def test_stock_gap_and_cap_rules(spark, rows):
    df = spark.createDataFrame(rows, "stock long, units long, cap long")
    avail = clip_lower0(F.col("stock") - F.col("units"))
    gap = clip_lower0(F.col("units") - avail)
    out = df.select(avail.alias("a"), min_with_cap(gap, F.col("cap")).alias("s"),
                    flag(avail > 0).alias("f")).collect()
    for (stock, units, cap), r in zip(rows, out):
        a = None if stock is None or units is None else _clip0(stock - units)
        g = None if units is None or a is None else _clip0(units - a)
        s = g if cap is None or g is None else min(g, cap)
        assert (r.a, r.s, r.f) == (a, s, int(a is not None and a > 0))


ids = st.one_of(st.none(), st.integers(-10**9, 10**9).map(str),
                st.integers(0, 10**6).map(lambda i: f" {i} "),
                st.integers(0, 10**6).map(lambda i: f"{i}.5"), st.text(max_size=4))


@SETTINGS
@given(st.lists(ids, min_size=1, max_size=20))
def test_id_text_rule(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(coerce.id_expr(F.col("s"), T.StringType())).collect()]

    def model(v):
        if v is None:
            return None
        t = v.strip(" ")
        body = t[1:] if t[:1] in "+-" else t
        return int(t) if body.isascii() and body.isdigit() else None

    assert got == [model(v) for v in values]


@SETTINGS
@given(st.lists(st.binary(max_size=7), min_size=1, max_size=10))
def test_little_endian_bytes(spark, values):
    df = spark.createDataFrame([(bytearray(v),) for v in values], "b binary")
    got = [r[0] for r in df.select(coerce.bytes_le_to_long(F.col("b"))).collect()]
    assert got == [int.from_bytes(v, "little", signed=False) for v in values]
