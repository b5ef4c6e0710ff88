"""Type coercions (T6-T12) and column-name handling.

Every parse uses ``try_cast`` (ANSI mode raises on bad text) and dispatches on
the input column's declared type, which is known on the driver from the schema.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables.functions.nulls import nan_to_null

# a day, then the end, a blank or a time; dashes or slashes
DAY_TEXT = r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})(?:$|[ T].*$)"
COMPACT_DAY_TEXT = r"^(\d{4})(\d{2})(\d{2})$"
# a month's name, day and year; or month, day and year in figures (the month first)
NAMED_DAY_TEXT = r"^([A-Za-z]{3})[a-z]* (\d{1,2}),? (\d{4})$"
MONTH_FIRST_TEXT = r"^(\d{1,2})([-/])(\d{1,2})\2(\d{4})$"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
ISO_DATE_FULL = r"^\d{4}-\d{2}-\d{2}$"


def normalize_column_names(df: DataFrame) -> DataFrame:
    """B1: strip, lower-case and replace spaces with underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def rename_first_present(df: DataFrame, target: str, candidates: Iterable[str]) -> DataFrame:
    """B2: rename the first present candidate to ``target`` (precedence = order)."""
    for name in candidates:
        if name in df.columns:
            return df if name == target else df.withColumnRenamed(name, target)
    return df


def add_missing_columns(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add absent optional columns with a literal default."""
    missing = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    return df.withColumns(missing) if missing else df


def require_columns(df: DataFrame, required: Iterable[str], on_missing: str = "raise") -> DataFrame | None:
    """Guard on required columns; ``on_missing="empty"`` returns None like an empty result."""
    missing = [c for c in required if c not in df.columns]
    if not missing:
        return df
    if on_missing == "empty":
        return None
    raise ValueError(f"missing required columns: {missing}; found {df.columns}")


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def bytes_le_to_long(b: Column) -> Column:
    """Little-endian unsigned bytes to an integer (empty bytes -> 0; beyond a signed 64-bit number -> null)."""
    hex_le = F.array_join(
        F.reverse(F.transform(F.sequence(F.lit(1), F.length(b)), lambda i: F.hex(F.substring(b, i, 1)))), "")
    digits = F.regexp_replace(hex_le, "^0+(?=.)", "")
    value = F.when(F.length(digits) <= 16, F.conv(F.substring(digits, 1, 16), 16, 10).try_cast("bigint"))
    return F.when(b.isNull(), F.lit(None).cast("bigint")).when(F.length(b) == 0, F.lit(0).cast("bigint")) \
        .otherwise(value)


def id_expr(c: Column, dtype: T.DataType) -> Column:
    """Integral id; text must be integral after trimming, numbers truncate, NaN -> null."""
    if isinstance(dtype, T.StringType):
        return F.trim(c).try_cast("bigint")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c), F.lit(None)).otherwise(c.try_cast("bigint"))
    if isinstance(dtype, T.BinaryType):
        return bytes_le_to_long(c)
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.BooleanType)):
        return c.try_cast("bigint")
    return F.lit(None).cast("bigint")


def date_expr(c: Column, dtype: T.DataType) -> Column:
    """Day-precision date; unparseable -> null, time part dropped.

    Text holds a day as ``yyyy-m-d`` or ``yyyy/m/d``, alone or before a blank or ``T`` and a time
    (an offset does not move the day), as ``yyyymmdd``, as ``Mon d yyyy`` (or the whole English name), or as ``m-d-yyyy`` or
    ``m/d/yyyy``; each row is parsed on its own.
    """
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(c)
    if isinstance(dtype, T.StringType):
        t = F.trim(c)
        day = F.concat_ws("-", *(F.regexp_extract(t, DAY_TEXT, g) for g in (1, 3, 4)))
        compact = F.concat_ws("-", *(F.regexp_extract(t, COMPACT_DAY_TEXT, g) for g in (1, 2, 3)))
        name = F.array_position(F.split(F.lit(MONTHS), " "), F.lower(F.regexp_extract(t, NAMED_DAY_TEXT, 1)))
        named = F.concat_ws("-", F.regexp_extract(t, NAMED_DAY_TEXT, 3), name.cast("string"), F.regexp_extract(t, NAMED_DAY_TEXT, 2))
        month_first = F.concat_ws("-", *(F.regexp_extract(t, MONTH_FIRST_TEXT, g) for g in (4, 1, 3)))
        return F.when(t.rlike(DAY_TEXT), day.try_cast("date")).when(t.rlike(COMPACT_DAY_TEXT), compact.try_cast("date")) \
            .when(t.rlike(NAMED_DAY_TEXT), named.try_cast("date")).when(t.rlike(MONTH_FIRST_TEXT), month_first.try_cast("date"))
    return F.lit(None).cast("date")


def rejected_dates(df: DataFrame, column: str) -> DataFrame:
    """How many values of a date column are there, and how many of them no format reads (these become null)."""
    value = date_expr(F.col(column), _dtype(df, column))
    return df.agg(F.count(column).alias("n_values"),
                  F.count_if(F.col(column).isNotNull() & value.isNull()).alias("n_rejected"))


def number_expr(c: Column, dtype: T.DataType) -> Column:
    """Numeric parse to double; bad text and NaN -> null."""
    if isinstance(dtype, T.StringType):
        return nan_to_null(F.trim(c).try_cast("double"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return nan_to_null(c.cast("double"))
    if isinstance(dtype, (T.IntegralType, T.DecimalType, T.BooleanType)):
        return c.cast("double")
    return F.lit(None).cast("double")


def units_expr(c: Column, dtype: T.DataType) -> Column:
    """Numeric parse, null -> 0, truncate toward zero, as bigint."""
    if isinstance(dtype, T.IntegralType):
        return F.coalesce(c.cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(number_expr(c, dtype), F.lit(0.0)).cast("bigint")


def text_expr(c: Column, null_literal: bool = False) -> Column:
    """Cast to text; ``null_literal`` keeps the source's "None" for nulls."""
    s = c.cast("string")
    return F.coalesce(s, F.lit("None")) if null_literal else s


def conform(df: DataFrame, schema: T.StructType, *, null_literal_text: Iterable[str] = ()) -> DataFrame:
    """Coerce a frame to a canonical schema in one projection.

    Columns are matched by normalised name; absent columns become typed nulls
    (T16: missing data is null, not zero); extra columns are dropped.  Litres
    stored as fractions keep them (as double).
    """
    df = normalize_column_names(df)
    text_literal = set(null_literal_text)
    out = []
    for field in schema.fields:
        name, target = field.name, field.dataType
        if name not in df.columns:
            out.append(F.lit(None).cast(target).alias(name))
            continue
        src = _dtype(df, name)
        col = F.col(name)
        if src == target and not isinstance(target, (T.DoubleType, T.FloatType)):
            expr = col
        elif (isinstance(target, T.LongType) and name.endswith("_id")) or name.endswith("_hour"):
            expr = id_expr(col, src).cast(target)
        elif isinstance(target, T.DateType):
            expr = date_expr(col, src)
        elif "liters" in name and isinstance(src, T.FractionalType):
            expr = number_expr(col, src)
        elif isinstance(target, (T.DoubleType, T.FloatType)):
            expr = number_expr(col, src)
        elif isinstance(target, (T.LongType, T.IntegerType)):
            expr = number_expr(col, src).try_cast(target)
        elif isinstance(target, T.StringType):
            expr = text_expr(col, name in text_literal)
        else:
            expr = col.try_cast(target)
        # every column may be null, whatever the source declares
        out.append((expr if df.schema[name].nullable else F.nullif(expr, F.lit(None).cast(target))).alias(name))
    return df.select(*out)
