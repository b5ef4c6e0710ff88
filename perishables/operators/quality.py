"""Data-quality checks (L3-L9): counts, value types, date ranges, key duplicates,
join health, orphans and declared constraints, as distributed aggregations.

Join health and orphan counts never join: the keys of all sides go through one
grouping (map-side partial aggregation), so a hot key costs one row, and the
fan-out is ``sum(left.n * right.n)``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perishables import schemas
from perishables.functions import coerce
from perishables.functions.coerce import ISO_DATE_FULL
from perishables.functions.scalars import QUALITY_GRADES

BATCH = schemas.BATCH_KEYS


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table."""
    return _union([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
                   for name, df in tables.items()])


def _type_label(dtype: T.DataType) -> str:
    if isinstance(dtype, (T.IntegralType, T.BooleanType)):
        return "integer"
    if isinstance(dtype, (T.FractionalType,)):
        return "real"
    if isinstance(dtype, T.BinaryType):
        return "blob"
    return "text"


INTEGER_TEXT = r"^[+-]?\d+$"
REAL_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def _value_type(c: Column, dtype: T.DataType) -> Column:
    """Storage class of one value: null, or integer/real/text (text content is classified).

    Text is classified by pattern first and only numeric-looking text is cast:
    a failed string-to-double cast costs an exception per value.
    """
    if isinstance(dtype, T.StringType):
        t = F.trim(c)
        kind = (F.when(t.rlike(INTEGER_TEXT) & t.try_cast("bigint").isNotNull(), F.lit("integer"))
                .when(t.rlike(REAL_TEXT), F.lit("real")).otherwise(F.lit("text")))
        return F.when(c.isNull(), F.lit("null")).otherwise(kind)
    return F.when(c.isNull(), F.lit("null")).otherwise(F.lit(_type_label(dtype)))


def type_histogram(tables: Mapping[str, DataFrame],
                   columns: Mapping[str, list[str]] = schemas.TYPE_CHECK_COLUMNS) -> DataFrame:
    """Value-type histogram per (table, column); one scan per table."""
    frames = []
    for name, df in tables.items():
        cols = [c for c in columns.get(name, []) if c in df.columns]
        if not cols:
            continue
        kinds = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"),
                                             _value_type(F.col(c), df.schema[c].dataType).alias("value_type"))
                                    for c in cols])).alias("k")
        frames.append(df.select(kinds).groupBy(F.col("k.column_name").alias("column_name"),
                                               F.col("k.value_type").alias("value_type"))
                      .agg(F.count(F.lit(1)).alias("n"))
                      .select(F.lit(name).alias("table_name"), "column_name", "value_type", "n"))
    return _union(frames)


def date_ranges(tables: Mapping[str, DataFrame],
                columns: Mapping[str, str] = schemas.DATE_COLUMNS) -> DataFrame:
    """Min and max of each table's date column."""
    return _union([df.agg(F.min(columns[name]).alias("min_date"), F.max(columns[name]).alias("max_date"))
                   .select(F.lit(name).alias("table_name"), F.lit(columns[name]).alias("column_name"),
                           "min_date", "max_date")
                   for name, df in tables.items() if name in columns and columns[name] in df.columns])


def stored_statistics(tables: Mapping[str, DataFrame], columns: Mapping[str, str] = schemas.DATE_COLUMNS, key: str = "batch_id") -> DataFrame:
    """E16, E18 and E20 for stored tables: rows, first and last day, greatest key; over ``tables.stored_scan`` no row is read."""
    frames = []
    for name, df in tables.items():
        day = columns.get(name) if columns.get(name) in df.columns else None
        aggs = [F.count(F.lit(1)).alias("n_rows")]
        aggs += [F.min(day).alias("min_date"), F.max(day).alias("max_date")] if day else []
        aggs += [F.max(key).alias("max_key")] if key in df.columns else []
        one = df.agg(*aggs)
        frames.append(one.select(F.lit(name).alias("table_name"), "n_rows", *(
            (F.col(c) if c in one.columns else F.lit(None)).cast(kind).alias(c)
            for c, kind in (("min_date", "date"), ("max_date", "date"), ("max_key", "bigint")))))
    return _union(frames)


def _date_text(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def non_iso_dates(tables: Mapping[str, DataFrame],
                  columns: Mapping[str, str] = schemas.DATE_COLUMNS) -> DataFrame:
    """Per date column, non-null values checked and how many are not ``YYYY-MM-DD`` text."""
    frames = []
    for name, df in tables.items():
        col = columns.get(name)
        if col not in df.columns:
            continue
        txt = _date_text(F.col(col), df.schema[col].dataType)
        frames.append(df.agg(F.count(txt).alias("n_checked"),
                             F.count_if(txt.isNotNull() & ~txt.rlike(ISO_DATE_FULL)).cast("bigint")
                             .alias("n_non_iso"))
                      .select(F.lit(name).alias("table_name"), F.lit(col).alias("column_name"),
                              "n_checked", "n_non_iso"))
    return _union(frames)


def non_iso_samples(df: DataFrame, column: str, n: int = 5) -> DataFrame:
    """Up to ``n`` non-ISO date texts (smallest first; the sample size is the feature)."""
    txt = _date_text(F.col(column), df.schema[column].dataType)
    return (df.select(txt.alias(column)).filter(F.col(column).isNotNull() & ~F.col(column).rlike(ISO_DATE_FULL))
            .orderBy(column).limit(n))


def _key_text(cols: list[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def pk_duplicates(tables: Mapping[str, DataFrame], keys: Mapping[str, list[str]] = schemas.PRIMARY_KEYS,
                  limit: int | None = None) -> DataFrame:
    """Composite keys occurring more than once, with their counts.

    ``limit`` keeps the first n keys per table in key order (the inspector's
    sample); by default every duplicated key is reported.
    """
    frames = []
    for name, df in tables.items():
        cols = keys.get(name)
        if not cols or not set(cols) <= set(df.columns):
            continue
        dups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        if limit is not None:
            dups = dups.orderBy(*cols).limit(limit)
        frames.append(dups.select(F.lit(name).alias("table_name"), F.lit(",".join(cols)).alias("key_columns"),
                                  _key_text(cols).alias("key_value"), "n"))
    return _union(frames)


def pk_duplicate_summary(tables: Mapping[str, DataFrame],
                         keys: Mapping[str, list[str]] = schemas.PRIMARY_KEYS) -> DataFrame:
    """Per table, number of duplicated keys and of rows carrying them."""
    d = pk_duplicates(tables, keys)
    return d.groupBy("table_name").agg(F.count(F.lit(1)).alias("duplicate_keys"),
                                       F.sum("n").alias("duplicate_rows"))


def relationship_counts(inventory: DataFrame, sales: DataFrame, factory: DataFrame, logistics: DataFrame) -> DataFrame:
    """Rows of each table per (batch, product): ``inventory, sales, factory, logistics``.

    The four tables' keys go through one grouping instead of a join for every check: a task hands on one row per key and table, and
    a hot key costs one row.  A row whose key holds a null matches nothing, so it counts under no inventory row.
    """
    sides = {"inventory": inventory, "sales": sales, "factory": factory, "logistics": logistics}
    keys = _union([df.select(*BATCH, F.lit(name).alias("side")) for name, df in sides.items()])
    whole = F.col(BATCH[0]).isNotNull() & F.col(BATCH[1]).isNotNull()
    counts = [F.count_if(F.col("side") == name).alias(name) for name in sides]
    return keys.groupBy(*BATCH).agg(*counts).withColumn("inventory", F.when(whole, F.col("inventory")).otherwise(F.lit(0).cast("bigint")))


def _long(one: DataFrame) -> DataFrame:
    """The single row's columns as rows (check_name, n)."""
    return one.select(F.explode(F.array(*(F.struct(F.lit(c).alias("check_name"), F.col(c).alias("n")) for c in one.columns))).alias("c")) \
        .select("c.check_name", "c.n")


def _total(x: Column, name: str) -> Column:
    return F.coalesce(F.sum(x), F.lit(0)).cast("bigint").alias(name)


def _joined() -> list[Column]:
    return [_total(F.col("inventory") * F.col(t), f"inventory_{t}") for t in ("sales", "factory", "logistics")]


def _orphaned() -> list[Column]:
    return [_total(F.when(F.col("inventory") == 0, F.col(t)), f"{t}_without_inventory") for t in ("sales", "factory", "logistics")]


def join_health(inventory: DataFrame, sales: DataFrame, factory: DataFrame, logistics: DataFrame) -> DataFrame:
    """Inner-join row counts of inventory with sales, factory and logistics on (batch, product)."""
    return _long(relationship_counts(inventory, sales, factory, logistics).agg(*_joined()))


def orphan_checks(inventory: DataFrame, sales: DataFrame, factory: DataFrame, logistics: DataFrame) -> DataFrame:
    """Rows of sales / factory / logistics whose (batch, product) has no inventory row.

    A null key never matches, so such rows count as orphans (LEFT JOIN ... IS NULL).
    """
    return _long(relationship_counts(inventory, sales, factory, logistics).agg(*_orphaned()))


def constraint_checks(quality: DataFrame, production: DataFrame) -> DataFrame:
    """Violations of the quality table's declared constraints, one row per rule.

    NOT NULL on every column; flags in {0, 1}; colour in 0..255; grade in the
    grade list; batch id present in production (foreign key).  A null value
    does not violate a CHECK (only its NOT NULL rule).
    """
    rules: list[tuple[str, Column]] = []
    for c in ("ph", "temperature", "taste", "odor", "fat", "turbidity", "colour", "grade"):
        rules.append((f"{c}_not_null", F.col(c).isNull()))
    for c in ("taste", "odor", "fat", "turbidity"):
        rules.append((f"{c}_in_0_1", ~F.col(c).isin(0, 1)))
    rules.append(("colour_0_255", ~F.col("colour").between(0, 255)))
    rules.append(("grade_in_list", ~F.col("grade").isin(*QUALITY_GRADES)))
    counts = quality.agg(*[F.count_if(cond).cast("bigint").alias(name) for name, cond in rules])
    stacked = counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("rule"), F.col(name).alias("n"))
                                                for name, _ in rules])).alias("r")) \
        .select(F.col("r.rule").alias("rule"), F.col("r.n").alias("n_violations"))
    fk = quality.select("batch_id").join(production.select("batch_id").dropna().distinct(), "batch_id", "left_anti") \
        .agg(F.count(F.lit(1)).alias("n_violations")).select(F.lit("batch_id_fk").alias("rule"), "n_violations")
    return stacked.unionByName(fk)


def rejected_dates(tables: Mapping[str, DataFrame], columns: Mapping[str, str] = schemas.DATE_COLUMNS) -> DataFrame:
    """Per date column as stored: values that are there, and values that no format reads (these rows leave the pipeline)."""
    frames = [coerce.rejected_dates(df, columns[name]).select(F.lit(name).alias("table_name"), F.lit(columns[name]).alias("column_name"),
                                                              "n_values", "n_rejected")
              for name, df in tables.items() if columns.get(name) in df.columns]
    return _union(frames)


def _first(df: DataFrame, order: list[str], value: Column, n: int, check: str, table: str, column: str | None) -> DataFrame:
    """The first ``n`` rows by ``order`` and value, as report rows numbered from 1; a task keeps no more than ``n``."""
    rows = df.select(*(F.col(c).alias(f"o{i}") for i, c in enumerate(order)), value.alias("value"))
    by = [*(f"o{i}" for i in range(len(order))), "value"]
    few = rows.orderBy(*by).limit(n).agg(F.sort_array(F.collect_list(F.struct(*by))).alias("rows"))
    return few.select(F.posexplode("rows").alias("at", "row")).select(
        F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), F.lit(column).cast("string").alias("column_name"),
        (F.col("at") + 1).cast("string").alias("item"), F.col("row.value").alias("value"))


def inspection_samples(tables: Mapping[str, DataFrame], n: int = 5) -> DataFrame:
    """L9's samples in the report's long form: head rows, date texts that are no ISO days, and duplicated keys with their counts.

    "First" is by key (or by the profiled columns, where a table has no key), so a sample is the same however rows are dealt.
    """
    frames = []
    for name, df in tables.items():
        key = [c for c in schemas.PRIMARY_KEYS.get(name, schemas.TYPE_CHECK_COLUMNS.get(name, [])) if c in df.columns]
        frames.append(_first(df, key, _key_text(df.columns), n, "head_row", name, None))
        day = schemas.DATE_COLUMNS.get(name)
        if day in df.columns:
            text = _date_text(F.col(day), df.schema[day].dataType)
            odd = df.filter(text.isNotNull() & ~text.rlike(ISO_DATE_FULL))
            frames.append(_first(odd, [], text, n, "non_iso_sample", name, day))
        if name in schemas.PRIMARY_KEYS and set(schemas.PRIMARY_KEYS[name]) <= set(df.columns):
            found = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
            frames.append(_first(found, key, F.concat(_key_text(key), F.lit(" x "), F.col("n").cast("string")), n, "duplicate_key", name, ",".join(key)))
    return _union(frames)


VALUE_TYPES = ("null", "integer", "real", "text", "blob")


def table_profile(df: DataFrame, name: str, type_columns: list[str], date_column: str | None) -> DataFrame:
    """L3-L5 for one table in a single aggregation pass, as long rows (check, table, column, item, value).

    Row count, per-column value-type counts, date min/max and the non-ISO count
    are all conditional aggregates over one scan (partial aggregation per task).
    """
    cols = [c for c in type_columns if c in df.columns]
    # classify each value once in a projection, then count labels (no per-aggregate re-evaluation)
    proj = [_value_type(F.col(c), df.schema[c].dataType).alias(f"k{i}") for i, c in enumerate(cols)]
    has_date = bool(date_column) and date_column in df.columns
    if has_date:
        txt = _date_text(F.col(date_column), df.schema[date_column].dataType)
        proj += [F.col(date_column).alias("d"), (txt.isNotNull() & ~txt.rlike(ISO_DATE_FULL)).alias("bad")]
    df = df.select(*proj) if proj else df.select(F.lit(1).alias("_one"))
    aggs, rows = [F.count(F.lit(1)).alias("rows")], [("row_count", None, None, "rows")]
    for i, c in enumerate(cols):
        for t in VALUE_TYPES:
            alias = f"t{i}_{t}"
            aggs.append(F.count_if(F.col(f"k{i}") == t).alias(alias))
            rows.append(("value_type", c, t, alias))
    if has_date:
        aggs += [F.min("d").cast("string").alias("dmin"), F.max("d").cast("string").alias("dmax"),
                 F.count_if(F.col("bad")).alias("non_iso")]
        rows += [("date_min", date_column, "min", "dmin"), ("date_max", date_column, "max", "dmax"),
                 ("non_iso_dates", date_column, None, "non_iso")]
    one = df.agg(*aggs)
    entries = [F.struct(F.lit(check).alias("check_name"), F.lit(col).cast("string").alias("column_name"),
                        F.lit(item).cast("string").alias("item"), F.col(alias).cast("string").alias("value"))
               for check, col, item, alias in rows]
    out = one.select(F.explode(F.array(*entries)).alias("e")).select(
        "e.check_name", F.lit(name).alias("table_name"), "e.column_name", "e.item", "e.value")
    # value types that do not occur are not reported (as in the histogram)
    return out.filter((F.col("check_name") != "value_type") | (F.col("value") != "0"))


def quality_report(tables: Mapping[str, DataFrame], samples: int = 0, related: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every check in one long table (check, table, column, item, value as text), with ``samples`` rows of each kind where asked for.

    Profiling is one aggregation per table (see ``table_profile``); key duplicates and constraints follow, and join health and orphans
    in one grouping (``related``: other tables for those two).
    """
    def long(df: DataFrame, check: str, item: str, value: str) -> DataFrame:
        return df.select(F.lit(check).alias("check_name"),
                         (F.col("table_name") if "table_name" in df.columns else F.lit(None)).cast("string")
                         .alias("table_name"),
                         F.lit(None).cast("string").alias("column_name"),
                         (F.col(item).cast("string") if item else F.lit(None).cast("string")).alias("item"),
                         F.col(value).cast("string").alias("value"))

    t = dict(tables)
    ops = {k: v for k, v in t.items() if k in schemas.TABLES}
    parts = [table_profile(df, name, schemas.TYPE_CHECK_COLUMNS.get(name, []), schemas.DATE_COLUMNS.get(name))
             for name, df in ops.items()]
    parts.append(long(pk_duplicate_summary(ops), "duplicate_keys", "", "duplicate_keys"))
    if related is not None or {"inventory", "sales", "factory", "logistics"} <= set(t):
        r = related or t
        both = _long(relationship_counts(r["inventory"], r["sales"], r["factory"], r["logistics"]).agg(*_joined(), *_orphaned()))
        orphaned = F.col("check_name").endswith("_without_inventory")
        parts.append(both.select(F.when(orphaned, F.lit("orphan_rows")).otherwise(F.lit("join_rows")).alias("check_name"),
                                 F.lit(None).cast("string").alias("table_name"), F.lit(None).cast("string").alias("column_name"),
                                 F.col("check_name").alias("item"), F.col("n").cast("string").alias("value")))
    if {"quality", "production"} <= set(t):
        parts.append(long(constraint_checks(t["quality"], t["production"]), "constraint", "rule", "n_violations"))
    if samples:
        parts.append(inspection_samples(ops, samples))
    return _union(parts)
