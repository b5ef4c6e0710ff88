"""DuckDB oracle texts for the registered queries.

Only the provided tables exist on the oracle side, so every text inlines the
domain views as CTEs.  The SQL states the rules explicitly where the engines
differ: DuckDB rounds when casting doubles or '3.7' to integers (Spark
truncates or rejects), its ``mode`` has no tie rule, and it has no ``initcap``.
Sums of non-exact doubles use the same DECIMAL(38,12) accumulation as the Spark
side, so totals do not depend on summation order.
"""

from __future__ import annotations

import itertools
import re

from perishables.functions.scalars import PRODUCT_TYPES
from perishables.operators import holt_winters

EXACT = "DECIMAL(38,12)"


def exact_avg(x: str) -> str:
    return f"(CAST(sum(CAST({x} AS {EXACT})) AS DOUBLE) / CAST(count({x}) AS DOUBLE))"


def exact_sum0(x: str) -> str:
    return f"coalesce(CAST(sum(CAST({x} AS {EXACT})) AS DOUBLE), CAST(0 AS DOUBLE))"


def initcap(x: str) -> str:
    return (f"array_to_string(list_transform(string_split(lower({x}), ' '), "
            f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')")


PID = "o_custkey % 5 + 1"
LINE_DATE = "CAST(o_orderdate AS DATE) + CAST(l_partkey % 12 AS INTEGER)"

VIEWS: dict[str, str] = {
    "production": f"""SELECT o_orderkey AS batch_id, {PID} AS product_id,
  'type_' || CAST({PID} AS VARCHAR) AS product_type, CAST(o_orderdate AS DATE) AS production_date,
  CAST(o_custkey % 24 AS INTEGER) AS production_hour,
  CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN 'high' WHEN 1 THEN 'medium' ELSE 'low' END AS grade,
  CAST(2 + o_orderkey % 19 AS INTEGER) AS shelf_life_days
FROM orders""",
    "quality": """SELECT o_orderkey AS batch_id,
  CAST(30 + o_custkey % 66 AS DOUBLE) / CAST(10 AS DOUBLE) AS ph,
  CAST(34 + o_orderkey % 57 AS DOUBLE) AS temperature,
  CAST(o_custkey % 4 - 1 AS INTEGER) AS taste, CAST(o_custkey % 3 AS INTEGER) AS odor,
  CAST(o_orderkey % 2 AS INTEGER) AS fat, CAST(o_custkey % 2 AS INTEGER) AS turbidity,
  CAST(230 + o_custkey % 40 AS INTEGER) AS colour,
  CASE CAST(o_orderkey % 3 AS INTEGER) WHEN 0 THEN ' High' WHEN 1 THEN 'MEDIUM' ELSE 'low ' END AS grade
FROM orders""",
    "inventory": f"""SELECT o_orderkey AS batch_id, {PID} AS product_id,
  CAST(o_orderdate AS DATE) AS production_date, CAST(o_custkey % 24 AS INTEGER) AS production_hour,
  CAST(floor(o_totalprice / CAST(5000 AS DOUBLE)) AS BIGINT) + 20 AS initial_stock_liters,
  CAST(floor(o_totalprice / CAST(5000 AS DOUBLE)) AS BIGINT) AS current_stock_liters,
  CAST(floor(o_totalprice / CAST(50000 AS DOUBLE)) AS BIGINT) AS reorder_level_liters,
  CAST(floor(o_totalprice / CAST(20000 AS DOUBLE)) AS BIGINT) AS reorder_quantity_liters,
  'W' || CAST(o_orderkey % 4 AS VARCHAR) AS warehouse_location,
  CAST(4 + o_orderkey % 9 AS DOUBLE) / CAST(2 AS DOUBLE) AS storage_temperature_c
FROM orders WHERE o_orderkey % 20 <> 0""",
    "sales": f"""SELECT l_orderkey AS batch_id, {PID} AS product_id,
  'S' || CAST(l_suppkey % 10 + 1 AS VARCHAR) AS store_id, {LINE_DATE} AS sale_date,
  CAST(8 + l_linenumber AS INTEGER) AS sale_hour, CAST(trunc(l_quantity) AS BIGINT) AS units_sold,
  CASE WHEN l_discount >= CAST(0.08 AS DOUBLE) THEN 1 ELSE 0 END AS promotion_flag,
  CASE WHEN l_tax >= CAST(0.05 AS DOUBLE) THEN CAST(1.125 AS DOUBLE) ELSE CAST(1.0 AS DOUBLE) END
    AS seasonality_factor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "factory": f"""SELECT o_orderkey AS batch_id, {PID} AS product_id,
  CAST(o_orderdate AS DATE) AS production_date, CAST(o_custkey % 24 AS INTEGER) AS production_hour,
  'L' || CAST(o_orderkey % 5 + 1 AS VARCHAR) AS line_id,
  CAST(CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE 64 END AS BIGINT) AS quantity_produced_liters,
  CAST(1 + o_orderkey % 3 AS INTEGER) AS lead_time_days,
  CAST(CASE WHEN o_orderkey % 7 <> 0 THEN 10 + o_orderkey % 23 END AS BIGINT) AS max_capacity_per_day_liters,
  CAST(80 + o_orderkey % 16 AS DOUBLE) AS energy_consumption_kwh
FROM orders WHERE o_orderkey % 13 <> 0""",
    "logistics": f"""SELECT l_orderkey AS batch_id, {PID} AS product_id, {LINE_DATE} AS transport_date,
  CAST(8 + l_suppkey % 13 AS INTEGER) AS transport_hour, CAST(l_linenumber AS DOUBLE) AS transport_time_hours,
  CASE WHEN l_partkey % 9 <> 0 THEN CAST(8 + l_suppkey % 17 AS DOUBLE) / CAST(4 AS DOUBLE) END
    AS transport_temperature_c,
  CAST(2 + l_linenumber AS DOUBLE) * CAST(2.5 AS DOUBLE) AS energy_consumption_kwh,
  'W' || CAST(l_suppkey % 4 AS VARCHAR) AS warehouse_location
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R'""",
    "product_catalog": f"""SELECT DISTINCT {PID} AS product_id, 'type_' || CAST({PID} AS VARCHAR) AS product_type
FROM orders""",
    "catalog": """SELECT DISTINCT batch_id, product_id, product_type, shelf_life_days, production_date
FROM production WHERE NOT (batch_id IS NULL AND product_id IS NULL AND product_type IS NULL
  AND shelf_life_days IS NULL AND production_date IS NULL)""",
    "quality_clean": """SELECT batch_id, ph, temperature,
  CASE WHEN taste < 0 THEN 0 WHEN taste > 1 THEN 1 ELSE taste END AS taste,
  CASE WHEN odor < 0 THEN 0 WHEN odor > 1 THEN 1 ELSE odor END AS odor,
  CASE WHEN fat < 0 THEN 0 WHEN fat > 1 THEN 1 ELSE fat END AS fat,
  CASE WHEN turbidity < 0 THEN 0 WHEN turbidity > 1 THEN 1 ELSE turbidity END AS turbidity,
  CASE WHEN colour < 0 THEN 0 WHEN colour > 255 THEN 255 ELSE colour END AS colour,
  trim(lower(grade)) AS grade
FROM quality WHERE ph IS NOT NULL AND temperature IS NOT NULL AND grade IS NOT NULL""",
    "daily_sales": """SELECT batch_id, product_id, store_id, sale_date AS date,
  CAST(coalesce(sum(coalesce(units_sold, 0)), 0) AS BIGINT) AS units_sold,
  max(promotion_flag) AS promotion_flag, avg(seasonality_factor) AS seasonality_factor
FROM (SELECT * REPLACE (coalesce(store_id, 'None') AS store_id) FROM sales)
WHERE batch_id IS NOT NULL AND product_id IS NOT NULL AND sale_date IS NOT NULL
GROUP BY batch_id, product_id, store_id, sale_date""",
    "daily_logistics": """SELECT batch_id, product_id, transport_date AS date,
  CAST(coalesce(sum(transport_time_hours), 0) AS DOUBLE) AS transport_time_hours,
  avg(transport_temperature_c) AS transport_temperature_c,
  CAST(coalesce(sum(energy_consumption_kwh), 0) AS DOUBLE) AS energy_consumption_kwh
FROM logistics WHERE batch_id IS NOT NULL AND product_id IS NOT NULL AND transport_date IS NOT NULL
GROUP BY batch_id, product_id, transport_date""",
    "j_catalog": """SELECT s.batch_id, s.product_id, s.store_id, s.date, s.units_sold, s.promotion_flag,
  s.seasonality_factor, c.product_type, c.shelf_life_days, c.production_date
FROM daily_sales s LEFT JOIN catalog c ON s.batch_id = c.batch_id AND s.product_id = c.product_id""",
    "j_inventory": """SELECT j.*, i.initial_stock_liters, i.current_stock_liters, i.reorder_level_liters,
  i.reorder_quantity_liters, i.warehouse_location, i.storage_temperature_c,
  i.production_date AS production_date_inv, i.production_hour
FROM j_catalog j LEFT JOIN inventory i ON j.batch_id = i.batch_id AND j.product_id = i.product_id""",
    "j_factory": """SELECT j.*, f.line_id, f.quantity_produced_liters, f.lead_time_days,
  f.max_capacity_per_day_liters, f.energy_consumption_kwh
FROM j_inventory j LEFT JOIN factory f ON j.batch_id = f.batch_id AND j.product_id = f.product_id""",
    "j_logistics": """SELECT j.*, l.transport_time_hours, l.transport_temperature_c,
  l.energy_consumption_kwh AS energy_consumption_kwh_log
FROM j_factory j LEFT JOIN daily_logistics l
  ON j.batch_id = l.batch_id AND j.product_id = l.product_id AND j.date = l.date""",
    "cur1": """SELECT *,
  CASE WHEN current_stock_liters - units_sold < 0 THEN 0 ELSE current_stock_liters - units_sold END
    AS available_stock,
  CAST(CASE WHEN (production_date + CAST(coalesce(shelf_life_days, 0) AS INTEGER)) - date < 0 THEN 0
       ELSE (production_date + CAST(coalesce(shelf_life_days, 0) AS INTEGER)) - date END AS INTEGER)
    AS days_to_expiration
FROM j_logistics""",
    "cur2": """SELECT *, CASE WHEN units_sold - available_stock < 0 THEN 0 ELSE units_sold - available_stock END AS gap
FROM cur1""",
    "curated": """SELECT * EXCLUDE (gap),
  CASE WHEN max_capacity_per_day_liters IS NULL OR gap IS NULL THEN gap
       ELSE least(gap, max_capacity_per_day_liters) END AS suggested_production,
  CAST(coalesce(days_to_expiration <= 3 AND available_stock > 0, false) AS INTEGER) AS expiration_risk
FROM cur2""",
    "psd": f"""SELECT product_id, store_id, date,
  CAST(coalesce(sum(units_sold), 0) AS BIGINT) AS units_sold,
  CAST(coalesce(sum(available_stock), 0) AS BIGINT) AS available_stock,
  CAST(coalesce(sum(max_capacity_per_day_liters), 0) AS BIGINT) AS max_capacity_per_day_liters,
  CAST(coalesce(sum(energy_consumption_kwh), 0) AS DOUBLE) AS energy_consumption_kwh,
  CAST(coalesce(sum(transport_time_hours), 0) AS DOUBLE) AS transport_time_hours,
  {exact_avg('transport_temperature_c')} AS transport_temperature_c,
  min(days_to_expiration) AS days_to_expiration
FROM curated WHERE product_id IS NOT NULL AND store_id IS NOT NULL AND date IS NOT NULL
GROUP BY product_id, store_id, date""",
    "ss": f"""SELECT product_id, store_id, count(*) AS n_days, max(date) AS last_date,
  CAST(arg_max(available_stock, date) AS DOUBLE) AS last_stock,
  CAST(coalesce(sum(max_capacity_per_day_liters), 0) AS DOUBLE) AS cap_sum,
  max(CAST(coalesce(days_to_expiration <= 3 AND available_stock > 0, false) AS INTEGER)) AS expiration_risk,
  {exact_avg('energy_consumption_kwh')} AS avg_energy
FROM psd GROUP BY product_id, store_id""",
    "base": """SELECT product_id, store_id,
  CASE WHEN avg(CAST(units_sold AS DOUBLE)) < 0 THEN CAST(0 AS DOUBLE) ELSE avg(CAST(units_sold AS DOUBLE)) END
    AS baseline
FROM (SELECT *, row_number() OVER (PARTITION BY product_id, store_id ORDER BY date DESC) AS rn FROM psd)
WHERE rn <= 7 GROUP BY product_id, store_id""",
    "raw_sales_text": """SELECT l_orderkey, l_linenumber,
  CASE CAST(l_linenumber % 4 AS INTEGER) WHEN 0 THEN ' ' || CAST(l_orderkey AS VARCHAR) || ' '
       WHEN 1 THEN CAST(l_orderkey AS VARCHAR) WHEN 2 THEN CAST(l_orderkey AS VARCHAR) || '.7'
       ELSE 'b' || CAST(l_orderkey AS VARCHAR) END AS batch_id,
  CASE WHEN l_partkey % 50 <> 0 THEN CAST(l_partkey AS VARCHAR) END AS product_id,
  CASE CAST(l_suppkey % 9 AS INTEGER) WHEN 0 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR)
       WHEN 1 THEN CAST(CAST(l_shipdate AS DATE) AS VARCHAR) || ' 10:00'
       WHEN 2 THEN CAST(year(l_shipdate) AS VARCHAR) WHEN 3 THEN 'x'
       WHEN 5 THEN strftime(l_shipdate, '%Y/%m/%d') WHEN 6 THEN strftime(l_shipdate, '%Y%m%d')
       WHEN 7 THEN strftime(l_shipdate, '%Y-%m-%d') || 'T23:30:00+02:00'
       WHEN 8 THEN strftime(l_shipdate, '%Y-%m-%d') || '1' END AS sale_date,
  CASE CAST(l_partkey % 4 AS INTEGER) WHEN 0 THEN CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) || '.7'
       WHEN 1 THEN '-' || CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) || '.9' WHEN 2 THEN 'abc' END AS units
FROM lineitem""",
    "parsed_raw": r"""SELECT l_orderkey, l_linenumber,
  CASE WHEN regexp_full_match(trim(batch_id), '[+-]?[0-9]+') THEN TRY_CAST(trim(batch_id) AS BIGINT) END AS batch_id,
  CASE WHEN regexp_full_match(trim(product_id), '[+-]?[0-9]+') THEN TRY_CAST(trim(product_id) AS BIGINT) END
    AS product_id,
  CASE WHEN regexp_matches(trim(sale_date), '^\d{4}-\d{1,2}-\d{1,2}($|[ T])')
       THEN TRY_CAST(regexp_extract(trim(sale_date), '^\d{4}-\d{1,2}-\d{1,2}', 0) AS DATE)
       WHEN regexp_matches(trim(sale_date), '^\d{4}/\d{1,2}/\d{1,2}($|[ T])')
       THEN TRY_CAST(replace(regexp_extract(trim(sale_date), '^\d{4}/\d{1,2}/\d{1,2}', 0), '/', '-') AS DATE)
       WHEN regexp_full_match(trim(sale_date), '\d{8}')
       THEN TRY_CAST(strptime(trim(sale_date), '%Y%m%d') AS DATE) END AS sale_date,
  CASE WHEN isnan(TRY_CAST(trim(units) AS DOUBLE)) THEN NULL ELSE TRY_CAST(trim(units) AS DOUBLE) END AS units_value
FROM raw_sales_text""",
    "pmap": """SELECT product_id, product_type FROM (
  SELECT product_id, product_type,
         row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, product_type) AS rn
  FROM catalog WHERE product_id IS NOT NULL AND product_type IS NOT NULL GROUP BY product_id, product_type)
WHERE rn = 1""",
    "graded": """SELECT product_id, grade AS product_type FROM (
  SELECT product_id, grade, row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, grade) AS rn
  FROM production GROUP BY product_id, grade) WHERE rn = 1""",
    "risk": """SELECT product_id, store_id,
  max(CASE WHEN days_to_expiration <= 1 THEN 2 WHEN days_to_expiration <= 3 THEN 1 ELSE 0 END) AS risk_score
FROM curated WHERE product_id IS NOT NULL AND store_id IS NOT NULL AND days_to_expiration IS NOT NULL
GROUP BY product_id, store_id""",
}

# without the holes that joins and orphan checks need
VIEWS["inventory_all"] = VIEWS["inventory"].replace(" WHERE o_orderkey % 20 <> 0", "")
VIEWS["factory_all"] = VIEWS["factory"].replace(" WHERE o_orderkey % 13 <> 0", "")
WHOLE = {"inventory": "inventory_all", "factory": "factory_all"}

DEPS: dict[str, list[str]] = {
    "catalog": ["production"],
    "quality_clean": ["quality"],
    "daily_sales": ["sales"],
    "daily_logistics": ["logistics"],
    "j_catalog": ["daily_sales", "catalog"],
    "j_inventory": ["j_catalog", "inventory"],
    "j_factory": ["j_inventory", "factory"],
    "j_logistics": ["j_factory", "daily_logistics"],
    "cur1": ["j_logistics"],
    "cur2": ["cur1"],
    "curated": ["cur2"],
    "psd": ["curated"],
    "ss": ["psd"],
    "base": ["psd"],
    "parsed_raw": ["raw_sales_text"],
    "pmap": ["catalog"],
    "risk": ["curated"],
    "graded": ["production"],
}


def _order(names: list[str], out: list[str]) -> list[str]:
    for n in names:
        if n in out:
            continue
        _order(DEPS.get(n, []), out)
        if n not in out:
            out.append(n)
    return out


def forecast_ctes(prefix: str, horizon: int, done_steps: int | None = None) -> list[tuple[str, str]]:
    """Baseline forecast chain (K4): future dates, minus done steps, values, per-series totals, rows."""
    p = prefix
    rem_filter = f"WHERE step > {done_steps}" if done_steps else ""
    sg = "CASE WHEN t.total_forecast - s.last_stock > 0 THEN t.total_forecast - s.last_stock ELSE CAST(0 AS DOUBLE) END"
    return [
        (f"{p}fut", f"""SELECT product_id, store_id, last_date + CAST(step AS INTEGER) AS forecast_date,
  CAST(step AS INTEGER) AS step FROM ss, range(1, {horizon + 1}) r(step)"""),
        (f"{p}rem", f"SELECT * FROM {p}fut {rem_filter}"),
        (f"{p}vals", f"""SELECT r.product_id, r.store_id, r.forecast_date, r.step,
  coalesce(b.baseline, CAST(0 AS DOUBLE)) AS forecasted_sales
FROM {p}rem r LEFT JOIN base b ON r.product_id = b.product_id AND r.store_id = b.store_id"""),
        (f"{p}tot", f"""SELECT product_id, store_id, count(*) AS n_rem, {exact_sum0('forecasted_sales')} AS total_forecast
FROM {p}vals GROUP BY product_id, store_id"""),
        (f"{p}per", f"""SELECT t.product_id, t.store_id,
  (CASE WHEN s.last_stock - t.total_forecast > 0 THEN s.last_stock - t.total_forecast ELSE CAST(0 AS DOUBLE) END)
    / CAST(greatest(t.n_rem, 1) AS DOUBLE) AS predicted_waste,
  (CASE WHEN s.cap_sum > 0 THEN least({sg}, s.cap_sum * t.n_rem) ELSE {sg} END)
    / CAST(greatest(t.n_rem, 1) AS DOUBLE) AS suggested_production,
  CAST(s.expiration_risk AS INTEGER) AS expiration_risk, s.avg_energy AS predicted_logistics_cost
FROM {p}tot t JOIN ss s ON t.product_id = s.product_id AND t.store_id = s.store_id"""),
        (f"{p}fc", f"""SELECT v.product_id, v.store_id, v.forecast_date, v.forecasted_sales, p.predicted_waste,
  p.suggested_production, p.expiration_risk, p.predicted_logistics_cost
FROM {p}vals v JOIN {p}per p ON v.product_id = p.product_id AND v.store_id = p.store_id"""),
    ]


def with_ctes(views: list[str], body: str, extra: list[tuple[str, str]] | None = None) -> str:
    parts = [f"{n} AS (\n{VIEWS[n]}\n)" for n in _order(views, [])]
    parts += [f"{n} AS (\n{sql}\n)" for n, sql in (extra or [])]
    return "WITH " + ",\n".join(parts) + "\n" + body if parts else body


FORECAST_VIEWS = ["ss", "base"]


def fc_sql(body: str, horizon: int = 30, done: int | None = None, prefix: str = "",
           more: list[tuple[str, str]] | None = None, views: list[str] | None = None) -> str:
    return with_ctes(FORECAST_VIEWS + (views or []), body, forecast_ctes(prefix, horizon, done) + (more or []))


def fcw_ctes(days: int = 14) -> list[tuple[str, str]]:
    return [("fcw", f"""SELECT * FROM fc WHERE forecast_date BETWEEN (SELECT min(forecast_date) FROM fc)
  AND (SELECT min(forecast_date) FROM fc) + CAST({days - 1} AS INTEGER)""")]


LABEL_NAME = initcap("coalesce(m.product_type, 'Product ' || CAST(x.product_id AS VARCHAR))")
STORE_RE = r"^([A-Za-z]*)(\d+)$"
STORES = [f"S{i}" for i in range(1, 11)]   # natural order of the store ids the data produces

TYPE_CHECK = {
    "production": [("batch_id", "integer"), ("product_id", "integer"), ("production_date", "text"),
                   ("production_hour", "integer")],
    "quality": [("batch_id", "integer"), ("grade", None)],
    "inventory": [("batch_id", "integer"), ("product_id", "integer"), ("production_date", "text"),
                  ("production_hour", "integer")],
    "sales": [("batch_id", "integer"), ("product_id", "integer"), ("store_id", None), ("sale_date", "text"),
              ("sale_hour", "integer")],
    "factory": [("batch_id", "integer"), ("product_id", "integer"), ("production_date", "text"),
                ("production_hour", "integer")],
    "logistics": [("batch_id", "integer"), ("product_id", "integer"), ("transport_date", "text"),
                  ("transport_hour", "integer")],
    "forecast": [("product_id", "integer"), ("store_id", None), ("forecast_date", "text")],
}
DATE_COLS = {"production": "production_date", "inventory": "production_date", "sales": "sale_date",
             "factory": "production_date", "logistics": "transport_date", "forecast": "forecast_date"}
PK = {"inventory": ["batch_id", "product_id"],
      "sales": ["batch_id", "product_id", "store_id", "sale_date", "sale_hour"],
      "factory": ["batch_id", "product_id"],
      "logistics": ["batch_id", "product_id", "transport_date", "transport_hour"],
      "forecast": ["product_id", "store_id", "forecast_date"]}
OPS = ["production", "quality", "inventory", "sales", "factory", "logistics", "forecast"]


def _value_type(col: str, label: str | None) -> str:
    if label is not None:
        return f"CASE WHEN {col} IS NULL THEN 'null' ELSE '{label}' END"
    t = f"trim({col})"
    return (f"CASE WHEN {col} IS NULL THEN 'null' WHEN regexp_full_match({t}, '[+-]?[0-9]+') "
            f"AND TRY_CAST({t} AS BIGINT) IS NOT NULL THEN 'integer' "
            f"WHEN regexp_full_match({t}, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?') THEN 'real' "
            f"ELSE 'text' END")


def _ops_views() -> list[str]:
    return ["production", "quality", "inventory", "inventory_all", "sales", "factory", "factory_all", "logistics"]


def _ops_sql(body: str, more: list[tuple[str, str]] | None = None) -> str:
    fc = forecast_ctes("", 30) + [("forecast", "SELECT * FROM fc")]
    return with_ctes(FORECAST_VIEWS + _ops_views(), body, fc + (more or []))


def _union(selects: list[str]) -> str:
    return "\nUNION ALL\n".join(selects)


def _key_text(cols: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '<null>')" for c in cols) + ")"


def _join_health() -> str:
    return with_ctes(["inventory", "sales", "factory", "logistics"], _join_health_selects())


def _join_health_selects() -> str:
    kc = "SELECT batch_id, product_id, count(*) AS n FROM {t} WHERE batch_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL"
    sel = []
    for label, t in (("inventory_sales", "sales"), ("inventory_factory", "factory"), ("inventory_logistics", "logistics")):
        sel.append(f"""SELECT '{label}' AS check_name, CAST(coalesce(sum(i.n * o.n), 0) AS BIGINT) AS n
FROM ({kc.format(t='inventory')}) i JOIN ({kc.format(t=t)}) o ON i.batch_id = o.batch_id AND i.product_id = o.product_id""")
    return _union(sel)


def _orphans() -> str:
    return with_ctes(["inventory", "sales", "factory", "logistics"], _orphan_selects())


def _orphan_selects() -> str:
    sel = []
    for label, t in (("sales_without_inventory", "sales"), ("factory_without_inventory", "factory"),
                     ("logistics_without_inventory", "logistics")):
        sel.append(f"""SELECT '{label}' AS check_name, CAST(count(*) AS BIGINT) AS n
FROM {t} o LEFT JOIN inventory i ON i.batch_id = o.batch_id AND i.product_id = o.product_id WHERE i.batch_id IS NULL""")
    return _union(sel)


def _constraints() -> str:
    return with_ctes(["quality", "production"], _constraint_selects())


def _constraint_selects() -> str:
    rules = [(f"{c}_not_null", f"{c} IS NULL") for c in
             ("ph", "temperature", "taste", "odor", "fat", "turbidity", "colour", "grade")]
    rules += [(f"{c}_in_0_1", f"NOT ({c} IN (0, 1))") for c in ("taste", "odor", "fat", "turbidity")]
    rules += [("colour_0_255", "NOT (colour BETWEEN 0 AND 255)"),
              ("grade_in_list", "NOT (grade IN ('high', 'medium', 'low'))")]
    sel = [f"SELECT '{name}' AS rule, CAST(count_if({cond}) AS BIGINT) AS n_violations FROM quality"
           for name, cond in rules]
    sel.append("""SELECT 'batch_id_fk' AS rule, CAST(count(*) AS BIGINT) AS n_violations FROM quality q
WHERE NOT EXISTS (SELECT 1 FROM production p WHERE p.batch_id = q.batch_id)""")
    return _union(sel)


def _type_histogram() -> str:
    sel = []
    for t, cols in TYPE_CHECK.items():
        for c, label in cols:
            sel.append(f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {_value_type(c, label)} AS value_type,
  count(*) AS n FROM {WHOLE.get(t, t)} GROUP BY ALL""")
    return _ops_sql(_union(sel))


def _date_ranges() -> str:
    sel = [f"""SELECT '{t}' AS table_name, '{c}' AS column_name, min({c}) AS min_date, max({c}) AS max_date FROM {WHOLE.get(t, t)}"""
           for t, c in DATE_COLS.items()]
    return _ops_sql(_union(sel))


def _non_iso_selects() -> list[str]:
    return [f"""SELECT '{t}' AS table_name, '{c}' AS column_name, count(CAST({c} AS VARCHAR)) AS n_checked,
  CAST(count_if(NOT regexp_full_match(CAST({c} AS VARCHAR), '\\d{{4}}-\\d{{2}}-\\d{{2}}')) AS BIGINT) AS n_non_iso
FROM {WHOLE.get(t, t)}""" for t, c in DATE_COLS.items()]


def _non_iso() -> str:
    sel = _non_iso_selects()
    sel.append("""SELECT 'raw_sales_text' AS table_name, 'sale_date' AS column_name, count(sale_date) AS n_checked,
  CAST(count_if(NOT regexp_full_match(sale_date, '\\d{4}-\\d{2}-\\d{2}')) AS BIGINT) AS n_non_iso
FROM raw_sales_text""")
    return _ops_sql(_union(sel), [("raw_sales_text", VIEWS["raw_sales_text"])])


def _pk_duplicates() -> str:
    sel = [f"""SELECT '{t}' AS table_name, '{",".join(cols)}' AS key_columns, {_key_text(cols)} AS key_value, count(*) AS n
FROM {WHOLE.get(t, t)} GROUP BY {", ".join(cols)} HAVING count(*) > 1""" for t, cols in PK.items()]
    return _ops_sql(_union(sel))


def _quality_report() -> str:
    """Every check as (check_name, table_name, column_name, item, value-as-text)."""
    def part(check: str, table: str, column: str, item: str, value: str, sql: str) -> str:
        return (f"SELECT '{check}' AS check_name, {table} AS table_name, {column} AS column_name, {item} AS item, "
                f"CAST({value} AS VARCHAR) AS value FROM ({sql})")
    null = "CAST(NULL AS VARCHAR)"
    dups = _union([f"""SELECT '{t}' AS table_name, count(*) AS n FROM {WHOLE.get(t, t)} GROUP BY {", ".join(cols)} HAVING count(*) > 1"""
                   for t, cols in PK.items()])
    dup_summary = f"SELECT table_name, count(*) AS duplicate_keys FROM ({dups}) GROUP BY table_name"
    rows = _union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {WHOLE.get(t, t)}" for t in OPS])
    types = _union([f"""SELECT '{t}' AS table_name, '{c}' AS column_name, {_value_type(c, label)} AS value_type,
  count(*) AS n FROM {WHOLE.get(t, t)} GROUP BY ALL""" for t, cols in TYPE_CHECK.items() for c, label in cols])
    ranges = _union([f"SELECT '{t}' AS table_name, '{c}' AS column_name, min({c}) AS min_date, max({c}) AS max_date FROM {WHOLE.get(t, t)}"
                     for t, c in DATE_COLS.items()])
    body = _union([
        part("row_count", "table_name", null, null, "n_rows", rows),
        part("value_type", "table_name", "column_name", "value_type", "n", types),
        part("date_min", "table_name", "column_name", "'min'", "min_date", ranges),
        part("date_max", "table_name", "column_name", "'max'", "max_date", ranges),
        part("non_iso_dates", "table_name", "column_name", null, "n_non_iso", _union(_non_iso_selects())),
        part("duplicate_keys", "table_name", null, null, "duplicate_keys", dup_summary),
        part("join_rows", null, null, "check_name", "n", _join_health_selects()),
        part("orphan_rows", null, null, "check_name", "n", _orphan_selects()),
        part("constraint", null, null, "rule", "n_violations", _constraint_selects()),
    ])
    return _ops_sql(body)


HEAD_COLUMNS = {
    "production": "batch_id product_id product_type production_date production_hour grade shelf_life_days",
    "quality": "batch_id ph temperature taste odor fat turbidity colour grade",
    "inventory": "batch_id product_id production_date production_hour initial_stock_liters current_stock_liters reorder_level_liters "
                 "reorder_quantity_liters warehouse_location storage_temperature_c",
    "sales": "batch_id product_id store_id sale_date sale_hour units_sold promotion_flag seasonality_factor",
    "factory": "batch_id product_id production_date production_hour line_id quantity_produced_liters lead_time_days "
               "max_capacity_per_day_liters energy_consumption_kwh",
    "logistics": "batch_id product_id transport_date transport_hour transport_time_hours transport_temperature_c energy_consumption_kwh "
                 "warehouse_location",
}


def _inspection_samples(n: int = 5) -> str:
    def first(check: str, table: str, column: str, value: str, order: list[str], source: str) -> str:
        return f"""SELECT '{check}' AS check_name, '{table}' AS table_name, {column} AS column_name, CAST(place AS VARCHAR) AS item, value FROM (
  SELECT {value} AS value, row_number() OVER (ORDER BY {', '.join([*(f'{c} NULLS FIRST' for c in order), 'value'])}) AS place FROM {source}) WHERE place <= {n}"""

    sel = []
    for t, cols in HEAD_COLUMNS.items():
        order = PK.get(t) or [c for c, _ in TYPE_CHECK[t]]
        sel.append(first("head_row", t, "CAST(NULL AS VARCHAR)", _key_text(cols.split()), order, WHOLE.get(t, t)))
        if t in PK:
            keys = ", ".join(PK[t])
            sel.append(first("duplicate_key", t, f"'{','.join(PK[t])}'", f"{_key_text(PK[t])} || ' x ' || CAST(n AS VARCHAR)", PK[t],
                             f"(SELECT {keys}, count(*) AS n FROM {WHOLE.get(t, t)} GROUP BY {keys} HAVING count(*) > 1)"))
    raw = "(SELECT l_orderkey AS batch_id, sale_date, units FROM raw_sales_text)"
    sel.append(first("head_row", "raw_sales_text", "CAST(NULL AS VARCHAR)", _key_text(["batch_id", "sale_date", "units"]), ["batch_id", "sale_date"], raw))
    sel.append(first("non_iso_sample", "raw_sales_text", "'sale_date'", "sale_date", [],
                     f"(SELECT * FROM {raw} WHERE NOT regexp_full_match(sale_date, '\\d{{4}}-\\d{{2}}-\\d{{2}}'))"))
    return with_ctes(["raw_sales_text", *HEAD_COLUMNS, *WHOLE.values()], _union(sel))


def _stored_statistics() -> str:
    sel = []
    for t in (*HEAD_COLUMNS, "product_catalog"):
        day, key = DATE_COLS.get(t, "CAST(NULL AS DATE)"), "CAST(NULL AS BIGINT)" if t == "product_catalog" else "batch_id"
        sel.append(f"SELECT '{t}' AS table_name, count(*) AS n_rows, min({day}) AS min_date, max({day}) AS max_date, max({key}) AS max_key FROM {WHOLE.get(t, t)}")
    return with_ctes([*HEAD_COLUMNS, *WHOLE.values(), "product_catalog"], _union(sel))


def _row_counts() -> str:
    return _ops_sql(_union([f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {WHOLE.get(t, t)}" for t in OPS]))


def _natural_sort_cols(col: str) -> str:
    t = f"trim({col})"
    return (f"CASE WHEN regexp_matches({t}, '{STORE_RE}') THEN upper(regexp_extract({t}, '{STORE_RE}', 1)) "
            f"ELSE upper({col}) END AS sort_prefix, "
            f"CASE WHEN regexp_matches({t}, '{STORE_RE}') THEN CAST(regexp_extract({t}, '{STORE_RE}', 2) AS DECIMAL(38,0)) "
            f"ELSE CAST(0 AS DECIMAL(38,0)) END AS sort_number")


def _shelf_life() -> str:
    base = ("CASE grade WHEN 'high' THEN CAST(15 AS DOUBLE) WHEN 'medium' THEN CAST(10 AS DOUBLE) "
            "WHEN 'low' THEN CAST(5 AS DOUBLE) ELSE CAST(7 AS DOUBLE) END")
    temp = ("CASE WHEN temperature > CAST(40 AS DOUBLE) THEN CAST(0.2 AS DOUBLE) * (temperature - CAST(40 AS DOUBLE)) "
            "ELSE CAST(0 AS DOUBLE) END")
    ph = ("CASE WHEN ph < CAST(6.8 AS DOUBLE) THEN CAST(0.5 AS DOUBLE) * (CAST(6.8 AS DOUBLE) - ph) "
          "ELSE CAST(0 AS DOUBLE) END")
    v = f"round_even({base} + ((CAST(0 AS DOUBLE) - {temp}) - {ph}), 0)"
    return with_ctes(["quality_clean"], f"""SELECT batch_id, grade, ph, temperature,
  CAST(CASE WHEN {v} < 2 THEN 2 WHEN {v} > 20 THEN 20 ELSE {v} END AS INTEGER) AS shelf_life_days
FROM quality_clean""")


def _bytes_to_int() -> str:
    return """SELECT l_orderkey, l_linenumber, CAST(CASE WHEN l_linenumber = 7 THEN 0 WHEN l_linenumber <> 6 THEN l_orderkey END
  AS BIGINT) AS batch_id FROM lineitem"""


def _forecast_stocked() -> str:
    """The baseline forecast over daily rows with the query's stock, capacity and expiry changes."""
    stocked = """SELECT * REPLACE (
  CASE WHEN product_id <= 2 THEN available_stock + 5000 ELSE available_stock END AS available_stock,
  CASE WHEN product_id = 3 THEN 0 WHEN product_id = 4 THEN CAST(units_sold = 1 AS BIGINT) ELSE max_capacity_per_day_liters END
    AS max_capacity_per_day_liters,
  CASE WHEN product_id >= 4 THEN days_to_expiration + 4 ELSE days_to_expiration END AS days_to_expiration) FROM psd"""
    scalars = VIEWS["ss"].replace("FROM psd", "FROM stocked")
    return with_ctes(["psd", "base"], "SELECT * FROM fc", [("stocked", stocked), ("ss", scalars), *forecast_ctes("", 30)])


def _holt_winters_fixed() -> str:
    """Additive Holt-Winters recursion (alpha 0.3, beta 0.05, gamma 0.1), weekly season from 14 values on."""
    a, b = "CAST(0.3 AS DOUBLE)", "CAST(0.05 AS DOUBLE)"
    one = "CAST(1 AS DOUBLE)"
    both = """SELECT 'daily' AS kind, product_id, store_id, date, CAST(units_sold AS DOUBLE) AS y FROM psd
UNION ALL SELECT 'yearly', product_id, store_id, date_trunc('year', date), CAST(sum(units_sold) AS DOUBLE) FROM psd GROUP BY ALL"""
    hist = """SELECT kind, product_id, store_id, CAST(count(*) AS INTEGER) AS n, list(y ORDER BY date) AS h
FROM series GROUP BY kind, product_id, store_id"""
    s0 = "s[t % 7 + 1]"
    level = f"({a} * (h[t + 1] - {s0}) + ({one} - {a}) * (l + b))"
    hw = f"""SELECT kind, product_id, store_id, n, h, 0 AS t,
  CASE WHEN n >= 14 THEN list_sum(h[1:7]) / CAST(7 AS DOUBLE) ELSE h[1] END AS l, CAST(0 AS DOUBLE) AS b,
  CASE WHEN n >= 14 THEN list_transform(h[1:7], lambda v: v - list_sum(h[1:7]) / CAST(7 AS DOUBLE))
    ELSE list_transform(range(7), lambda v: CAST(0 AS DOUBLE)) END AS s,
  CASE WHEN n >= 14 THEN CAST(0.1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS g
FROM hist
UNION ALL
SELECT kind, product_id, store_id, n, h, t + 1, {level}, {b} * ({level} - l) + ({one} - {b}) * b,
  list_transform(range(7), lambda k: CASE WHEN k = t % 7 THEN g * (h[t + 1] - (l + b)) + ({one} - g) * {s0} ELSE s[k + 1] END), g
FROM hw WHERE t < n"""
    body = """SELECT kind, product_id, store_id, n AS n_values, CAST(step AS INTEGER) AS step,
  round(l + CAST(step AS DOUBLE) * b + s[(n + step - 1) % 7 + 1], 6) AS forecast
FROM hw, range(1, 11) r(step) WHERE t = n"""
    return with_ctes(["psd"], body, [("series", both), ("hist", hist), ("hw", hw)]).replace("WITH ", "WITH RECURSIVE ", 1)


def holt_winters_ctes(p: str, daily: str, least_days: int = 30, grid: list | None = None, rounds: int = holt_winters.ROUNDS) -> list[tuple[str, str]]:
    """The fit of every series of ``daily``: a recursion over its days for each point, first of the grid, then of the rounds.

    ``{p}fit`` holds the best point's state; a series has at least ``least_days`` (14 or more) days.
    """
    def num(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"

    key, ring = "product_id, store_id", [f"s{i}" for i in range(1, 8)]
    state = f"l, tr, {', '.join(ring)}, sse"
    mean = "list_sum(h[1:7]) / CAST(7 AS DOUBLE)"
    out = [
        (f"{p}hist", f"SELECT {key}, CAST(count(*) AS INTEGER) AS n, list(CAST(units_sold AS DOUBLE) ORDER BY date) AS h FROM {daily} "
                     f"GROUP BY {key} HAVING count(*) >= {least_days}"),
        (f"{p}ys", f"SELECT {key}, n, CAST(unnest(range(n)) AS INTEGER) AS t, unnest(h) AS v FROM {p}hist"),
        (f"{p}start", f"SELECT {key}, n, {mean} AS l, CAST(0 AS DOUBLE) AS tr, {', '.join(f'h[{i + 1}] - {mean} AS {s}' for i, s in enumerate(ring))}, "
                      f"CAST(0 AS DOUBLE) AS sse FROM {p}hist"),
        (f"{p}p0", "SELECT * FROM (VALUES " + ", ".join("(" + ", ".join(map(num, point)) + ")" for point in grid or itertools.product(
            holt_winters.ALPHA_GRID, holt_winters.BETA_GRID, holt_winters.GAMMA_GRID)) + ") g(a, b, g)"),
    ]
    for k in range(rounds + 1):
        if k:
            def moved(x: str, by: str, step: float) -> str:
                return f"least(greatest({x} + CAST({by} AS DOUBLE) * {num(step / 2 ** (k - 1))}, CAST(0 AS DOUBLE)), CAST(1 AS DOUBLE)) AS {x}"

            moves = ", ".join(moved(x, by, step) for x, by, step in zip("abg", ("i", "j", "m"), holt_winters.STEPS))
            out.append((f"{p}p{k}", f"SELECT DISTINCT {key}, {moves} FROM {p}b{k - 1}, range(-1, 2) x(i), range(-1, 2) y(j), range(-1, 2) z(m)"))
        on = f"{p}start" + (f" JOIN {p}p{k} USING ({key})" if k else f", {p}p0")
        out.append((f"{p}f{k}", f"""SELECT {key}, n, a, b, g, 0 AS t, {state} FROM {on}
UNION ALL
SELECT {key}, n, a, b, g, t + 1, (l + tr) + a * e, tr + (a * b) * e, {', '.join(ring[1:])}, s1 + g * e, sse + e * e
FROM (SELECT f.*, y.v - ((f.l + f.tr) + f.s1) AS e FROM {p}f{k} f JOIN {p}ys y ON y.product_id = f.product_id AND y.store_id = f.store_id AND y.t = f.t)"""))
        before = f" UNION ALL SELECT * FROM {p}b{k - 1}" if k else ""
        out.append((f"{p}b{k}", f"""SELECT {key}, a, b, g, {state} FROM (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY sse, a, b, g) AS place
  FROM (SELECT {key}, a, b, g, {state} FROM {p}f{k} WHERE t = n{before})) WHERE place = 1"""))
    out.append((f"{p}fit", f"SELECT * FROM {p}b{rounds}"))
    return out


def ets_value(step: str) -> str:
    """The forecast ``step`` days ahead from ``{p}fit``'s columns, clipped at 0."""
    return f"greatest((l + CAST({step} AS DOUBLE) * tr) + [s1, s2, s3, s4, s5, s6, s7][({step} - 1) % 7 + 1], CAST(0 AS DOUBLE))"


def _holt_winters() -> str:
    """K4 with the fitted model: as the baseline forecast, but for the values."""
    chain = dict(forecast_ctes("", 30))
    chain["vals"] = f"""SELECT r.product_id, r.store_id, r.forecast_date, r.step,
  CASE WHEN x.l IS NULL THEN coalesce(b.baseline, CAST(0 AS DOUBLE)) ELSE {ets_value("r.step")} END AS forecasted_sales
FROM rem r LEFT JOIN base b ON r.product_id = b.product_id AND r.store_id = b.store_id
LEFT JOIN fit x ON r.product_id = x.product_id AND r.store_id = x.store_id"""
    return with_ctes(FORECAST_VIEWS, "SELECT * FROM fc", [*holt_winters_ctes("", "psd"), *chain.items()]).replace("WITH ", "WITH RECURSIVE ", 1)


def _forecast_compact(done: int = 20) -> str:
    """The fitted model over the days after ``done``, whose steps are counted from 1 again."""
    chain = dict(forecast_ctes("", 30, done))
    chain["vals"] = f"""SELECT r.product_id, r.store_id, r.forecast_date, r.step,
  CASE WHEN x.l IS NULL THEN coalesce(b.baseline, CAST(0 AS DOUBLE)) ELSE {ets_value(f"(r.step - {done})")} END AS forecasted_sales
FROM rem r LEFT JOIN base b ON r.product_id = b.product_id AND r.store_id = b.store_id
LEFT JOIN fit x ON r.product_id = x.product_id AND r.store_id = x.store_id"""
    return with_ctes(FORECAST_VIEWS, "SELECT * FROM fc", [*holt_winters_ctes("", "psd"), *chain.items()]).replace("WITH ", "WITH RECURSIVE ", 1)


def _stream_forecast(cuts: tuple[str, ...] = ("1996-01-01", "1996-01-11", "9999-01-01"), horizon: int = 30) -> str:
    """After each load, the forecast of the series it touched, over all days so far, for days not forecast before."""
    extra, found = [], []
    for k, cut in enumerate(cuts):
        extra.append((f"psd{k}", f"SELECT * FROM psd WHERE date < DATE '{cut}'"))
        extra += [(f"{name}{k}", re.sub(r"\bpsd\b", f"psd{k}", VIEWS[name])) for name in ("ss", "base")]
        extra += holt_winters_ctes(f"w{k}", f"psd{k}", grid=[(0.3, 0.05, 0.1)], rounds=0)
        chain = dict(forecast_ctes(f"k{k}", horizon))
        chain[f"k{k}rem"] = f"SELECT * FROM k{k}fut" if not k else f"""SELECT f.* FROM k{k}fut f LEFT JOIN ss{k - 1} x USING (product_id, store_id)
WHERE (x.last_date IS NULL OR f.forecast_date > x.last_date + {horizon})
  AND EXISTS (SELECT 1 FROM psd{k} n WHERE n.product_id = f.product_id AND n.store_id = f.store_id AND n.date >= DATE '{cuts[k - 1]}')"""
        chain[f"k{k}vals"] = f"""SELECT r.product_id, r.store_id, r.forecast_date, r.step,
  CASE WHEN x.l IS NULL THEN coalesce(b.baseline, CAST(0 AS DOUBLE)) ELSE {ets_value("r.step")} END AS forecasted_sales
FROM k{k}rem r LEFT JOIN base b ON r.product_id = b.product_id AND r.store_id = b.store_id
LEFT JOIN w{k}fit x ON r.product_id = x.product_id AND r.store_id = x.store_id"""
        extra += [(name, re.sub(r"\bbase\b", f"base{k}", re.sub(r"\bss\b", f"ss{k}", sql))) for name, sql in chain.items()]
        found.append(f"""SELECT product_id, store_id, forecast_date, expiration_risk, round(forecasted_sales, 6) AS forecasted_sales,
  round(predicted_waste, 6) AS predicted_waste, round(suggested_production, 6) AS suggested_production,
  round(predicted_logistics_cost, 6) AS predicted_logistics_cost FROM k{k}fc""")
    return with_ctes(["psd"], "\nUNION ALL ".join(found), extra).replace("WITH ", "WITH RECURSIVE ", 1)


def _heatmap() -> str:
    cols = ", ".join(f"coalesce(max(CASE WHEN store_id = '{s}' THEN risk_score END), 0) AS \"{s}\"" for s in STORES)
    return with_ctes(["risk", "pmap"], f"""SELECT x.product_id, {LABEL_NAME} AS product, {", ".join(f'x."{s}"' for s in STORES)}
FROM (SELECT product_id, {cols} FROM risk GROUP BY product_id) x LEFT JOIN pmap m ON x.product_id = m.product_id""")


def _labels() -> str:
    name = initcap("coalesce(product_type, 'Product ' || CAST(product_id AS VARCHAR))")
    return with_ctes(["pmap"], f"""SELECT product_id, {name} AS product_name,
  CAST(product_id AS VARCHAR) || ' • ' || {name} AS product_label FROM pmap""")


def _plan() -> str:
    label = f"CAST(x.product_id AS VARCHAR) || ' • ' || {LABEL_NAME}"
    return fc_sql(f"""SELECT x.forecast_date AS "Date", {label} AS "Product", x.store_id AS "Store",
  x.suggested_production AS "Suggested Production (L/day)"
FROM fcw x LEFT JOIN pmap m ON x.product_id = m.product_id""", more=fcw_ctes(), views=["pmap"])


def _drilldown() -> str:
    return with_ctes(["curated"], """SELECT batch_id AS "Batch ID", product_id AS "Product", store_id AS "Store",
  strftime(date, '%Y-%m-%d') AS "Date", strftime(production_date, '%Y-%m-%d') AS "Production Date",
  shelf_life_days AS "Shelf-life (days)", days_to_expiration AS "Days to Expiration",
  available_stock AS "Available Stock (L)", warehouse_location AS "Warehouse",
  storage_temperature_c AS "Storage Temp (ºC)", transport_temperature_c AS "Transport Temp (ºC)",
  energy_consumption_kwh AS "Energy (kWh)"
FROM (SELECT *, row_number() OVER (PARTITION BY batch_id, date, store_id ORDER BY product_id NULLS LAST) AS rn
      FROM curated) WHERE rn = 1""")


CUR_STOCK_ASOF = "(SELECT coalesce(CAST(sum(available_stock) AS DOUBLE), CAST(0 AS DOUBLE)) FROM curated WHERE date = (SELECT max(date) FROM curated))"
LOADED = "SELECT * FROM production WHERE production_date < DATE '1998-01-01'"
NEW_BY_DATE = ("SELECT * FROM production WHERE (SELECT max(production_date) FROM loaded) IS NULL "
               "OR production_date > (SELECT max(production_date) FROM loaded)")


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    # sources, sinks, table maintenance
    q["scan_sales"] = with_ctes(["sales"], "SELECT * FROM sales")
    q["quality_clean"] = with_ctes(["quality_clean"], "SELECT * FROM quality_clean")
    export = """SELECT product_id, store_id, strftime(forecast_date, '%Y-%m-%d') AS forecast_date,
  coalesce(forecasted_sales, 0.0) AS forecasted_sales, coalesce(predicted_waste, 0.0) AS predicted_waste,
  coalesce(suggested_production, 0.0) AS suggested_production, coalesce(expiration_risk, 0) AS expiration_risk,
  coalesce(predicted_logistics_cost, 0.0) AS predicted_logistics_cost FROM fc"""
    q["forecast_export"] = fc_sql(export)
    upsert = """SELECT * FROM fc WHERE NOT EXISTS (SELECT 1 FROM newer n WHERE n.product_id = fc.product_id
  AND n.store_id = fc.store_id AND n.forecast_date = fc.forecast_date)
UNION ALL SELECT * FROM newer"""
    newer = """SELECT n.* FROM n_fc n JOIN ss s ON n.product_id = s.product_id AND n.store_id = s.store_id
WHERE n.forecast_date > s.last_date + 20"""
    q["forecast_upsert"] = with_ctes(FORECAST_VIEWS, upsert,
                                     forecast_ctes("", 30) + forecast_ctes("n_", 40) + [("newer", newer)])
    fallback = """SELECT * FROM fc WHERE CASE WHEN (SELECT min(forecast_date) FROM fc WHERE forecast_date >= DATE '2001-08-20') IS NOT NULL
  THEN forecast_date BETWEEN (SELECT min(forecast_date) FROM fc WHERE forecast_date >= DATE '2001-08-20')
       AND (SELECT min(forecast_date) FROM fc WHERE forecast_date >= DATE '2001-08-20') + 29
  ELSE forecast_date BETWEEN (SELECT max(forecast_date) FROM fc) - 29 AND (SELECT max(forecast_date) FROM fc) END"""
    q["forecast_fallback"] = fc_sql(fallback)
    q["new_batches"] = with_ctes(["production"], "SELECT * FROM new_rows", [("loaded", LOADED), ("new_rows", NEW_BY_DATE)])
    q["append_union"] = with_ctes(["production"], """SELECT * FROM loaded
UNION ALL SELECT batch_id, product_id, product_type, production_date, production_hour, NULL AS grade, shelf_life_days
FROM new_rows""", [("loaded", LOADED), ("new_rows", NEW_BY_DATE)])
    q["last_date"] = with_ctes(["production"], "SELECT coalesce(max(production_date), DATE '2025-01-01') AS last_date FROM production")
    seed = " UNION ALL ".join(f"SELECT CAST({i + 1} AS BIGINT) AS product_id, '{t}' AS product_type"
                              for i, t in enumerate([*PRODUCT_TYPES, *(f"{t} organic" for t in PRODUCT_TYPES)]))
    q["ensure_dimension"] = with_ctes(["product_catalog"], """SELECT * FROM product_catalog
UNION ALL SELECT * FROM seed s WHERE NOT EXISTS (SELECT 1 FROM product_catalog c WHERE c.product_id = s.product_id)""",
                                      [("seed", seed)])
    q["assign_ids"] = with_ctes(["production"], """SELECT batch_id AS source_batch_id, product_id, production_date,
  CAST((SELECT coalesce(max(batch_id), 0) FROM loaded)
       + row_number() OVER (ORDER BY production_date, batch_id) AS BIGINT) AS new_batch_id
FROM production WHERE production_date >= DATE '1998-01-01'""", [("loaded", LOADED)])
    # projections, coercions, scalar functions
    q["normalize_names"] = ("SELECT l_orderkey AS batch_id, l_partkey AS product_id, l_linenumber AS line_number, "
                            "l_quantity AS units FROM lineitem")
    q["alias_columns"] = with_ctes(["sales"], """SELECT batch_id, product_id, store_id, sale_date AS date, sale_hour,
  coalesce(units_sold, 0) AS units_sold FROM sales
WHERE batch_id IS NOT NULL AND product_id IS NOT NULL AND sale_date IS NOT NULL AND store_id IS NOT NULL""")
    q["default_columns"] = with_ctes(["sales"], """SELECT batch_id, product_id, store_id, sale_date AS date,
  coalesce(units_sold, 0) AS units_sold, 12 AS sale_hour, 0 AS promotion_flag, CAST(1.0 AS DOUBLE) AS seasonality_factor
FROM sales WHERE batch_id IS NOT NULL AND product_id IS NOT NULL AND sale_date IS NOT NULL AND store_id IS NOT NULL""")
    q["coerce_ids"] = with_ctes(["parsed_raw"], "SELECT l_orderkey, l_linenumber, batch_id, product_id FROM parsed_raw")
    q["bytes_to_int"] = _bytes_to_int()
    q["parse_dates"] = with_ctes(["parsed_raw"], "SELECT l_orderkey, l_linenumber, sale_date FROM parsed_raw")
    q["parse_numbers"] = with_ctes(["parsed_raw"], "SELECT l_orderkey, l_linenumber, units_value FROM parsed_raw")
    q["units_int"] = with_ctes(["parsed_raw"], """SELECT l_orderkey, l_linenumber,
  CAST(trunc(coalesce(units_value, CAST(0 AS DOUBLE))) AS BIGINT) AS units_sold FROM parsed_raw""")
    q["clip_range"] = with_ctes(["quality"], """SELECT batch_id,
  CASE WHEN taste < 0 THEN 0 WHEN taste > 1 THEN 1 ELSE taste END AS taste,
  CASE WHEN odor < 0 THEN 0 WHEN odor > 1 THEN 1 ELSE odor END AS odor,
  CASE WHEN fat < 0 THEN 0 WHEN fat > 1 THEN 1 ELSE fat END AS fat,
  CASE WHEN turbidity < 0 THEN 0 WHEN turbidity > 1 THEN 1 ELSE turbidity END AS turbidity,
  CASE WHEN colour < 0 THEN 0 WHEN colour > 255 THEN 255 ELSE colour END AS colour FROM quality""")
    q["shelf_life"] = _shelf_life()
    q["weekday_factor"] = with_ctes(["sales"], """SELECT date, CASE WHEN isodow(date) IN (5, 6) THEN CAST(1.1 AS DOUBLE)
  ELSE CAST(1.0 AS DOUBLE) END AS demand_factor FROM (SELECT DISTINCT sale_date AS date FROM sales)""")
    q["expiry_date"] = with_ctes(["catalog"], """SELECT batch_id, production_date, shelf_life_days,
  production_date + CAST(coalesce(shelf_life_days, 0) AS INTEGER) AS expiry_date FROM catalog""")
    q["product_labels"] = _labels()
    q["natural_sort"] = with_ctes(["curated"], f"""SELECT store_id, {_natural_sort_cols('store_id')}
FROM (SELECT DISTINCT CAST(store_id AS VARCHAR) AS store_id FROM curated WHERE store_id IS NOT NULL)""")
    # filters
    q["drop_nulls"] = with_ctes(["parsed_raw"], """SELECT l_orderkey, l_linenumber, batch_id, product_id, sale_date
FROM parsed_raw WHERE batch_id IS NOT NULL AND product_id IS NOT NULL AND sale_date IS NOT NULL""")
    q["catalog"] = with_ctes(["catalog"], "SELECT * FROM catalog")
    q["filtered_view"] = with_ctes(["curated"], """SELECT batch_id, product_id, store_id, date, units_sold, available_stock
FROM curated WHERE product_id = 3 AND CAST(store_id AS VARCHAR) = 'S7'""")
    q["horizon"] = fc_sql("SELECT * FROM fcw", more=fcw_ctes())
    q["incremental_dates"] = fc_sql("SELECT product_id, store_id, forecast_date, step FROM rem", done=20)
    q["non_iso_dates"] = _non_iso()
    # joins
    q["curated_join_catalog"] = with_ctes(["j_catalog"], "SELECT * FROM j_catalog")
    q["curated_join_inventory"] = with_ctes(["j_inventory"], "SELECT * FROM j_inventory")
    q["curated_join_factory"] = with_ctes(["j_factory"], "SELECT * FROM j_factory")
    q["curated_join_logistics"] = with_ctes(["j_logistics"], "SELECT * FROM j_logistics")
    q["join_health"] = _join_health()
    q["orphan_checks"] = _orphans()
    q["produced_quantity"] = with_ctes(["production", "inventory"], """SELECT p.batch_id, p.product_id,
  CAST(coalesce(i.initial_stock_liters, 0) AS BIGINT) AS quantity_produced_liters
FROM production p LEFT JOIN inventory i ON p.batch_id = i.batch_id AND p.product_id = i.product_id""")
    q["batch_stock"] = with_ctes(["production", "inventory"], """SELECT p.batch_id, p.product_id,
  CAST(coalesce(i.current_stock_liters, 0) AS BIGINT) AS current_stock_liters
FROM production p LEFT JOIN inventory i ON p.batch_id = i.batch_id AND p.product_id = i.product_id""")
    # aggregations
    q["daily_sales"] = with_ctes(["daily_sales"], "SELECT * FROM daily_sales")
    q["daily_logistics"] = with_ctes(["daily_logistics"], "SELECT * FROM daily_logistics")
    q["product_store_daily"] = with_ctes(["psd"], "SELECT * FROM psd")
    q["history_length"] = with_ctes(["psd"], "SELECT product_id, store_id, count(*) AS n_days FROM psd GROUP BY ALL")
    q["series_scalars"] = with_ctes(["ss"], "SELECT * FROM ss")
    q["product_map"] = with_ctes(["pmap"], "SELECT * FROM pmap")
    q["kpi_overview"] = fc_sql(f"""SELECT {exact_sum0('forecasted_sales')} AS total_forecast_units,
  {exact_sum0('predicted_waste')} AS total_predicted_waste,
  (SELECT CAST(count_if(days_to_expiration <= 3) AS BIGINT) FROM curated) AS near_expiration_rows,
  (SELECT coalesce(CAST(sum(available_stock) AS DOUBLE), CAST(0 AS DOUBLE)) FROM curated) AS current_available_stock
FROM fcw""", more=fcw_ctes())
    q["forecast_daily"] = fc_sql(f"""SELECT forecast_date, CAST(sum(CAST(forecasted_sales AS {EXACT})) AS DOUBLE)
  AS forecasted_units FROM fcw GROUP BY forecast_date""", more=fcw_ctes())
    q["risk_pairs"] = with_ctes(["risk"], "SELECT * FROM risk")
    q["kpi_sustainability"] = with_ctes(["curated"], f"""SELECT
  coalesce({exact_avg('energy_consumption_kwh / nullif(quantity_produced_liters, 0)')}, CAST(0 AS DOUBLE))
    AS factory_kwh_per_liter,
  coalesce({exact_avg('transport_temperature_c')}, CAST(0 AS DOUBLE)) AS avg_transport_temperature_c,
  (SELECT coalesce(avg(e), CAST(0 AS DOUBLE)) FROM per_day) AS avg_daily_energy_kwh,
  (SELECT coalesce(avg(e_log), CAST(0 AS DOUBLE)) FROM per_day) AS avg_daily_logistics_energy_kwh
FROM curated""", [("per_day", """SELECT date, coalesce(sum(energy_consumption_kwh), 0) AS e,
  coalesce(sum(energy_consumption_kwh_log), 0) AS e_log FROM curated WHERE date IS NOT NULL GROUP BY date""")])
    q["filter_options"] = with_ctes(["curated", "pmap"], """SELECT 'store' AS kind, store_id AS value
FROM (SELECT DISTINCT CAST(store_id AS VARCHAR) AS store_id FROM curated WHERE store_id IS NOT NULL)
UNION ALL SELECT 'product' AS kind, CAST(product_id AS VARCHAR) AS value FROM (SELECT DISTINCT product_id FROM pmap)""")
    q["row_counts"] = _row_counts()
    q["type_histogram"] = _type_histogram()
    q["date_ranges"] = _date_ranges()
    q["pk_duplicates"] = _pk_duplicates()
    # windows
    q["baseline_mean"] = with_ctes(["base"], "SELECT * FROM base")
    q["projected_stock"] = fc_sql(f"""SELECT forecast_date AS date, CAST(d AS DOUBLE) AS forecasted_units,
  CAST(sum(d) OVER (ORDER BY forecast_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
    AS cumulative_forecast,
  CASE WHEN {CUR_STOCK_ASOF} - CAST(sum(d) OVER (ORDER BY forecast_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) > 0
       THEN {CUR_STOCK_ASOF} - CAST(sum(d) OVER (ORDER BY forecast_date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE)
       ELSE CAST(0 AS DOUBLE) END AS projected_stock
FROM (SELECT forecast_date, sum(CAST(forecasted_sales AS {EXACT})) AS d FROM fcw GROUP BY forecast_date)""",
                                  more=fcw_ctes())
    q["asof_stock"] = with_ctes(["curated"], f"SELECT {CUR_STOCK_ASOF} AS asof_stock")
    # sort / limit / sample
    q["production_plan"] = _plan()
    q["non_iso_samples"] = with_ctes(["raw_sales_text"], r"""SELECT sale_date FROM raw_sales_text
WHERE sale_date IS NOT NULL AND NOT regexp_full_match(sale_date, '\d{4}-\d{2}-\d{2}') ORDER BY sale_date LIMIT 5""")
    q["key_range"] = with_ctes(["production"], "SELECT * FROM production WHERE batch_id BETWEEN 1000 AND 9000")
    filled = """SELECT * REPLACE (coalesce(initial_stock_liters, 0) AS initial_stock_liters, coalesce(current_stock_liters, 0) AS current_stock_liters)
FROM j_inventory"""
    chain = [("j_filled", filled), ("z_factory", VIEWS["j_factory"].replace("j_inventory", "j_filled")),
             ("z_logistics", VIEWS["j_logistics"].replace("j_factory", "z_factory")),
             ("z1", VIEWS["cur1"].replace("j_logistics", "z_logistics")), ("z2", VIEWS["cur2"].replace("cur1", "z1")),
             ("z", VIEWS["curated"].replace("cur2", "z2"))]
    q["curated_zero_stock"] = with_ctes(["j_inventory", "factory", "daily_logistics"], """SELECT batch_id, product_id, store_id, date,
  units_sold, initial_stock_liters, available_stock, suggested_production, expiration_risk FROM z""", chain)
    q["quality_csv"] = with_ctes(["quality_clean"], "SELECT * FROM quality_clean")
    q["curated_by_month"] = with_ctes(["curated"], "SELECT * FROM curated WHERE date BETWEEN DATE '1995-03-10' AND DATE '1996-02-05'")
    q["product_map_competing"] = with_ctes(["graded"], "SELECT * FROM graded")
    q["type_histogram_raw"] = with_ctes(["raw_sales_text"], _union([
        f"SELECT 'raw' AS table_name, '{c}' AS column_name, {_value_type(c, None)} AS value_type, count(*) AS n FROM raw_sales_text GROUP BY ALL"
        for c in ("batch_id", "product_id", "sale_date", "units")]))
    q["daily_absent_inputs"] = with_ctes(["psd"], """SELECT * REPLACE (CAST(0 AS BIGINT) AS max_capacity_per_day_liters,
  CAST(0 AS DOUBLE) AS energy_consumption_kwh, CAST(0 AS DOUBLE) AS transport_time_hours) FROM psd""")
    q["forecast_stocked"] = _forecast_stocked()
    q["holt_winters"] = _holt_winters()
    q["forecast_compact"] = _forecast_compact()
    q["forecast_migration"] = fc_sql("SELECT * FROM fc")
    q["forecast_month_upsert"] = q["forecast_upsert"]
    q["curated_bucketed"] = with_ctes(["curated"], "SELECT * FROM curated")
    unknown = [("unknown", "SELECT * REPLACE (CASE WHEN sale_hour % 4 <> 1 THEN store_id END AS store_id) FROM sales")]
    q["daily_sales_null_store"] = with_ctes(["sales"], re.sub(r"FROM sales\b", "FROM unknown", VIEWS["daily_sales"]), unknown)
    q["rejected_dates"] = with_ctes(["raw_sales_text", "parsed_raw"], """SELECT 'sales' AS table_name, 'sale_date' AS column_name, n_values,
  n_values - n_read AS n_rejected FROM (SELECT count(sale_date) AS n_values FROM raw_sales_text), (SELECT count(sale_date) AS n_read FROM parsed_raw)""")
    q["holt_winters_fixed"] = _holt_winters_fixed()
    q["seeded_sample"] = with_ctes(["quality"], "SELECT * FROM quality ORDER BY md5(concat_ws('-', batch_id, '42')), batch_id LIMIT 100")
    q["stored_legacy_sales"] = with_ctes(["daily_sales"], "SELECT * FROM daily_sales")
    q["stored_legacy_logistics"] = with_ctes(["daily_logistics"], "SELECT * FROM daily_logistics")
    q["table_sample"] = with_ctes(["sales"], """SELECT * FROM sales ORDER BY batch_id, product_id, store_id, sale_date,
  sale_hour, units_sold, promotion_flag, seasonality_factor LIMIT 5""")
    # reshaping
    q["risk_heatmap"] = _heatmap()
    q["future_dates"] = fc_sql("SELECT product_id, store_id, forecast_date, step FROM fut")
    # business derivations
    q["curated_sales"] = with_ctes(["curated"], "SELECT * FROM curated")
    q["batch_drilldown"] = _drilldown()
    # forecasting
    q["baseline_forecast"] = fc_sql("SELECT product_id, store_id, forecast_date, forecasted_sales FROM fc")
    q["model_choice"] = with_ctes(["ss"], """SELECT product_id, store_id, n_days,
  CASE WHEN n_days >= 950 THEN 'ets' ELSE 'baseline' END AS model FROM ss""")
    q["forecast_rows"] = fc_sql("SELECT * FROM fc", done=20)
    # streaming (final state equals the batch daily aggregation)
    q["stream_late_orders"] = with_ctes(["daily_sales"], "SELECT * FROM daily_sales")
    q["stream_forecast"] = _stream_forecast()
    q["stream_daily_sales"] = with_ctes(["daily_sales"], "SELECT * FROM daily_sales")
    # data quality
    q["constraint_checks"] = _constraints()
    q["quality_report"] = _quality_report()
    q["inspection_samples"] = _inspection_samples()
    q["stored_statistics"] = _stored_statistics()
    q["forecast_json_roundtrip"] = fc_sql("""SELECT product_id, store_id, forecast_date,
  coalesce(forecasted_sales, 0.0) AS forecasted_sales, coalesce(predicted_waste, 0.0) AS predicted_waste,
  coalesce(suggested_production, 0.0) AS suggested_production, coalesce(expiration_risk, 0) AS expiration_risk,
  coalesce(predicted_logistics_cost, 0.0) AS predicted_logistics_cost FROM fc""")
    return q
