"""Metric-store queries over the driver tables and their DuckDB oracles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tessera.plans import metrics as M
from tessera.plans.bindings import PANEL_WIDTH, metric_store
from tessera.plans.registry import register
from tessera.sources.tables import Tables

# Parameters of the registered calls (the demo-call matrix of the original functions).
PERSON = 7
FIND_LAST = "Customer#000000007"
FIND_FIRST = "MACHINERY"
METRICS = "metric_1,metric_2,metric_4,metric_99"   # two panels, one unknown name
SHOWN = ["metric_1", "metric_2", "metric_4"]
START = dt.datetime(2024, 1, 5, 0, 0, 0)
END = dt.datetime(2024, 1, 20, 12, 0, 0)
END_ONLY = dt.datetime(2024, 1, 15, 0, 0, 0)
START_ONLY = dt.datetime(2024, 1, 10, 6, 0, 0)
FORMULA = {"metric_formula": "metric_1 + 2 * metric_4"}

_BASE = f"""
WITH cat AS (
  SELECT event_type, CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS metric_id
  FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL)),
ev AS (
  SELECT e.user_id AS customer_id, e.ts AS metric_timestamp, c.metric_id,
         CAST(e.value AS DECIMAL(18,2)) AS v
  FROM events e LEFT JOIN cat c ON e.event_type = c.event_type),
p1 AS (
  SELECT customer_id, metric_timestamp,
         CASE WHEN metric_id = 1 THEN v END AS metric_1,
         CASE WHEN metric_id = 2 THEN v END AS metric_2,
         CASE WHEN metric_id = 3 THEN v END AS metric_3
  FROM ev),
p2 AS (
  SELECT customer_id, metric_timestamp,
         CASE WHEN metric_id = 4 THEN v END AS metric_4,
         CASE WHEN metric_id = 5 THEN v END AS metric_5
  FROM ev),
j AS (SELECT * FROM p1 JOIN p2 USING (customer_id, metric_timestamp)),
pc AS (SELECT c.c_custkey AS customer_id, n.n_name AS city
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey)
"""
assert PANEL_WIDTH == 3  # the oracle above spells out panels of three


def _ts(x: dt.datetime) -> str:
    return f"TIMESTAMP '{x:%Y-%m-%d %H:%M:%S}'"


def _where(start=None, end=None, person=None) -> str:
    c = ["TRUE"]
    if person is not None:
        c.append(f"customer_id = {person}")
    if start is not None:
        c.append(f"metric_timestamp >= {_ts(start)}")
    if end is not None:
        c.append(f"metric_timestamp <= {_ts(end)}")
    return " AND ".join(c)


def _doc(summed: bool, formula: bool = False) -> str:
    if summed:
        parts = [f"'{m}_sum', SUM({m})" for m in SHOWN]
        if formula:
            parts.append("'metric_formula_sum', SUM(metric_1 + 2 * metric_4)")
    else:
        parts = [f"'{m}', {m}" for m in SHOWN]
        if formula:
            parts.append("'metric_formula', metric_1 + 2 * metric_4")
    return "json_object(" + ", ".join(parts) + ")"


_UNIT = {"DY": "day", "WK": "week", "MO": "month"}


def _person_sql(agg=None, start=None, end=None) -> str:
    w = _where(start, end, PERSON)
    if agg is None:
        return _BASE + f"SELECT metric_timestamp AS result_time, {_doc(False)} AS result FROM j WHERE {w}"
    return _BASE + (f"SELECT date_trunc('{_UNIT[agg]}', metric_timestamp) AS result_time, {_doc(True)} AS result "
                    f"FROM j WHERE {w} GROUP BY 1")


def _city_sql(agg=None, start=None, end=None, formula=False) -> str:
    w = _where(start, end)
    src = "j JOIN pc USING (customer_id)"
    if agg is None:
        return _BASE + f"SELECT city, metric_timestamp AS result_time, {_doc(False, formula)} AS result FROM {src} WHERE {w}"
    t = "TIMESTAMP '9999-12-31 00:00:00'" if agg == "ALL" else f"date_trunc('{_UNIT[agg]}', metric_timestamp)"
    return _BASE + (f"SELECT city, {t} AS result_time, {_doc(True, formula)} AS result "
                    f"FROM {src} WHERE {w} GROUP BY 1, 2")


def _store(spark: SparkSession, d: str):
    return metric_store(Tables(spark, d))


def _person(name, agg=None, start=None, end=None):
    @register(name, _person_sql(agg, start, end))
    def q(spark: SparkSession, d: str) -> DataFrame:
        return M.customer_metrics(_store(spark, d), PERSON, METRICS, start, end, agg)
    return q


def _city(name, agg=None, start=None, end=None):
    @register(name, _city_sql(agg, start, end))
    def q(spark: SparkSession, d: str) -> DataFrame:
        return M.city_metrics(_store(spark, d), METRICS, start, end, agg)
    return q


_person("person_metrics_raw")
_person("person_metrics_range", None, START, END)
_person("person_metrics_dy", "DY")
_person("person_metrics_wk", "WK")
_person("person_metrics_mo", "MO")
_person("person_metrics_onesided", "DY", None, END_ONLY)
_city("city_metrics_raw")
_city("city_metrics_endonly_raw", None, None, END_ONLY)
_city("city_metrics_dy", "DY")
_city("city_metrics_wk", "WK", START_ONLY, None)
_city("city_metrics_mo", "MO")
_city("city_metrics_all", "ALL")
_city("city_metrics_all_range", "ALL", START, END)


@register("metric_formula", _city_sql("DY", formula=True))
def q_metric_formula(spark: SparkSession, d: str) -> DataFrame:
    return M.city_metrics(_store(spark, d), METRICS, agg="DY", formulas=FORMULA)


@register("find_person", _BASE + f"""
SELECT n.n_name AS city, c.c_name AS last_name, c.c_mktsegment AS first_name,
       MIN(p1.metric_timestamp) AS first_seen, MAX(p1.metric_timestamp) AS last_seen
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN p1 ON p1.customer_id = c.c_custkey
WHERE c.c_name = '{FIND_LAST}'
GROUP BY 1, 2, 3
""")
def q_find_person(spark: SparkSession, d: str) -> DataFrame:
    return M.find_customer(_store(spark, d), FIND_LAST)


@register("find_person_full_name", _BASE + f"""
SELECT n.n_name AS city, c.c_name AS last_name, c.c_mktsegment AS first_name,
       MIN(p1.metric_timestamp) AS first_seen, MAX(p1.metric_timestamp) AS last_seen
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN p1 ON p1.customer_id = c.c_custkey
WHERE c.c_name = '{FIND_LAST}' AND c.c_mktsegment = '{FIND_FIRST}'
GROUP BY 1, 2, 3
""")
def q_find_person_full(spark: SparkSession, d: str) -> DataFrame:
    return M.find_customer(_store(spark, d), FIND_LAST, FIND_FIRST)


@register("metrics_json", _BASE + f"""
SELECT customer_id, metric_timestamp, {_doc(False)} AS result FROM j
""")
def q_metrics_json(spark: SparkSession, d: str) -> DataFrame:
    """Whole panel join rendered as one JSON document per key (NULL metrics kept)."""
    store = _store(spark, d)
    r = M.resolve(store, METRICS)
    return M._joined_panels(store, r, None, None).select(*M.KEYS, M._doc(r, False).alias("result"))


@register("panel_join_full", _BASE + """
SELECT customer_id, metric_timestamp, metric_1, metric_2, metric_3, metric_4, metric_5 FROM j
""")
def q_panel_join_full(spark: SparkSession, d: str) -> DataFrame:
    """Full two-panel join (the published comparison's shape)."""
    return M.metric_rows(_store(spark, d), "metric_1,metric_2,metric_3,metric_4,metric_5")


@register("panel_join_point", _BASE + f"""
SELECT customer_id, metric_timestamp, metric_1, metric_2, metric_3, metric_4, metric_5 FROM j
WHERE customer_id = {PERSON}
""")
def q_panel_join_point(spark: SparkSession, d: str) -> DataFrame:
    """Two-panel join for one person: the filter reaches both scans."""
    store = _store(spark, d)
    r = M.resolve(store, "metric_1,metric_2,metric_3,metric_4,metric_5")
    return M._joined_panels(store, r, None, None, PERSON).select(*M.KEYS, *[n for n, _ in r.metrics])


@register("city_metrics_orders_mo", """
SELECT n.n_name AS city, date_trunc('month', o.o_orderdate) AS result_time,
       json_object('metric_1_sum', SUM(CAST(o.o_totalprice AS DECIMAL(18,2)))) AS result
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY 1, 2
""")
def q_city_metrics_orders_mo(spark: SparkSession, d: str) -> DataFrame:
    """Monthly order totals per city (nation) over several years."""
    from tessera.plans.bindings import order_metric_store

    return M.city_metrics(order_metric_store(Tables(spark, d)), "metric_1", agg="MO")
