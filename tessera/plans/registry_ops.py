"""Data-quality and grouped operators over the driver tables, with DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.stamps import hex_stamp, stamp_value
from tessera.functions.text import is_balanced
from tessera.functions.timeparts import parse_dmy_timestamp, trunc_ntz, year_month
from tessera.operators import aggregates as A
from tessera.operators import quality as Q
from tessera.operators.joins import first_pair_with_sum, join_dimension
from tessera.plans.bindings import PANEL_WIDTH, metric_catalog
from tessera.plans.registry import register
from tessera.sources.series import explode_hours
from tessera.sources.tables import Tables

PAIR_TARGET = 50
HOST_PATTERN = r"^[a-z]+://([^/?#]+)"


@register("key_checks", """
SELECT 'lineitem_key_dups' AS "check", COUNT(*) AS violations
  FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1)
UNION ALL
SELECT 'lineitem_part_fk', COUNT(*) FROM lineitem l
  WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'events_user_fk', COUNT(*) FROM events e
  WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = e.user_id)
UNION ALL
SELECT 'customer_name_dups', COUNT(*)
  FROM (SELECT c_nationkey, c_name, c_mktsegment FROM customer GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)
UNION ALL
SELECT 'customer_name_nulls', COUNT(*) FROM customer WHERE c_name IS NULL OR c_mktsegment IS NULL
""")
def q_key_checks(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    c = t.customer
    return Q.violation_summary({
        "lineitem_key_dups": Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"]),
        "lineitem_part_fk": Q.orphans(t.lineitem.select("l_partkey"), t.part, "l_partkey", "p_partkey"),
        "events_user_fk": Q.orphans(t.events.select("user_id"), c, "user_id", "c_custkey"),
        "customer_name_dups": Q.duplicate_keys(c, ["c_nationkey", "c_name", "c_mktsegment"]),
        "customer_name_nulls": c.filter(F.col("c_name").isNull() | F.col("c_mktsegment").isNull()),
    })


@register("pair_sum", f"""
SELECT p_brand, i, j FROM (
  SELECT a.p_brand, a.p_partkey AS i, b.p_partkey AS j,
         row_number() OVER (PARTITION BY a.p_brand ORDER BY a.p_partkey, b.p_partkey) AS rn
  FROM part a JOIN part b
    ON a.p_brand = b.p_brand AND a.p_size + b.p_size = {PAIR_TARGET} AND a.p_partkey < b.p_partkey)
WHERE rn = 1
""")
def q_pair_sum(spark: SparkSession, d: str) -> DataFrame:
    """Per brand, the first pair of parts (by key) whose sizes add up to the target."""
    p = Tables(spark, d).part.select("p_brand", "p_partkey", "p_size")
    return first_pair_with_sum(p, ["p_brand"], "p_partkey", "p_size", PAIR_TARGET)


@register("leave_one_out", """
WITH g AS (SELECT l_orderkey, list(CAST(l_quantity AS HUGEINT) ORDER BY l_linenumber) AS vs,
                  list(l_linenumber ORDER BY l_linenumber) AS ns FROM lineitem GROUP BY l_orderkey),
r AS (SELECT l_orderkey, vs, ns, unnest(range(1, len(vs) + 1)) AS i FROM g)
SELECT l_orderkey, ns[i] AS l_linenumber, CAST(vs[i] AS BIGINT) AS v,
       CAST(list_reduce(list_concat(vs[:i - 1], vs[i + 1:]), lambda a, b: a * b, CAST(1 AS HUGEINT)) AS DECIMAL(38, 0))
         AS product_except_self
FROM r
""")
def q_leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    li = Tables(spark, d).lineitem.select("l_orderkey", "l_linenumber", F.col("l_quantity").cast("bigint").alias("v"))
    return A.leave_one_out_product(li, ["l_orderkey"], "v")


@register("leave_one_out_digits", """
WITH parts AS (
  SELECT l_suppkey, CAST(product(l_quantity) AS BIGINT) AS m
  FROM (SELECT l_suppkey, l_quantity, row_number() OVER (PARTITION BY l_suppkey) // 5 AS part FROM lineitem) GROUP BY l_suppkey, part),
whole AS (
  SELECT l_suppkey, list_reduce(list([m]), lambda acc, m: list_reduce(
    list_transform(acc, lambda d: [d]),
    lambda s, d: list_concat(s[:-2], [(d[1] * m[1] + s[-1]) % 1000000000, (d[1] * m[1] + s[-1]) // 1000000000]),
    [CAST(0 AS BIGINT)]), [CAST(1 AS BIGINT)]) AS p
  FROM parts GROUP BY l_suppkey),
per AS (SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS v, count(*) AS n FROM lineitem GROUP BY ALL),
shown AS (
  SELECT l_suppkey, v, n, ltrim(array_to_string(list_transform(list_reduce(
    list_transform(list_reverse(p), lambda d: [d]),
    lambda s, d: list_concat(s[:-2], [(s[-1] * 1000000000 + d[1]) // v, (s[-1] * 1000000000 + d[1]) % v]),
    [CAST(0 AS BIGINT)])[:-2], lambda x: lpad(CAST(x AS VARCHAR), 9, '0')), ''), '0') AS product
  FROM per JOIN whole USING (l_suppkey))
SELECT l_suppkey, v, n, CAST(length(product) AS INTEGER) AS digits, md5(product) AS product_md5 FROM shown
""")
def q_leave_one_out_digits(spark: SparkSession, d: str) -> DataFrame:
    """Leave-one-out products of hundreds of digits: each supplier's line quantities, by distinct quantity."""
    li = Tables(spark, d).lineitem.select("l_suppkey", F.col("l_quantity").cast("bigint").alias("v"))
    values = A.leave_one_out_values(li, ["l_suppkey"], "v", "product")
    return values.select("l_suppkey", F.col("v").cast("bigint").alias("v"), "n", F.length("product").alias("digits"), F.md5("product").alias("product_md5"))


@register("prefix_per_group", f"""
WITH u AS (SELECT regexp_extract(url, '{HOST_PATTERN}', 1) AS host, url FROM pages),
m AS (SELECT host, MIN(url) AS mn, MAX(url) AS mx FROM u GROUP BY host)
SELECT host, left(mn, list_max(list_filter(range(0, length(mn) + 1), lambda i: left(mn, i) = left(mx, i))))
  AS prefix
FROM m
""")
def q_prefix_per_group(spark: SparkSession, d: str) -> DataFrame:
    """Longest common URL prefix per host."""
    pages = Tables(spark, d).pages.select(F.regexp_extract("url", HOST_PATTERN, 1).alias("host"), "url")
    return A.common_prefix_per_group(pages, ["host"], "url")


_BRACKETS_SQL = r"""
list_reduce(string_split(regexp_replace(text, '[^()\[\]{}]', '', 'g'), ''),
  lambda acc, ch: CASE
    WHEN acc = '!' THEN acc
    WHEN ch IN ('(', '[', '{') THEN acc || ch
    WHEN (ch = ')' AND right(acc, 1) = '(') OR (ch = ']' AND right(acc, 1) = '[')
         OR (ch = '}' AND right(acc, 1) = '{') THEN left(acc, length(acc) - 1)
    WHEN ch IN (')', ']', '}') THEN '!'
    ELSE acc END, '') = ''
"""


@register("balanced_brackets", f"""
SELECT lang, source, COUNT(*) AS n_docs,
       CAST(SUM(CASE WHEN {_BRACKETS_SQL} THEN 1 ELSE 0 END) AS BIGINT) AS n_balanced
FROM documents GROUP BY lang, source
""")
def q_balanced_brackets(spark: SparkSession, d: str) -> DataFrame:
    """Bracket balance of every whole document, counted per language and source."""
    docs = Tables(spark, d).documents.select("lang", "source", is_balanced("text").alias("ok"))
    return docs.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("ok").cast("bigint")).alias("n_balanced"))


@register("trunc_and_parse", """
SELECT o_orderkey,
       date_trunc('day', o_orderdate) AS day_start, date_trunc('week', o_orderdate) AS week_start,
       date_trunc('month', o_orderdate) AS month_start, date_trunc('year', o_orderdate) AS year_start,
       strftime(o_orderdate, '%Y%m') AS year_month,
       CAST(o_orderdate AS DATE) AS order_day,
       o_orderdate + INTERVAL 1 MONTH AS next_month,
       o_orderdate AS parsed_back,
       printf('0x%08x', o_orderkey) AS stamp,
       o_orderkey AS stamp_back
FROM orders
""")
def q_trunc_and_parse(spark: SparkSession, d: str) -> DataFrame:
    """Date truncation, yyyyMM text, interval arithmetic, DMY round trip and hex stamps."""
    o = Tables(spark, d).orders.select("o_orderkey", "o_orderdate")
    dmy = F.date_format("o_orderdate", "d.M.yyyy H:mm:ss")
    stamp = hex_stamp("o_orderkey")
    return o.select(
        "o_orderkey",
        trunc_ntz("day", "o_orderdate").alias("day_start"),
        trunc_ntz("week", "o_orderdate").alias("week_start"),
        trunc_ntz("month", "o_orderdate").alias("month_start"),
        trunc_ntz("year", "o_orderdate").alias("year_start"),
        year_month("o_orderdate").alias("year_month"),
        F.col("o_orderdate").cast("date").alias("order_day"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 MONTH")).alias("next_month"),
        parse_dmy_timestamp(dmy).alias("parsed_back"),
        stamp.alias("stamp"),
        stamp_value(stamp).alias("stamp_back"),
    )


@register("list_aggregates", """
SELECT n.n_name,
       array_to_string(list_sort(list(DISTINCT c.c_mktsegment)), ',') AS segments,
       COUNT(*) AS n_customers
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name
""")
def q_list_aggregates(spark: SparkSession, d: str) -> DataFrame:
    """Sorted distinct market segments per nation (``array_agg(DISTINCT .. ORDER BY ..)``)."""
    t = Tables(spark, d)
    c = join_dimension(t.customer, t.nation.select("n_nationkey", "n_name"),
                       F.col("c_nationkey") == F.col("n_nationkey"), "inner")
    return c.groupBy("n_name").agg(
        F.array_join(F.sort_array(F.collect_set("c_mktsegment")), ",").alias("segments"),
        F.count(F.lit(1)).alias("n_customers"))


_CATALOG_SQL = f"""
WITH cat AS (
  SELECT CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS metric_id, event_type
  FROM (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL))
"""


@register("metric_catalog", _CATALOG_SQL + f"""
SELECT metric_id, 'metric_' || CAST(metric_id AS VARCHAR) AS name, event_type AS explain,
       'numeric' AS data_type,
       'panel_' || CAST(CAST(floor((metric_id - 1) / {PANEL_WIDTH}) AS BIGINT) + 1 AS VARCHAR) AS table_name
FROM cat
""")
def q_metric_catalog(spark: SparkSession, d: str) -> DataFrame:
    return metric_catalog(Tables(spark, d))


@register("panel_count", _CATALOG_SQL + f"""
SELECT COUNT(*) AS n_metrics, CAST(ceil(COUNT(*) / {PANEL_WIDTH}) AS BIGINT) AS n_panels FROM cat
""")
def q_panel_count(spark: SparkSession, d: str) -> DataFrame:
    cat = metric_catalog(Tables(spark, d))
    return cat.agg(F.count(F.lit(1)).alias("n_metrics"),
                   F.ceil(F.count(F.lit(1)) / PANEL_WIDTH).cast("bigint").alias("n_panels"))


@register("panel_columns", _CATALOG_SQL + f"""
SELECT 'panel_' || CAST(CAST(floor((metric_id - 1) / {PANEL_WIDTH}) AS BIGINT) + 1 AS VARCHAR) AS table_name,
       string_agg('metric_' || CAST(metric_id AS VARCHAR), ',' ORDER BY metric_id) AS columns
FROM cat GROUP BY 1
""")
def q_panel_columns(spark: SparkSession, d: str) -> DataFrame:
    """Column list of each panel, in the order of the metric ids."""
    cat = metric_catalog(Tables(spark, d))
    return A.ordered_list_text(cat, ["table_name"], "name", ",", "columns", by="metric_id")


@register("hour_series", """
WITH span AS (SELECT user_id AS customer_id, date_trunc('hour', MIN(ts)) AS a, date_trunc('hour', MAX(ts)) AS b
              FROM events GROUP BY user_id)
SELECT customer_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS metric_timestamp FROM span
""")
def q_hour_series(spark: SparkSession, d: str) -> DataFrame:
    """Every hour of each person's active span, both ends inclusive (generated per row, no cross join)."""
    ev = Tables(spark, d).events
    span = ev.groupBy(F.col("user_id").alias("customer_id")).agg(
        trunc_ntz("hour", F.min("ts")).alias("a"), trunc_ntz("hour", F.max("ts")).alias("b"))
    return explode_hours(span, ["customer_id"], "a", "b")
