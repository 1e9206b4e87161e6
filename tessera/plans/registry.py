"""Registered jobs over the driver tables and their hand-written DuckDB oracles.

Every query reads whole tables (no sampling, no id subsets); the oracle for a
name computes the same result independently in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import extract_uuid, uuid_text
from tessera.operators.joins import join_dimension
from tessera.plans import sales
from tessera.plans.bindings import master_from_part, sales_from_lineitem
from tessera.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE_SQL[name] = oracle.strip()
        return fn
    return deco


# ---------------------------------------------------------------- sales jobs

INCREMENTAL_FROM = "0x00001000"  # watermark of the incremental example run

_SALES_SQL = """
WITH s AS (
  SELECT l_partkey AS character_id, CAST(l_shipdate AS DATE) AS sale_date,
         CAST(l_quantity AS INTEGER) AS amount, printf('0x%08x', l_orderkey) AS verstamp
  FROM lineitem)
"""


@register("house_sales", _SALES_SQL + """
SELECT s.sale_date, p.p_brand AS house, CAST(SUM(s.amount) AS BIGINT) AS amount,
       MAX(s.verstamp) AS last_verstamp
FROM s LEFT JOIN part p ON s.character_id = p.p_partkey
WHERE p.p_brand IS NOT NULL AND s.sale_date IS NOT NULL
GROUP BY s.sale_date, p.p_brand
ORDER BY 1, 2
""")
def q_house_sales(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return sales.house_sales(sales_from_lineitem(t), master_from_part(t))


@register("house_sales_incremental", _SALES_SQL + f"""
SELECT s.sale_date, p.p_brand AS house, CAST(SUM(s.amount) AS BIGINT) AS amount,
       MAX(s.verstamp) AS last_verstamp
FROM s LEFT JOIN part p ON s.character_id = p.p_partkey
WHERE s.verstamp > '{INCREMENTAL_FROM}' AND p.p_brand IS NOT NULL AND s.sale_date IS NOT NULL
GROUP BY s.sale_date, p.p_brand
""")
def q_house_sales_incremental(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return sales.house_sales(sales_from_lineitem(t), master_from_part(t), INCREMENTAL_FROM)


@register("watermark_next", _SALES_SQL + f"""
SELECT MAX(verstamp) AS verstamp FROM s WHERE verstamp > '{INCREMENTAL_FROM}'
""")
def q_watermark_next(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return sales.next_watermark(sales_from_lineitem(t), INCREMENTAL_FROM)


@register("distinct_lookup", """
SELECT k.character_id, p.p_brand AS house
FROM (SELECT DISTINCT l_partkey AS character_id FROM lineitem) k
LEFT JOIN part p ON k.character_id = p.p_partkey
""")
def q_distinct_lookup(spark: SparkSession, d: str) -> DataFrame:
    t = Tables(spark, d)
    return sales.distinct_lookup(sales_from_lineitem(t), master_from_part(t))


_UUID_SQL = """md5(CAST({c} AS VARCHAR))"""


def _uuid_sql(c: str) -> str:
    h = _UUID_SQL.format(c=c)
    return (f"concat_ws('-', substr({h}, 1, 8), substr({h}, 9, 4), substr({h}, 13, 4), "
            f"substr({h}, 17, 4), substr({h}, 21, 12))")


@register("extract_uuid", f"""
WITH lines AS (
  SELECT DISTINCT '"' || {_uuid_sql('l_partkey')} || '",' AS line FROM lineitem),
keys AS (
  SELECT regexp_extract(line, '(........-....-....-....-............)', 1) AS character_id FROM lines),
m AS (SELECT {_uuid_sql('p_partkey')} AS character_id, p_brand AS house FROM part)
SELECT keys.character_id, m.house FROM keys LEFT JOIN m ON keys.character_id = m.character_id
""")
def q_extract_uuid(spark: SparkSession, d: str) -> DataFrame:
    """Per-key lookup as a flow: distinct key lines → regex key extraction → enrichment."""
    t = Tables(spark, d)
    # distinct keys first: the key text is derived once per part, not once per line item
    keys = t.lineitem.select("l_partkey").distinct()
    lines = keys.select(F.concat(F.lit('"'), uuid_text("l_partkey"), F.lit('",')).alias("line"))
    keys = lines.select(extract_uuid("line").alias("character_id"))
    master = t.part.select(uuid_text("p_partkey").alias("character_id"), F.col("p_brand").alias("house"))
    return join_dimension(keys, master, "character_id", "left")


# Further query families register themselves on import.
from tessera.plans import registry_metrics  # noqa: E402,F401
from tessera.plans import registry_channels  # noqa: E402,F401
from tessera.plans import registry_ops  # noqa: E402,F401
from tessera.plans import registry_io  # noqa: E402,F401
from tessera.plans import registry_catalog  # noqa: E402,F401
