"""Queries over what an ingest stores beside the facts: the catalog, the tables made from it, the index of names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.plans.bindings import METRIC_TYPE, PANEL_WIDTH, metric_store
from tessera.plans.catalog import PanelTables, catalog_rows, read_catalog, register_metrics
from tessera.plans.metrics import city_metrics
from tessera.plans.name_index import build_name_index, search_names
from tessera.plans.registry import register
from tessera.session import scratch_dir
from tessera.sources.tables import Tables

# The events arrive in two ingests; the kind that comes first by name appears only in the second, so it gets the last id.
_IDS = """
types AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL),
ids AS (SELECT event_type, row_number() OVER (ORDER BY event_type = (SELECT min(event_type) FROM types), event_type) AS id FROM types),
"""


def _late(t: Tables) -> str | None:
    return t.events.agg(F.min("event_type")).first()[0]


@register("stored_catalog", f"""
WITH {_IDS}
versions AS (SELECT *, CASE WHEN event_type = (SELECT min(event_type) FROM types) THEN 2 ELSE 1 END AS version FROM ids)
SELECT CAST(id AS INTEGER) AS metric_id, 'metric_' || id AS name, event_type AS explain, 'numeric' AS data_type,
       'panel_' || CAST((id - 1) // {PANEL_WIDTH} + 1 AS BIGINT) AS table_name, version FROM versions
""")
def q_stored_catalog(spark: SparkSession, d: str) -> DataFrame:
    """The catalog after two ingests and a third that brings nothing new: ids stay, the late kind takes the next."""
    t = Tables(spark, d)
    path, late = scratch_dir(spark, "catalog"), _late(t)
    kinds = t.events.select(F.col("event_type").alias("explain"))
    for part in (kinds.where(F.col("explain") != late), kinds, kinds):
        register_metrics(spark, path, part, PANEL_WIDTH)
    return read_catalog(spark, path)


@register("stored_catalog_metrics", f"""
WITH {_IDS}
person AS (SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT n_name AS city, CAST(date_trunc('month', ts) AS TIMESTAMP) AS result_time,
       CAST(SUM(CASE WHEN id = (SELECT max(id) FROM ids) THEN CAST(value AS DECIMAL(18,2)) END) AS DECIMAL(28,2)) AS late_sum,
       CAST(SUM(CASE WHEN id = 1 THEN CAST(value AS DECIMAL(18,2)) END) AS DECIMAL(28,2)) AS first_sum
FROM events LEFT JOIN ids USING (event_type) JOIN person ON user_id = c_custkey
GROUP BY n_name, date_trunc('month', ts)
""")
def q_stored_catalog_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Monthly sums by city of the first metric and of the one that the last ingest added, planned from the stored
    catalog: no fact is read while the query is built."""
    t = Tables(spark, d)
    path, late = scratch_dir(spark, "catalog"), _late(t)
    kinds = t.events.select(F.col("event_type").alias("explain"))
    for part in (kinds.where(F.col("explain") != late), kinds):
        register_metrics(spark, path, part, PANEL_WIDTH)
    cat = read_catalog(spark, path)
    rows = catalog_rows(cat)
    first, last = rows[0][1], rows[-1][1]
    out = city_metrics(metric_store(t, cat), f"{first},{last}", agg="MO")
    value = lambda m: F.get_json_object("result", f"$.{m}_sum").cast("decimal(28,2)")
    return out.select("city", "result_time", value(last).alias("late_sum"), value(first).alias("first_sum"))


@register("panel_tables_grow", f"""
WITH {_IDS}
facts AS (
  SELECT CASE WHEN user_id % 2 = 0 AND event_type <> (SELECT min(event_type) FROM types) THEN 1 ELSE 2 END AS ingest,
         (id - 1) // {PANEL_WIDTH} + 1 AS panel, id, user_id, ts, CAST(value AS DECIMAL(18,2)) AS value
  FROM events JOIN ids USING (event_type)),
cells AS (SELECT ingest, panel, id, user_id, ts, max(value) AS value FROM facts GROUP BY ALL),
height AS (SELECT panel, count(DISTINCT (ingest, user_id, ts)) AS n_rows FROM cells GROUP BY panel)
SELECT 'panel_' || CAST(panel AS BIGINT) AS table_name, CAST(id - (panel - 1) * {PANEL_WIDTH} + 2 AS INTEGER) AS position,
       'metric_' || id AS column_name, CAST(any_value(n_rows) AS BIGINT) AS n_rows, count(value) AS n_values,
       CAST(sum(value) AS DECIMAL(38,2)) AS value_sum
FROM cells JOIN height USING (panel) GROUP BY panel, id
""")
def q_panel_tables_grow(spark: SparkSession, d: str) -> DataFrame:
    """Panel tables made from the catalog, filled, widened (and one more opened) when it has grown, filled again, and
    read back: columns in id order, earlier rows without the new metrics."""
    t = Tables(spark, d)
    work, late = scratch_dir(spark, "panel-tables"), _late(t)
    facts = t.events.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("metric_timestamp"), F.col("event_type").alias("explain"), "value")
    early = F.coalesce((F.col("customer_id") % 2 == 0) & (F.col("explain") != late), F.lit(False))
    tables = PanelTables(spark, work, f"t{uuid.uuid4().hex}_", METRIC_TYPE)
    for kinds, part in ((facts.where(F.col("explain") != late), facts.where(early)), (facts, facts.where(~early))):
        register_metrics(spark, f"{work}/catalog", kinds, PANEL_WIDTH)
        rows = catalog_rows(read_catalog(spark, f"{work}/catalog"))
        tables.sync(rows)
        tables.append(rows, part)
    out = None
    for panel, df in tables.panels(rows).items():
        metrics = [c for c in df.columns if c.startswith("metric_") and c != "metric_timestamp"]
        counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.struct(F.count(m).alias("n"), F.sum(m).cast("decimal(38,2)").alias("s")).alias(m) for m in metrics])
        cells = F.array(*[F.struct(F.lit(df.columns.index(m) + 1).alias("position"), F.lit(m).alias("column_name"), F.col(f"{m}.n").alias("n_values"),
                                   F.col(f"{m}.s").alias("value_sum")) for m in metrics])
        one = counts.select(F.lit(panel).alias("table_name"), "n_rows", F.inline(cells))
        out = one if out is None else out.unionByName(one)
    out.select("table_name", "position", "column_name", "n_rows", "n_values", "value_sum").write.parquet(f"{work}/counts")
    tables.drop(rows)  # partitions are listed by the table when it is read, so the counts are written before
    return spark.read.parquet(f"{work}/counts")


#: An inner piece, both ends, a piece with a free letter, one without three letters in a row, one that nobody has.
NAME_PATTERNS = ("%0123%", "Customer%7", "%#%0_11%", "%9_9%", "%xyz%")


@register("name_pattern_search", " UNION ALL ".join(
    f"SELECT '{p}' AS pattern, c_custkey AS customer_id, c_name AS last_name FROM customer WHERE c_name LIKE '{p}'" for p in NAME_PATTERNS))
def q_name_pattern_search(spark: SparkSession, d: str) -> DataFrame:
    """People by name pattern: the rows of each pattern's rarest trigram, verified."""
    people = Tables(spark, d).customer.select(F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("last_name"))
    path = scratch_dir(spark, "name-index")
    build_name_index(people, path)
    out = None
    for p in NAME_PATTERNS:
        one = search_names(spark, path, people, p).select(F.lit(p).alias("pattern"), "customer_id", "last_name")
        out = one if out is None else out.unionByName(one)
    return out
