"""The stored metric catalog and the panel tables made from it.

The catalog is a log: each ingest that meets new kinds of metrics appends one file with their rows, under
the next version. A kind keeps its id for ever; new ones take the next ids, in name order. Panel ``i`` owns the
ids ``(i - 1) * width + 1 … i * width``, so a catalog that grows widens its last panel and then opens
another. Queries read the catalog, never the facts, to learn which metrics there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions.docs import ident
from tessera.functions.timeparts import trunc_ntz
from tessera.sinks.files import cluster_by_month
from tessera.sources.files import path_exists

CATALOG = "metric_id int, name string, explain string, data_type string, table_name string, version int"
KEYS = ("customer_id", "metric_timestamp")


def read_catalog(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One row for each metric, as of ``version`` (None: the newest). Without a catalog: no rows."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], CATALOG)
    rows = spark.read.schema(CATALOG).parquet(path)
    return rows if version is None else rows.where(F.col("version") <= version)


def register_metrics(spark: SparkSession, path: str, kinds: DataFrame, width: int, prefix: str = "panel_") -> int:
    """Add the kinds (column ``explain``) that the catalog does not hold yet; its version afterwards.

    One writer at a time. The append is one file, so an ingest that fails adds all of its kinds or none."""
    known = read_catalog(spark, path)
    top, version = known.agg(F.coalesce(F.max("metric_id"), F.lit(0)), F.coalesce(F.max("version"), F.lit(0))).first()
    new = kinds.select("explain").where("explain IS NOT NULL").distinct().join(known.select("explain"), "explain", "left_anti")
    # New kinds only, at most as many as tables have columns: the window's one task is small.
    rows = new.withColumn("metric_id", (F.row_number().over(Window.orderBy("explain")) + top).cast("int")).select(
        "metric_id", F.concat(F.lit("metric_"), F.col("metric_id").cast("string")).alias("name"), "explain", F.lit("numeric").alias("data_type"),
        F.concat(F.lit(prefix), (F.floor((F.col("metric_id") - 1) / width) + 1).cast("string")).alias("table_name"),
        F.lit(version + 1).alias("version")).coalesce(1)
    added = [tuple(r) for r in rows.collect()]
    if not added:
        return version
    spark.createDataFrame(added, CATALOG).coalesce(1).write.mode("append").parquet(path)
    return version + 1


def catalog_rows(catalog: DataFrame) -> list[tuple[int, str, str, str]]:
    """(metric_id, name, explain, table_name) by id: one row for each metric column there can be."""
    return [tuple(r) for r in catalog.select("metric_id", "name", "explain", "table_name").orderBy("metric_id").collect()]


class PanelTables:
    """The panels as tables of the session's catalog, external under ``location``, partitioned by month.

    ``names`` maps a panel of the catalog to its table, so that several stores can live in one database."""

    def __init__(self, spark: SparkSession, location: str, database_prefix: str = "", metric_type: str = "decimal(28,15)"):
        self.spark, self.location, self.prefix, self.metric_type = spark, location.rstrip("/"), database_prefix, metric_type

    def table(self, panel: str) -> str:
        return f"{self.prefix}{panel}"

    def sync(self, rows: Sequence[tuple[int, str, str, str]]) -> dict[str, list[str]]:
        """Create the panels that the catalog asks for, and widen those that lack metrics, in id order. Returns the
        metrics added, by panel. Files written before hold no such columns: they read as NULL."""
        added: dict[str, list[str]] = {}
        for panel in dict.fromkeys(t for *_, t in rows):
            wanted = [n for _, n, _, t in sorted(rows) if t == panel]
            name = self.table(panel)
            columns = lambda ms: ", ".join(f"{ident(m)} {self.metric_type}" for m in ms)
            if not self.spark.catalog.tableExists(name):
                self.spark.sql(f"CREATE TABLE {ident(name)} (customer_id BIGINT, metric_timestamp TIMESTAMP_NTZ, {columns(wanted)}, month DATE) "
                               f"USING parquet PARTITIONED BY (month) LOCATION '{self.location}/{panel}'")
                if path_exists(self.spark, f"{self.location}/{panel}"):  # a store that another session has written
                    self.spark.sql(f"MSCK REPAIR TABLE {ident(name)}")
                added[panel] = wanted
                continue
            held = set(self.spark.table(name).columns)
            missing = [m for m in wanted if m not in held]
            if missing:
                self.spark.sql(f"ALTER TABLE {ident(name)} ADD COLUMNS ({columns(missing)})")
                added[panel] = missing
        return added

    def append(self, rows: Sequence[tuple[int, str, str, str]], long: DataFrame) -> None:
        """Facts (customer_id, metric_timestamp, explain, value) as panel rows: one for each person, time and panel
        that has a value; of several values the largest. One pass and one shuffle for each panel; a panel reads only
        the facts of its own id range."""
        for panel in dict.fromkeys(t for *_, t in rows):
            own = [(n, e) for _, n, e, t in sorted(rows) if t == panel]
            mine = long.where(F.col("explain").isin([e for _, e in own]))
            cells = [F.max(F.when(F.col("explain") == e, F.col("value").cast(self.metric_type))).alias(n) for n, e in own]
            wide = mine.groupBy(*KEYS).agg(*cells).withColumn("month", trunc_ntz("month", "metric_timestamp").cast("date"))
            name = self.table(panel)
            cluster_by_month(wide, "month").select(*self.spark.table(name).columns).write.mode("append").insertInto(name)

    def panels(self, rows: Sequence[tuple[int, str, str, str]]) -> dict[str, DataFrame]:
        return {t: self.spark.table(self.table(t)) for t in dict.fromkeys(t for *_, t in rows)}

    def drop(self, rows: Sequence[tuple[int, str, str, str]]) -> None:
        """Forget the tables; their files stay."""
        for panel in dict.fromkeys(t for *_, t in rows):
            self.spark.sql(f"DROP TABLE IF EXISTS {ident(self.table(panel))}")
