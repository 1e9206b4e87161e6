"""The stored catalog and its panel tables."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from tessera.plans.bindings import metric_store
from tessera.plans.catalog import PanelTables, catalog_rows, read_catalog, register_metrics
from tessera.plans.metrics import city_metrics, customer_metrics
from tessera.sources.tables import Tables


def _kinds(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "explain string")


def test_ids_never_change(spark, workdir):
    path = f"{workdir}/catalog"
    assert read_catalog(spark, path).count() == 0 and register_metrics(spark, path, _kinds(spark, None), 2) == 0
    assert register_metrics(spark, path, _kinds(spark, "m", "c", "m", None), 2) == 1
    assert register_metrics(spark, path, _kinds(spark, "c", "m"), 2) == 1
    assert register_metrics(spark, path, _kinds(spark, "a", "m", "z", "b"), 2) == 2
    assert [(i, e, t) for i, _, e, t in catalog_rows(read_catalog(spark, path))] == [
        (1, "c", "panel_1"), (2, "m", "panel_1"), (3, "a", "panel_2"), (4, "b", "panel_2"), (5, "z", "panel_3")]
    assert len(catalog_rows(read_catalog(spark, path, version=1))) == 2


def test_queries_are_built_without_reading_facts(spark, workdir):
    """A store over a stored catalog: facts that cannot be read do not matter before the query runs."""
    t = Tables(spark, SF001)
    path = f"{workdir}/catalog"
    register_metrics(spark, path, t.events.select(F.col("event_type").alias("explain")), 3)
    hidden = Tables(spark, SF001)
    broken = t.events.withColumn("event_type", F.raise_error(F.lit("facts were read")).cast("string"))
    hidden.__dict__["events"] = broken
    store = metric_store(hidden, read_catalog(spark, path))
    city_metrics(store, "metric_1,metric_2", agg="DY")
    customer_metrics(store, 7, "metric_1")
    with pytest.raises(Exception, match="facts were read"):
        customer_metrics(store, 7, "metric_1").collect()


def test_panels_are_widened_and_old_rows_read_null(spark, workdir):
    path = f"{workdir}/catalog"
    tables = PanelTables(spark, f"{workdir}/panels", f"p{uuid.uuid4().hex}_", "decimal(18,2)")
    day = dt.datetime(2023, 1, 1)
    facts = lambda *rows: spark.createDataFrame(rows, "customer_id long, metric_timestamp timestamp_ntz, explain string, value double")
    register_metrics(spark, path, _kinds(spark, "b", "c"), 3)
    rows = catalog_rows(read_catalog(spark, path))
    assert tables.sync(rows) == {"panel_1": ["metric_1", "metric_2"]}
    tables.append(rows, facts((1, day, "b", 1.5), (1, day, "c", 2.0), (1, day, "c", 3.0), (2, day, None, 9.0)))
    register_metrics(spark, path, _kinds(spark, "a", "d", "e"), 3)
    rows = catalog_rows(read_catalog(spark, path))
    assert tables.sync(rows) == {"panel_1": ["metric_3"], "panel_2": ["metric_4", "metric_5"]}
    assert tables.sync(rows) == {}
    tables.append(rows, facts((1, day, "a", 7.0), (3, dt.datetime(2023, 2, 1), "e", 4.0)))
    first, second = tables.panels(rows).values()
    assert first.columns == ["customer_id", "metric_timestamp", "metric_1", "metric_2", "metric_3", "month"]
    got = {tuple(None if x is None else float(x) for x in r[2:5]) for r in first.collect()}
    assert got == {(1.5, 3.0, None), (None, None, 7.0)}
    assert [(r["customer_id"], r["metric_4"], float(r["metric_5"])) for r in second.collect()] == [(3, None, 4.0)]
    assert sorted(n for n in os.listdir(f"{workdir}/panels/panel_1") if n.startswith("month=")) == ["month=2023-01-01"]
    # Another session's catalog finds the same files.
    again = PanelTables(spark, f"{workdir}/panels", f"q{uuid.uuid4().hex}_", "decimal(18,2)")
    again.sync(rows)
    assert again.panels(rows)["panel_1"].count() == 2
    tables.drop(rows), again.drop(rows)
