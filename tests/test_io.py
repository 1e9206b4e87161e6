"""Sinks, sources and streaming pieces not covered by the driver-table queries."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tessera.plans import generate as G
from tessera.plans.sales import compute_house_sales, ensure_watermark, lookup_seed
from tessera.sinks.files import append_csv, month_filter, write_monthly
from tessera.sinks.tables import append_table, load_csv_table, write_lookup_csv
from tessera.sources.files import SALES_SCHEMA, read_lookup_csv
from tessera.sources.tables import read_table

FIX = os.path.join(os.path.dirname(__file__), "fixtures", "channel")


def test_scheduled_steps(spark, workdir):
    state = f"{workdir}/state"
    assert ensure_watermark(spark, state) == "0x00000000"
    rows = [(i, "a", dt.date(2023, 1, 1), 2, "0x%08x" % i) for i in range(1, 6)]
    append_csv(spark.createDataFrame(rows, SALES_SCHEMA), f"{workdir}/sales")
    with open(f"{workdir}/chars.json", "w") as f:
        json.dump([{"id": "a", "name": "A", "house": "Hufflepuff"}], f)
    res = compute_house_sales(spark, state, f"{workdir}/sales", f"{workdir}/out", f"{workdir}/chars.json")
    assert res.new_watermark == "0x00000005" and res.rows_written == 1
    assert ensure_watermark(spark, state) == "0x00000005"          # kept
    assert ensure_watermark(spark, state, is_restart=True) == "0x00000000"
    seed = lookup_seed(spark.createDataFrame(rows, SALES_SCHEMA))
    write_lookup_csv(seed, f"{workdir}/lookup")
    back = read_lookup_csv(spark, f"{workdir}/lookup").collect()
    assert [(r["character_id"], r["house"]) for r in back] == [("a", None)]  # empty text reads back as NULL


def test_table_sinks(spark, workdir):
    spark.sql("DROP TABLE IF EXISTS t_append")
    df = spark.range(3).select(F.col("id").alias("k"))
    append_table(df, "t_append")
    append_table(df, "t_append")
    assert read_table(spark, "t_append").count() == 6
    spark.sql("DROP TABLE IF EXISTS t_contact")
    t = load_csv_table(spark, os.path.join(FIX, "contact_export.csv"), "t_contact", drop=["X_PROMO_DATE"])
    assert t.columns == ["row_id", "fst_name", "mid_name", "last_name", "x_gb_status"] and t.count() == 3


def test_monthly_partitions_prune(spark, workdir):
    rows = [(i, dt.datetime(2024, 1 + i % 3, 1 + i % 27, 5)) for i in range(60)]
    df = spark.createDataFrame(rows, "k long, ts timestamp_ntz")
    write_monthly(df, f"{workdir}/m", "ts", sort_within=["k"])
    back = spark.read.parquet(f"{workdir}/m").filter(month_filter("month", dt.date(2024, 2, 10), dt.date(2024, 2, 10)))
    assert back.count() == 20
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan


def test_monthly_write_makes_few_files(spark, workdir):
    """A file for each month and needed split, also when small partitions are not merged."""
    days = spark.range(0, 15000, numPartitions=16).select("id", F.date_add(F.lit(dt.date(2018, 1, 1)), (F.col("id") % 2430).cast("int")).cast("timestamp_ntz").alias("ts"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_monthly(days, f"{workdir}/m", "ts", sort_within=["id"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for _, _, fs in os.walk(f"{workdir}/m") for f in fs if f.endswith(".parquet")]
    assert len(files) == 80 and spark.read.parquet(f"{workdir}/m").count() == 15000


def test_wide_scan_reads_only_requested_columns(spark, workdir):
    cat = G.metric_catalog_range(spark, 60, 1600)
    rows = [(r["name"], r["table_name"]) for r in cat.collect()]
    people = spark.range(1, 4).select(F.col("id").alias("customer_id"))
    panel = G.synthetic_metric_panels(people, rows, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 5))["customer_metric_1"]
    panel.write.parquet(f"{workdir}/wide")
    q = spark.read.parquet(f"{workdir}/wide").select("metric_7", "metric_42")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<metric_7:decimal(28,15),metric_42:decimal(28,15)>" in plan


def test_generator_row_cap_is_a_top_k(spark):
    cat = G.metric_catalog_range(spark, 3, 1600)
    rows = [(r["name"], r["table_name"]) for r in cat.collect()]
    people = spark.range(1, 6).select(F.col("id").alias("customer_id"))
    p = G.synthetic_metric_panels(people, rows, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), row_limit=30)
    got = p["customer_metric_1"].select("customer_id").collect()
    assert len(got) == 30 and {r["customer_id"] for r in got} == {1, 2}  # 25 hours each, in key order


def test_fetch_lookup_batches_distinct_keys(spark):
    from tessera.sources.lookup import fetch_lookup

    table = {"a": "Gryffindor", "b": "Slytherin"}

    def fetch(keys):  # stands in for a batched service call
        return {k: table[k] for k in keys if k in table}

    sales = spark.createDataFrame([("a",), ("a",), ("b",), ("zz",)], "character_id string")
    got = sorted(map(tuple, fetch_lookup(sales, "character_id", fetch).collect()), key=str)
    assert got == [("a", "Gryffindor"), ("b", "Slytherin"), ("zz", None)]
