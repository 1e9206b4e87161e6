"""Jobs with side effects on storage (writers, streams); results are read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.timeparts import parse_dmy_date
from tessera.plans.bindings import PANEL_WIDTH, master_from_part, metric_catalog, order_metric_store, sales_columns
from tessera.plans.generate import resume_point
from tessera.plans.lookup import read_kept, refresh
from tessera.plans.registry import ORACLE_SQL, register
from tessera.plans.sales import compute_house_sales, ensure_watermark, lookup_seed
from tessera.session import scratch_dir
from tessera.sinks.files import append_delivery, month_filter, write_monthly, write_watermark
from tessera.sinks.tables import append_table, load_csv_table, write_lookup_csv
from tessera.sources.files import read_lookup_csv, read_sales, read_semicolon_csv
from tessera.sources.json_list import read_master_json_list
from tessera.sources.tables import Tables, read_table
from tessera.streaming.house_sales_stream import read_outputs, start_house_sales_stream
from tessera.streaming.metric_ingest import daily_rollup, panel_store, rollup_store, start_metric_ingest, write_batch

RESULT_SCHEMA = T.StructType([
    T.StructField("sale_date", T.DateType()),
    T.StructField("house", T.StringType()),
    T.StructField("amount", T.LongType()),
    T.StructField("last_verstamp", T.StringType()),
])
MONTH = "1996-01-01"


@register("stream_house_sales", None)
def q_stream_house_sales(spark: SparkSession, d: str) -> DataFrame:
    """The incremental rollup run as a stream over the lineitem table, its batches added up."""
    t = Tables(spark, d)
    work = scratch_dir(spark, "stream-house-sales")
    write_watermark(spark, f"{work}/state", BELOW_ALL)
    q = start_house_sales_stream(
        spark, table_glob(d, "lineitem"), t.lineitem.schema, sales_columns, lambda: master_from_part(Tables(spark, d)),
        f"{work}/state", f"{work}/out", f"{work}/checkpoint")
    q.awaitTermination()
    return read_outputs(spark, f"{work}/out", RESULT_SCHEMA).groupBy("sale_date", "house").agg(
        F.sum("amount").alias("amount"), F.max("last_verstamp").alias("last_verstamp"))


BELOW_ALL = "-0x1"  # the lowest stamp is zero, and the filter is strict
ORACLE_SQL["stream_house_sales"] = ORACLE_SQL["house_sales"]


def table_glob(d: str, name: str) -> str:
    """A pattern for the table's path, whether it is a file or a directory: a streaming source
    takes a single file only by pattern."""
    return f"{d.rstrip('/')}/{name}.parque[t]"


@register("partitioned_write_read", f"""
SELECT o_orderkey, o_custkey, o_orderdate, CAST(date_trunc('month', o_orderdate) AS DATE) AS month
FROM orders WHERE date_trunc('month', o_orderdate) = TIMESTAMP '{MONTH} 00:00:00'
""")
def q_partitioned_write_read(spark: SparkSession, d: str) -> DataFrame:
    """Orders written in monthly partitions, then one month read back (partition pruning)."""
    path = scratch_dir(spark, "orders-by-month")
    o = Tables(spark, d).orders.select("o_orderkey", "o_custkey", "o_orderdate")
    write_monthly(o, path, "o_orderdate", sort_within=["o_custkey"])
    back = spark.read.parquet(path)
    return back.filter(month_filter("month", MONTH, MONTH)).select("o_orderkey", "o_custkey", "o_orderdate", "month")


@register("stream_metric_ingest", """
SELECT user_id AS customer_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
       SUM(CAST(value AS DECIMAL(18,2))) AS value_sum
FROM events GROUP BY 1, 2
""")
def q_stream_metric_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events streamed into monthly panel partitions, then summed per person and day."""
    work = scratch_dir(spark, "metric-ingest")
    t = Tables(spark, d)
    src = spark.readStream.schema(t.events.schema).parquet(table_glob(d, "events"))
    rows = src.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("metric_timestamp"),
                      F.col("value").cast("decimal(18,2)").alias("value"))
    q = start_metric_ingest(rows, f"{work}/panel", f"{work}/checkpoint")
    q.awaitTermination()
    out = daily_rollup(spark, f"{work}/panel", ["value"], rows.schema)
    return out.select("customer_id", "day", F.col("value_sum").cast("decimal(38,2)").alias("value_sum"))


DELIVERIES = 3


@register("live_rollup", """
SELECT user_id AS customer_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day,
       SUM(CAST(value AS DECIMAL(18,2))) AS value_sum, COUNT(*) AS n_rows,
       SUM(COUNT(*)) OVER (PARTITION BY date_trunc('month', date_trunc('day', ts)))::BIGINT AS month_rows
FROM events GROUP BY user_id, date_trunc('day', ts)
""")
def q_live_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Events that arrive in deliveries out of order of time, as a stream with a live rollup: folded between
    deliveries, a batch replayed before and after its fold; the rollup read from partial sums, the months' row counts from the panel."""
    work = scratch_dir(spark, "live-rollup")
    events = Tables(spark, d).events.select(F.col("user_id").alias("customer_id"), F.col("ts").alias("metric_timestamp"),
                                            F.col("value").cast("decimal(18,2)").alias("value"))
    delivery = F.pmod(F.xxhash64("customer_id", "metric_timestamp"), F.lit(DELIVERIES))
    target = f"{work}/target"
    panel, sums = panel_store(spark, target, events.schema), rollup_store(spark, target, events.schema, ["value"])
    for i in range(DELIVERIES):
        part = events.where(delivery == i)
        part.write.mode("append").parquet(f"{work}/landing")
        start_metric_ingest(spark.readStream.schema(events.schema).parquet(f"{work}/landing"), target, f"{work}/checkpoint",
                            rollup=["value"]).awaitTermination()
        write_batch(panel, sums, ["value"], part, i)  # a replay of the batch just written
        if i + 1 < DELIVERIES:  # the last one stays a loose batch
            panel.fold()
            sums.fold()
            write_batch(panel, sums, ["value"], part, i)  # and one that comes after its fold
            sums.vacuum()
    months = panel.read().groupBy("month").agg(F.count(F.lit(1)).alias("month_rows"))
    out = sums.read().join(months, "month", "left")
    return out.select("customer_id", "day", F.col("value_sum").cast("decimal(38,2)").alias("value_sum"), "n_rows", "month_rows")


@register("sales_file_job", ORACLE_SQL["house_sales"])
def q_sales_file_job(spark: SparkSession, d: str) -> DataFrame:
    """The scheduled job over files: two CSV deliveries, the second after the first run, master data
    as JSON lines; the stamped results read back and added up."""
    t = Tables(spark, d)
    work = scratch_dir(spark, "sales-job")
    sales = sales_columns(t.lineitem).select(
        F.col("stamp").alias("id"), F.col("character_id").cast("string").alias("character_id"), "sale_date", "amount", "verstamp")
    master_from_part(t).select(F.col("character_id").cast("string").alias("id"), F.lit(None).cast("string").alias("name"),
                               "house").write.json(f"{work}/master")
    half = (sales.agg(F.max("id")).first()[0] or 0) // 2
    write_watermark(spark, f"{work}/state", BELOW_ALL)
    for delivery in (sales.where(F.col("id") <= half), sales.where(F.col("id") > half)):
        append_delivery(delivery, f"{work}/sales", bits=DELIVERY_BITS)
        ensure_watermark(spark, f"{work}/state")
        compute_house_sales(spark, f"{work}/state", f"{work}/sales", f"{work}/out", f"{work}/master", master_lines=True)
    # a third run finds nothing new and writes nothing
    compute_house_sales(spark, f"{work}/state", f"{work}/sales", f"{work}/out", f"{work}/master", master_lines=True)
    return read_outputs(spark, f"{work}/out", RESULT_SCHEMA).groupBy("sale_date", "house").agg(
        F.sum("amount").alias("amount"), F.max("last_verstamp").alias("last_verstamp"))


DELIVERY_BITS = 12  # small ranges: the driver's tables hold few stamps


@register("sales_job_log", """
WITH s AS (
  SELECT l_orderkey AS k, CAST(l_shipdate AS DATE) AS day, p_brand AS house, CAST(l_quantity AS INTEGER) AS amount
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey WHERE l_orderkey > 0),
h AS (SELECT max(l_orderkey) // 2 AS half FROM lineitem),
runs AS (
  SELECT 'first' AS job, CAST(k > half AS INTEGER) AS run, s.* FROM s, h
  UNION ALL SELECT 'restarted', 0, s.* FROM s),
stamps AS (SELECT job, run, printf('0x%08x', max(k)) AS verstamp FROM runs GROUP BY ALL),
groups AS (SELECT job, run, day, house, sum(amount) AS amount FROM runs WHERE house IS NOT NULL AND day IS NOT NULL GROUP BY ALL)
SELECT job, verstamp, count(*)::BIGINT AS n_groups, CAST(sum(amount) AS BIGINT) AS amount
FROM groups JOIN stamps USING (job, run) GROUP BY ALL
""")
def q_sales_job_log(spark: SparkSession, d: str) -> DataFrame:
    """The results that the scheduled job has left, one for each run that found rows: the state starts at zero (rows
    stamped zero are not above it), a run without fresh rows writes none, and a forced restart does all again in one."""
    t = Tables(spark, d)
    work = scratch_dir(spark, "sales-log")
    sales = sales_columns(t.lineitem).select(
        F.col("stamp").alias("id"), F.col("character_id").cast("string").alias("character_id"), "sale_date", "amount", "verstamp")
    master_from_part(t).select(F.col("character_id").cast("string").alias("id"), F.lit(None).cast("string").alias("name"),
                               "house").write.json(f"{work}/master")
    run = lambda out: compute_house_sales(spark, f"{work}/state", f"{work}/sales", f"{work}/{out}", f"{work}/master", master_lines=True)
    half = (sales.agg(F.max("id")).first()[0] or 0) // 2
    ensure_watermark(spark, f"{work}/state")
    for delivery in (sales.where(F.col("id") <= half), sales.where(F.col("id") > half)):
        append_delivery(delivery, f"{work}/sales", bits=DELIVERY_BITS)
        run("first")
    run("first")
    ensure_watermark(spark, f"{work}/state", is_restart=True)
    run("restarted")
    logs = [spark.read.schema(RESULT_SCHEMA).option("header", True).csv(f"{work}/{job}").withColumn("job", F.lit(job)) for job in ("first", "restarted")]
    return logs[0].unionByName(logs[1]).groupBy("job", F.col("verstamp").cast("string").alias("verstamp")).agg(
        F.count(F.lit(1)).alias("n_groups"), F.sum("amount").alias("amount"))


@register("semicolon_load", """
SELECT CAST(o_orderkey AS VARCHAR) AS order_key, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS promo_date
FROM orders
""")
def q_semicolon_load(spark: SparkSession, d: str) -> DataFrame:
    """Orders exported as a spreadsheet (semicolons, index column without a name, day-first dates), loaded into
    a named table in two parts and read from it."""
    work, name = scratch_dir(spark, "semicolon"), f"orders_{uuid.uuid4().hex}"
    o = Tables(spark, d).orders
    export = o.select(F.monotonically_increasing_id().alias(" "), F.col("o_orderkey").alias("ORDER_KEY"), F.col("o_orderstatus").alias("Status"),
                      F.date_format("o_orderdate", "dd.MM.yyyy").alias("PROMO_DATE"), F.lit("x").alias("UNUSED"))
    first = F.col("o_orderkey") % 2 == 0
    for part, rows in (("a", export.where(first)), ("b", export.where(~first))):
        rows.write.option("sep", ";").option("header", True).csv(f"{work}/{part}")
    load_csv_table(spark, f"{work}/a", name, drop=["UNUSED"], location=f"{work}/table")
    append_table(read_semicolon_csv(spark, f"{work}/b").drop("unused"), name)
    out = read_table(spark, name, ["order_key", "status", "promo_date"]).withColumn("promo_date", parse_dmy_date("promo_date"))
    spark.sql(f"DROP TABLE {name}")  # its files stay in the scratch folder
    return out


@register("lookup_roundtrip", """
SELECT CAST(k.l_partkey AS VARCHAR) AS character_id, p_brand AS house
FROM (SELECT DISTINCT l_partkey FROM lineitem) k LEFT JOIN part ON l_partkey = p_partkey
""")
def q_lookup_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Distinct keys with an empty house, filled from the master data, written as a lookup file and read back."""
    t = Tables(spark, d)
    path = scratch_dir(spark, "lookup")
    seed = lookup_seed(sales_columns(t.lineitem)).drop("house")
    filled = seed.join(master_from_part(t), "character_id", "left")
    write_lookup_csv(filled.select(F.col("character_id").cast("string").alias("character_id"), "house"), path)
    return read_lookup_csv(spark, path)


@register("lookup_seed", "SELECT DISTINCT l_partkey AS character_id, '' AS house FROM lineitem")
def q_lookup_seed(spark: SparkSession, d: str) -> DataFrame:
    """The keys a lookup is to fill in, each with an empty house."""
    return lookup_seed(sales_columns(Tables(spark, d).lineitem))


@register("resume_point", """
SELECT CAST(max(l_orderkey) AS BIGINT) AS last_id, max(CAST(l_shipdate AS DATE)) AS last_day, CAST(max(l_orderkey) AS BIGINT) AS last_stamp FROM lineitem
""")
def q_resume_point(spark: SparkSession, d: str) -> DataFrame:
    """Where a generator of sales goes on, from delivered files: the largest id, day and stamp (by number)."""
    work = scratch_dir(spark, "resume")
    sales = sales_columns(Tables(spark, d).lineitem)
    append_delivery(sales.select(F.col("stamp").alias("id"), F.col("character_id").cast("string").alias("character_id"), "sale_date", "amount", "verstamp"),
                    work, bits=DELIVERY_BITS)
    return spark.createDataFrame([resume_point(read_sales(spark, work))], "last_id long, last_day date, last_stamp long")


@register("json_list_master", "SELECT CAST(p_partkey AS VARCHAR) AS character_id, p_name || ' \"}{\\ ' AS name, p_brand AS house FROM part")
def q_json_list_master(spark: SparkSession, d: str) -> DataFrame:
    """The master data as one JSON list, whose names hold quotes, braces and backslashes, read back by many tasks."""
    part = Tables(spark, d).part
    path = f"{scratch_dir(spark, 'json-list-master')}/master"
    text = F.to_json(F.struct(F.col("p_partkey").cast("string").alias("id"), F.concat("p_name", F.lit(' "}{\\ ')).alias("name"), F.col("p_brand").alias("house")))
    ends = part.agg(F.min("p_partkey").alias("a"), F.max("p_partkey").alias("z")).first()
    line = F.concat(F.when(F.col("p_partkey") == ends["a"], F.lit("[")).otherwise(F.lit("")), text,
                    F.when(F.col("p_partkey") == ends["z"], F.lit("]")).otherwise(F.lit(",")))
    part.select("p_partkey", line.alias("value")).repartition(1).sortWithinPartitions("p_partkey").select("value").write.text(path)  # a list is one file
    return read_master_json_list(spark, path)


@register("kept_lookup", """
WITH h AS (SELECT max(l_orderkey) // 100 AS early FROM lineitem),
k AS (SELECT l_partkey, min(l_orderkey) AS first_seen FROM lineitem GROUP BY l_partkey),
again AS (SELECT min(l_partkey) AS l_partkey FROM lineitem)
SELECT CAST(k.l_partkey AS VARCHAR) AS character_id,
       CASE WHEN k.l_partkey = (SELECT l_partkey FROM again) THEN 'third ' WHEN first_seen > early THEN 'second ' ELSE '' END || p_brand AS house,
       CAST(CASE WHEN k.l_partkey = (SELECT l_partkey FROM again) THEN 3 WHEN first_seen > early THEN 2 ELSE 1 END AS BIGINT) AS version
FROM k CROSS JOIN h LEFT JOIN part ON k.l_partkey = p_partkey
""")
def q_kept_lookup(spark: SparkSession, d: str) -> DataFrame:
    """A lookup kept over four runs: the second asks only for keys that the first has not met, the third for one key
    again, the fourth for nothing; the master data that answers changes from run to run."""
    t = Tables(spark, d)
    path = f"{scratch_dir(spark, 'kept-lookup')}/lookup"
    sales = sales_columns(t.lineitem)
    early = (sales.agg(F.max("stamp")).first()[0] or 0) // 100  # a third of the keys or so
    master = master_from_part(t).select(F.col("character_id").cast("string").alias("character_id"), "house")

    def answers(prefix: str):
        return lambda keys: keys.join(master.withColumn("house", F.concat(F.lit(prefix), "house")), "character_id")

    refresh(spark, path, sales.where(F.col("stamp") <= early), answers(""))
    refresh(spark, path, sales, answers("second "))
    refresh(spark, path, sales, answers("third "), again=sales.agg(F.min("character_id").alias("character_id")))
    refresh(spark, path, sales, answers("never "))
    return read_kept(spark, path)


@register("catalog_schema", f"""
WITH types AS (SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL),
cat AS (SELECT row_number() OVER (ORDER BY event_type) AS id FROM types),
placed AS (SELECT id, CAST(floor((id - 1) / {PANEL_WIDTH}) AS BIGINT) + 1 AS panel FROM cat),
panels AS (SELECT DISTINCT panel FROM placed)
SELECT 'panel_' || panel AS table_name, 1 AS position, 'customer_id' AS column_name, 'bigint' AS data_type FROM panels
UNION ALL SELECT 'panel_' || panel, 2, 'metric_timestamp', 'timestamp_ntz' FROM panels
UNION ALL SELECT 'panel_' || panel, CAST(2 + id - (panel - 1) * {PANEL_WIDTH} AS INTEGER), 'metric_' || id, 'decimal(28,15)' FROM placed
""")
def q_catalog_schema(spark: SparkSession, d: str) -> DataFrame:
    """The columns of the panel tables that the metric catalog asks for: each panel holds one id range, and its
    (empty) table is made from the schema and described."""
    from tessera.plans.generate import panel_schema

    cat = metric_catalog(Tables(spark, d))
    rows = [(r["name"], r["table_name"]) for r in cat.orderBy("metric_id").select("name", "table_name").collect()]
    out = []
    for table in dict.fromkeys(t for _, t in rows):
        made = spark.createDataFrame([], panel_schema(rows, table))
        out += [(table, i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(made.schema)]
    return spark.createDataFrame(out, "table_name string, position int, column_name string, data_type string")


TOP_ROWS = 500


@register("panel_top_rows", f"""
SELECT o_custkey AS customer_id, o_orderdate AS metric_timestamp, CAST(o_totalprice AS DECIMAL(18,2)) AS metric_1
FROM orders ORDER BY o_custkey, o_orderdate, o_totalprice LIMIT {TOP_ROWS}
""")
def q_panel_top_rows(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of a panel by person and time: each task keeps its own first rows before they meet."""
    panel = order_metric_store(Tables(spark, d)).panels["panel_1"]
    return panel.orderBy("customer_id", "metric_timestamp", "metric_1").limit(TOP_ROWS)
