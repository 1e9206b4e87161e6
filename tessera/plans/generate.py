"""Seeded synthetic data jobs, run on Spark (no driver-side loops over rows).

* ``synthetic_sales`` — daily deliveries of 128-256 sales, stamps +1 per row with
  an occasional jump, keys drawn uniformly from a key table.
* ``synthetic_people`` — people per city from city weights × a factor, md5 names.
* ``metric_catalog_range`` / ``panel_schema`` — the metric catalog and the panel
  table schemas derived from it.
* ``synthetic_metric_panels`` — hourly rows per person with random metric values.

Random columns are materialised with ``checkpoint()`` (reliable, in the shared
checkpoint folder) before they are used twice, so a recomputed partition cannot
change values that another branch of the plan already consumed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.stamps import hex_stamp
from tessera.functions.timeparts import date_literal, ntz_literal
from tessera.operators.joins import maybe_broadcast
from tessera.session import ensure_checkpoint_dir
from tessera.sources.series import explode_hours

# Fixed values of the sales generator.
ROWS_PER_DAY = (128, 256)
AMOUNT_RANGE = (1, 16)
JUMP_ONE_IN = 17
JUMP_RANGE = (32, 2048)
# Fixed values of the people generator: person weights of the five cities.
CITY_WEIGHTS = (80, 10, 6, 3, 1)
# Fixed values of the metric store: 1700 metrics, 1600-column table limit minus 10.
METRIC_COUNT = 1700
TABLE_COLUMN_LIMIT = 1600
KEY_COLUMNS = 10


def _uniform_int(lo: int, hi: int, seed: int):
    return (F.lit(lo) + F.floor(F.rand(seed) * (hi - lo + 1))).cast("int")


def numbered_keys(keys: DataFrame, key: str) -> DataFrame:
    """Dense 0-based index per distinct key, computed distributed (zipWithIndex).

    Sorting inside each (hash) partition makes the numbering identical when a
    lost partition is recomputed, so a retried task draws the same keys.
    """
    distinct = keys.select(key).distinct().sortWithinPartitions(key)
    schema = T.StructType([distinct.schema[key], T.StructField("key_idx", T.LongType(), False)])
    return distinct.rdd.zipWithIndex().map(lambda p: (p[0][0], p[1])).toDF(schema)


def synthetic_sales(
    spark: SparkSession,
    keys: DataFrame,
    key: str,
    days: int,
    first_day: dt.date,
    start_id: int = 0,
    start_stamp: int = 0,
    seed: int = 42,
) -> DataFrame:
    """``id, character_id, sale_date, amount, verstamp`` for ``days`` consecutive days.

    Continues from a previous file via ``start_id`` / ``start_stamp`` (its maxima,
    see ``resume_point``). Row offsets are prefix sums over per-day totals (one row
    per day), and the running stamp inside a day is a window over that day only,
    so no step puts all rows into a single partition.
    """
    ensure_checkpoint_dir(spark)
    lo, hi = ROWS_PER_DAY
    day_rows = spark.range(days).select(F.col("id").alias("day"), _uniform_int(lo, hi, seed).alias("n"))
    before = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    day_rows = day_rows.withColumn("id0", F.coalesce(F.sum("n").over(before), F.lit(0)))  # one row per day
    rows = day_rows.select("day", "id0", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("k"))
    jlo, jhi = JUMP_RANGE
    step = F.lit(1) + F.when(F.rand(seed + 1) < 1.0 / JUMP_ONE_IN, _uniform_int(jlo, jhi, seed + 2)).otherwise(0)
    alo, ahi = AMOUNT_RANGE
    rows = rows.select(
        "day", "k", (F.lit(start_id) + F.col("id0") + F.col("k")).alias("id"),
        step.cast("long").alias("step"), _uniform_int(alo, ahi, seed + 3).alias("amount"),
        F.rand(seed + 4).alias("u"),
    ).checkpoint()
    in_day = Window.partitionBy("day").orderBy("k")
    rows = rows.withColumn("cum", F.sum("step").over(in_day))
    totals = rows.groupBy("day").agg(F.sum("step").alias("t"))
    offsets = totals.select("day", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("off"))
    rows = rows.join(F.broadcast(offsets), "day")  # one row per day
    numbered = numbered_keys(keys, key)
    n_keys = numbered.count()
    if n_keys == 0:
        raise ValueError("no keys to draw from")
    rows = rows.withColumn("key_idx", F.floor(F.col("u") * n_keys).cast("long"))
    rows = rows.join(maybe_broadcast(numbered), "key_idx")
    return rows.select(
        F.col("id").cast("long").alias("id"),
        F.col(key).cast("string").alias("character_id"),
        F.date_add(date_literal(first_day), F.col("day").cast("int")).alias("sale_date"),
        F.col("amount").cast("int").alias("amount"),
        hex_stamp(F.lit(start_stamp) + F.col("off") + F.col("cum")).alias("verstamp"),
    )


def resume_point(sales: DataFrame) -> tuple[int, dt.date | None, int]:
    """``max(id), max(sale_date), max(stamp)`` of existing sales (one aggregate row)."""
    from tessera.functions.stamps import stamp_value

    r = sales.agg(F.max("id").alias("i"), F.max("sale_date").alias("d"),
                  F.max(stamp_value("verstamp")).alias("s")).first()
    return (r["i"] or 0, r["d"], r["s"] or 0)


def synthetic_people(spark: SparkSession, factor: int = 10, seed: int = 42,
                     weights: Sequence[int] = CITY_WEIGHTS) -> DataFrame:
    """``customer_id, city_id, first_name, last_name``; city ``i`` gets ``weights[i-1] * factor`` people.

    Ids are dense (1..n, city by city, like a serial key): each city's offset is the
    running total of the earlier cities' counts, known from the weights alone.
    """
    rows, offset = [], 0
    for i, x in enumerate(weights):
        rows.append((i + 1, int(x) * factor, offset))
        offset += int(x) * factor
    w = spark.createDataFrame(rows, "city_id int, n_people int, id0 long")
    people = w.select("city_id", "id0", F.explode(F.sequence(F.lit(1), F.col("n_people"))).alias("n"))
    return people.select(
        (F.col("id0") + F.col("n")).alias("customer_id"),
        "city_id",
        F.md5(F.rand(seed).cast("string")).alias("first_name"),
        F.md5(F.rand(seed + 1).cast("string")).alias("last_name"),
    )


def metric_catalog_range(spark: SparkSession, n_metrics: int = METRIC_COUNT,
                         column_limit: int = TABLE_COLUMN_LIMIT) -> DataFrame:
    """``metric_id, name, explain, data_type, table_name`` for ``metric_1 … metric_n``.

    Panel ``i`` owns ids ``[1 + (i-1)·N, i·N]`` with ``N = column_limit - 10``.
    """
    per_panel = column_limit - KEY_COLUMNS
    ids = spark.range(1, n_metrics + 1).select(F.col("id").cast("int").alias("metric_id"))
    return ids.select(
        "metric_id",
        F.concat(F.lit("metric_"), F.col("metric_id").cast("string")).alias("name"),
        F.lit("metric").alias("explain"),
        F.lit("numeric").alias("data_type"),
        F.concat(F.lit("customer_metric_"),
                 (F.floor((F.col("metric_id") - 1) / per_panel) + 1).cast("string")).alias("table_name"),
    )


def panel_schema(catalog_rows: Sequence[tuple[str, str]], table: str,
                 metric_type: T.DataType = T.DecimalType(28, 15)) -> T.StructType:
    """Schema of one panel table from ``(name, table_name)`` catalog rows (ordered by metric id)."""
    fields = [T.StructField("customer_id", T.LongType(), False),
              T.StructField("metric_timestamp", T.TimestampNTZType(), False)]
    fields += [T.StructField(n, metric_type, True) for n, t in catalog_rows if t == table]
    return T.StructType(fields)


def synthetic_metric_panels(
    people: DataFrame,
    catalog_rows: Sequence[tuple[str, str]],
    start: dt.datetime,
    end: dt.datetime,
    filled_per_panel: int | None = None,
    seed: int = 42,
    metric_type: str = "decimal(28,15)",
    row_limit: int | None = None,
) -> dict[str, DataFrame]:
    """One frame per panel: every person × every hour in ``[start, end]`` with random values
    in [0, 1) for the first ``filled_per_panel`` metrics of the panel and NULL for the rest.

    ``row_limit`` keeps the first rows by ``(customer_id, metric_timestamp)`` (a
    top-k: each task keeps its best ``row_limit`` rows before the final merge).
    """
    hours = people.select("customer_id", ntz_literal(start).alias("a"), ntz_literal(end).alias("b"))
    grid = explode_hours(hours, ["customer_id"], "a", "b")
    panels = {}
    for p_i, table in enumerate(sorted({t for _, t in catalog_rows})):
        names = [n for n, t in catalog_rows if t == table]
        parts = []
        for j, n in enumerate(names):
            filled = filled_per_panel is None or j < filled_per_panel
            v = f"rand({seed + p_i * 100000 + j})" if filled else "NULL"
            parts.append(f"'{n}', CAST({v} AS {metric_type})")
        # one struct expression expanded JVM-side: a 1,600-column panel costs one call
        metrics = F.expr(f"named_struct({', '.join(parts)})").alias("__m")
        frame = grid.select("customer_id", "metric_timestamp", metrics).select(
            "customer_id", "metric_timestamp", "__m.*")
        if row_limit is not None:
            frame = frame.orderBy("customer_id", "metric_timestamp").limit(row_limit)
        panels[table] = frame
    return panels


def write_panels(panels: dict[str, DataFrame], base: str, buckets: int | None = None) -> dict[str, str]:
    """Write each panel sorted by person (row-group skipping for point queries); paths returned."""
    out = {}
    for table, df in panels.items():
        path = f"{base.rstrip('/')}/{table}"
        data = df.repartition(buckets, "customer_id") if buckets else df
        data.sortWithinPartitions("customer_id", "metric_timestamp").write.mode("overwrite").parquet(path)
        out[table] = path
    return out


def write_panel_tables(panels: dict[str, DataFrame], base: str, buckets: int,
                       table_prefix: str = "") -> dict[str, str]:
    """Panels as bucketed, sorted tables (external, under ``base``): ``bucketBy(customer_id)``.

    Two panels with the same bucket count join on ``(customer_id, metric_timestamp)``
    without a shuffle (with ``spark.sql.requireAllClusterKeysForCoPartition=false``),
    and a point query on one person reads one bucket. A person has at most one row
    per hour, so a bucket cannot be dominated by one hot key.
    """
    out = {}
    for table, df in panels.items():
        name = f"{table_prefix}{table}"
        # hash partitioning on the bucket key puts each bucket in one task: one file
        # per bucket, whose sort order a bucketed scan can then keep
        (df.repartition(buckets, "customer_id").write.mode("overwrite").option("path", f"{base.rstrip('/')}/{name}")
           .bucketBy(buckets, "customer_id").sortBy("customer_id", "metric_timestamp").saveAsTable(name))
        out[table] = name
    return out
