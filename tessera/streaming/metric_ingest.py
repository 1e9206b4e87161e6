"""Hourly metric arrival: a stream of panel rows into monthly partitions, with a live daily rollup.

Both the rows and the rollup's partial sums of each micro-batch go to a ``FoldedStore``: a replayed batch
replaces its earlier attempt, late rows are one more partial sum of their day (however late), and folding
turns batches into months.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.functions.timeparts import trunc_ntz
from tessera.streaming.folded import FoldedStore, summed


def panel_store(spark: SparkSession, target: str, schema: T.StructType, ts: str = "metric_timestamp",
                sort_key: str = "customer_id") -> FoldedStore:
    """The ingested rows. Rows are sorted by person inside each file, so Parquet min/max statistics let a
    point query on one person skip most row groups."""
    return FoldedStore(spark, f"{target.rstrip('/')}/panel", schema, sort_within=(sort_key, ts))


def rollup_store(spark: SparkSession, target: str, schema: T.StructType, metrics: list[str], sort_key: str = "customer_id") -> FoldedStore:
    """Partial sums by person and day: ``<metric>_sum`` and the number of rows. They merge by addition."""
    sums = [T.StructField(f"{m}_sum", _sum_type(schema[m].dataType)) for m in metrics]
    fields = [schema[sort_key], T.StructField("day", T.TimestampNTZType()), *sums, T.StructField("n_rows", T.LongType())]
    names = [*[f.name for f in sums], "n_rows"]
    return FoldedStore(spark, f"{target.rstrip('/')}/rollup", T.StructType(fields), merge=summed([sort_key, "day"], names), sort_within=(sort_key,))


def _sum_type(t: T.DataType) -> T.DataType:
    if isinstance(t, T.DecimalType):
        return T.DecimalType(38, t.scale)
    return T.DoubleType() if isinstance(t, (T.DoubleType, T.FloatType)) else T.LongType()


def partial_sums(rows: DataFrame, metrics: list[str], ts: str = "metric_timestamp", sort_key: str = "customer_id") -> DataFrame:
    """Sums of one batch by person and day, with the month they belong to."""
    day = trunc_ntz("day", ts)
    out = rows.groupBy(sort_key, day.alias("day")).agg(
        *[F.sum(m).cast(_sum_type(rows.schema[m].dataType)).alias(f"{m}_sum") for m in metrics], F.count(F.lit(1)).alias("n_rows"))
    return out.withColumn("month", trunc_ntz("month", "day").cast("date"))


def write_batch(panel: FoldedStore, rollup: FoldedStore | None, metrics: list[str], batch: DataFrame, batch_id: int,
                ts: str = "metric_timestamp", sort_key: str = "customer_id") -> None:
    """One micro-batch into both stores."""
    panel.write_batch(batch.withColumn("month", trunc_ntz("month", ts).cast("date")), batch_id)
    if rollup:
        rollup.write_batch(partial_sums(batch, metrics, ts, sort_key), batch_id)


def start_metric_ingest(
    rows: DataFrame,
    target: str,
    checkpoint: str,
    ts: str = "metric_timestamp",
    sort_key: str = "customer_id",
    available_now: bool = True,
    rollup: list[str] = (),
) -> StreamingQuery:
    """Append streaming panel rows to ``target``, and partial daily sums of the ``rollup`` columns beside them."""
    schema = rows.schema

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        panel = panel_store(spark, target, schema, ts, sort_key)
        sums = rollup_store(spark, target, schema, list(rollup), sort_key) if rollup else None
        write_batch(panel, sums, list(rollup), batch, batch_id, ts, sort_key)

    w = rows.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_rollup(spark: SparkSession, target: str, metrics: list[str], schema: T.StructType, ts: str = "metric_timestamp") -> DataFrame:
    """Per person and day sums over the ingested rows (batch read of the stream's output)."""
    df = panel_store(spark, target, schema, ts).read()
    return df.groupBy("customer_id", trunc_ntz("day", ts).alias("day")).agg(
        *[F.sum(m).alias(f"{m}_sum") for m in metrics])


def live_rollup(spark: SparkSession, target: str, metrics: list[str], schema: T.StructType) -> DataFrame:
    """The same from the partial sums: reads one row for each person, day and unfolded batch."""
    return rollup_store(spark, target, schema, metrics).read().drop("month")
