"""Incremental house sales as a Structured Streaming job.

New input files are the new deliveries; the source's checkpoint gives each file once.
The stamp filter's watermark is read once, when a checkpoint is first used, and holds
for all its micro-batches and restarts: stamps of different files may interleave, so
a watermark moved by one micro-batch would drop rows of the next. Master data is
re-read *inside* the batch, so every batch sees the current version. Each batch
overwrites its own directory, named by its batch id, so a replayed batch changes
nothing; the job's state then names the newest stamp seen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.plans.sales import run_stream_batch
from tessera.sinks.files import reset_watermark, write_watermark
from tessera.sources.files import read_watermark

RESULT = "sale_date date, house string, amount long, last_verstamp string"


def start_house_sales_stream(
    spark: SparkSession,
    source_path: str,
    source_schema: T.StructType,
    to_sales: Callable[[DataFrame], DataFrame],
    load_master: Callable[[], DataFrame],
    state_path: str,
    output_base: str,
    checkpoint: str,
    source_format: str = "parquet",
    available_now: bool = True,
    restart: bool = False,
    max_files_per_trigger: int | None = None,
) -> StreamingQuery:
    """Start the stream. ``restart=True`` resets the watermark and empties ``output_base``, so
    everything is processed anew (use a new ``checkpoint`` too)."""
    if restart:
        reset_watermark(spark, state_path)
        spark.createDataFrame([], RESULT).write.mode("overwrite").option("header", True).csv(output_base)
    floor_path = f"{checkpoint.rstrip('/')}-floor"
    floor = read_watermark(spark, floor_path, default=None)
    if floor is None:
        floor = read_watermark(spark, state_path)
        write_watermark(spark, floor_path, floor)
    reader = spark.readStream.schema(source_schema).format(source_format)
    if source_format == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = to_sales(reader.load(source_path))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        run_stream_batch(batch.sparkSession, batch, load_master(), floor, state_path,
                         f"{output_base.rstrip('/')}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_outputs(spark: SparkSession, output_base: str, schema: T.StructType | None = None) -> DataFrame:
    """All result directories as one frame (with their ``verstamp`` or ``batch``)."""
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(output_base)
