"""File readers with explicit schemas (no inference on the hot path)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.stamps import ZERO_STAMP, stamp_value

SALES_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("character_id", T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("amount", T.IntegerType()),
    T.StructField("verstamp", T.StringType()),
])

CHARACTER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("house", T.StringType()),
])

LOOKUP_SCHEMA = T.StructType([
    T.StructField("character_id", T.StringType()),
    T.StructField("house", T.StringType()),
])

# One row for each state of the job, appended; the largest version holds. ``intended`` is the
# upper stamp of a run that has begun and may have written, but has not been committed.
STATE_SCHEMA = T.StructType([
    T.StructField("verstamp", T.StringType()),
    T.StructField("version", T.LongType()),
    T.StructField("intended", T.StringType()),
])


def file_system(spark: SparkSession, path: str):
    """The store that holds ``path``, and the path as it names it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    store, p = file_system(spark, path)
    return store.exists(p)


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma CSV with a header row (S1)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """The append-only sales fact files: loose, or in stamp ranges (then with ``RANGE_COLUMNS``)."""
    return read_header_csv(spark, path, SALES_SCHEMA)


# Directories of deliveries kept by stamp: ``stamp_bits=<b>/stamp_range=<stamp >> b>``. The width stands in
# the path, so it may change from one delivery to the next.
RANGE_COLUMNS = ("stamp_bits", "stamp_range")


def in_range(stamp: int, compare: str) -> Column:
    """Partition predicate: ranges that lie ``compare`` (>=, <=) the range of ``stamp``."""
    bits, number = RANGE_COLUMNS
    return F.expr(f"{number} {compare} shiftright(cast({stamp} as bigint), cast({bits} as int))")


def read_semicolon_csv(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon CSV exported from a spreadsheet (S2/K10).

    All columns are read as text (dates are parsed by the caller); a UTF-8 BOM is
    removed by the reader, a leading index column is dropped if its header is blank,
    names are lower-cased and empty fields are NULL.
    """
    df = (
        spark.read.option("sep", ";").option("header", True).option("encoding", "UTF-8")
        .option("nullValue", "").option("inferSchema", False).csv(path)
    )
    names = [c.lstrip("﻿").strip().lower() for c in df.columns]
    if names[0] in ("", "_c0"):  # the reader's name for a blank first header
        df, names = df.drop(df.columns[0]), names[1:]
    return df.toDF(*names)


def read_master_json(spark: SparkSession, path: str, schema: T.StructType = CHARACTER_SCHEMA) -> DataFrame:
    """Master data snapshot: a JSON list of objects (S3); keeps ``id → character_id, house``.

    A list is one JSON value, so one task reads each file; large snapshots come as
    JSON lines (``read_master_json_lines``).
    """
    df = spark.read.schema(schema).option("multiLine", True).json(path)
    return df.select(F.col("id").alias("character_id"), "name", "house")


def read_master_json_lines(spark: SparkSession, path: str, schema: T.StructType = CHARACTER_SCHEMA) -> DataFrame:
    """Master data as JSON lines, which many tasks read."""
    df = spark.read.schema(schema).json(path)
    return df.select(F.col("id").alias("character_id"), "name", "house")


def read_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """``character_id,house`` lookup file (S5)."""
    return read_header_csv(spark, path, LOOKUP_SCHEMA)


class State(NamedTuple):
    verstamp: str
    version: int
    intended: str | None


def _missing(e: Exception) -> bool:
    return "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)


def read_state(spark: SparkSession, path: str) -> State | None:
    """The newest state (S6), None if there is none. A state is one appended file, committed whole,
    so a crash leaves the earlier one in force."""
    try:
        row = spark.read.schema(STATE_SCHEMA).option("header", True).csv(path).where("verstamp IS NOT NULL").agg(
            F.max_by(F.struct("verstamp", F.coalesce("version", F.lit(0)).alias("version"), "intended"),
                     F.coalesce("version", F.lit(0))).alias("s")).first()
    except Exception as e:
        if _missing(e):
            return None
        raise
    return State(**row["s"].asDict()) if row["s"] is not None else None


def read_watermark(spark: SparkSession, path: str, default: str | None = ZERO_STAMP) -> str | None:
    """The committed stamp; ``default`` when there is no state."""
    state = read_state(spark, path)
    return default if state is None else state.verstamp


def newest_output(spark: SparkSession, base: str) -> str | None:
    """The largest stamp among the results written under ``base``: where a job whose state was lost stands."""
    try:
        df = spark.read.option("header", True).csv(base)
    except Exception as e:
        if _missing(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    # by number: as text 0xf… would be above 0x1……… of nine digits
    return df.agg(F.max_by("verstamp", stamp_value("verstamp"))).first()[0] if "verstamp" in df.columns else None
