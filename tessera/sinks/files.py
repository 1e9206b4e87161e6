"""File sinks for the incremental jobs and the metric store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.stamps import ZERO_STAMP, stamp_value
from tessera.functions.timeparts import date_literal, trunc_ntz
from tessera.sources.files import RANGE_COLUMNS, STATE_SCHEMA, read_state


def stamped_path(base: str, stamp: str) -> str:
    """Directory of one run's result, named by the run's new watermark (K1)."""
    return f"{base.rstrip('/')}/verstamp={stamp}"


def write_stamped(df: DataFrame, base: str, stamp: str, fmt: str = "csv") -> str:
    """Write one run's result; overwriting the same stamp makes a rerun idempotent.

    The frame keeps its partitioning (a sorted result is range partitioned, so
    the part files are in order); nothing is funnelled through one task.
    """
    path = stamped_path(base, stamp)
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_watermark(spark: SparkSession, path: str, stamp: str, intended: str | None = None) -> None:
    """Append a new state (K3 initialise / K4 advance): nothing is replaced, so no crash loses the state."""
    now = read_state(spark, path)
    row = (stamp, (now.version if now else 0) + 1, intended)
    spark.createDataFrame([row], STATE_SCHEMA).coalesce(1).write.mode("append").option("header", True).csv(path)


def reset_watermark(spark: SparkSession, path: str) -> None:
    """Forced restart: state back to the zero stamp (K3 with ``is_restart``)."""
    write_watermark(spark, path, ZERO_STAMP)


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows as new files (K5); a file stream over ``path`` sees each append."""
    df.write.mode("append").option("header", True).csv(path)


STAMP_BITS = 20  # a range of deliveries: about a million stamps


def append_delivery(df: DataFrame, path: str, bits: int = STAMP_BITS) -> None:
    """Append rows as new files in the directories of their stamp ranges (K5): a run that starts at a
    watermark lists all ranges and reads those from its own on. Rows of a range come together, so a
    delivery writes few files; AQE splits a range that is large."""
    stamp = F.col("stamp") if "stamp" in df.columns else stamp_value("verstamp")
    out = df.withColumn("stamp_bits", F.lit(bits)).withColumn("stamp_range", F.shiftright(stamp.cast("bigint"), bits))
    out.hint("rebalance", F.col("stamp_range")).write.mode("append").option("header", True).partitionBy(*RANGE_COLUMNS).csv(path)


def cluster_by_month(df: DataFrame, month_col: str) -> DataFrame:
    """Rows of a month together for a partitioned write. The rebalance hint lets AQE split a month that
    is larger than the advisory partition size and merge small ones."""
    return df.hint("rebalance", F.col(month_col))


def write_monthly(df: DataFrame, path: str, ts: str, month_col: str = "month", fmt: str = "parquet",
                  sort_within: Sequence[str] = ()) -> None:
    """Monthly range partitions (K7) as ``partitionBy(month)``; reloads replace only their months.

    Rows are clustered by month, so each task writes few files, and optionally sorted
    inside (e.g. by entity key) so Parquet min/max skips row groups.
    """
    out = cluster_by_month(df.withColumn(month_col, trunc_ntz("month", ts).cast("date")), month_col)
    if sort_within:
        out = out.sortWithinPartitions(month_col, *sort_within)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(month_col).format(fmt).save(path))


def month_filter(month_col: str, start=None, end=None):
    """Partition predicate derived from timestamp bounds (``ts`` bounds alone do not prune months)."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(month_col) >= F.trunc(date_literal(start), "month"))
    if end is not None:
        cond = cond & (F.col(month_col) <= F.trunc(date_literal(end), "month"))
    return cond
