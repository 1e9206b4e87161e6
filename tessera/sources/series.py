"""Generated series: integer ranges and hourly timestamps (S10, S11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hourly_points(start: Column, end: Column) -> Column:
    """Array of hourly timestamps, both ends inclusive."""
    return F.sequence(start, end, F.expr("INTERVAL 1 HOUR"))


def explode_hours(rows: DataFrame, keep: Sequence[str], start: str, end: str, out: str = "metric_timestamp") -> DataFrame:
    """One row per key and hour in ``[start, end]`` — generated inside each row's task, no cross join."""
    return rows.select(*keep, F.explode(hourly_points(F.col(start), F.col(end))).alias(out))
