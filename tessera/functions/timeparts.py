"""Time bucketing and the date formats of the inputs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Aggregation codes of the metric functions and the date_trunc unit they mean.
BUCKET_UNITS = {"DY": "day", "WK": "week", "MO": "month"}
# Whole-period bucket: there is no infinite timestamp in Spark, so the open end
# is represented by this sentinel.
ALL_BUCKET_TIME = dt.datetime(9999, 12, 31, 0, 0, 0)

# Fixed input formats: day.month.year with or without seconds, and a plain date.
DMY_TIME_FORMATS = ("d.M.yyyy H:mm:ss", "d.M.yyyy H:mm")
DMY_DATE_FORMAT = "d.M.yyyy"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


_DATE_UNITS = {"day": None, "week": "week", "month": "month", "quarter": "quarter", "year": "year"}


def trunc_ntz(unit: str, ts: Column | str) -> Column:
    """``date_trunc`` that stays zone-less.

    Day and coarser units go through ``date`` (``trunc`` for week/month/…; weeks
    start on Monday), which never consults the session time zone; finer units use
    ``date_trunc`` and cast back to a zone-less timestamp.
    """
    u = unit.lower()
    if u in _DATE_UNITS:
        d = _c(ts).cast("date")
        if _DATE_UNITS[u]:
            d = F.trunc(d, _DATE_UNITS[u])
        return d.cast("timestamp_ntz")
    return F.date_trunc(unit, _c(ts)).cast("timestamp_ntz")


def ntz_literal(value: dt.datetime | dt.date | str) -> Column:
    """A zone-less timestamp literal built from text, so neither the Python process
    zone nor the session zone shifts it."""
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, dt.date):
        value = value.strftime("%Y-%m-%d 00:00:00")
    return F.lit(value).cast("timestamp_ntz")


def date_literal(value: dt.datetime | dt.date | str) -> Column:
    """A date literal from text (zone-independent)."""
    if isinstance(value, (dt.datetime, dt.date)):
        value = value.strftime("%Y-%m-%d")
    return F.lit(str(value)[:10]).cast("date")


def year_month(ts: Column | str) -> Column:
    """``to_char(ts, 'YYYYMM')``."""
    return F.date_format(_c(ts), "yyyyMM")


def parse_dmy_timestamp(s: Column | str) -> Column:
    """``25.01.2024 5:26:03`` or ``25.01.2024 5:26``; anything else is NULL."""
    c = _c(s)
    tries = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in DMY_TIME_FORMATS]
    return F.coalesce(*tries).cast("timestamp_ntz")


def parse_dmy_date(s: Column | str) -> Column:
    """``19.04.2018`` → date; blank or malformed → NULL."""
    return F.try_to_timestamp(_c(s), F.lit(DMY_DATE_FORMAT)).cast("date")
