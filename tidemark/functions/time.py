"""Time helpers on zone-less timestamps; none depends on the session time zone."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_naive_timestamp(c: Column, dtype: T.DataType) -> Column:
    """Cast to TIMESTAMP_NTZ, unreadable values to null. Whole numbers are microseconds."""
    if isinstance(dtype, T.IntegralType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", c.cast("bigint"), epoch)
    return c.try_cast("timestamp_ntz")


def naive(moment: datetime) -> Column:
    """A zone-less literal; lit(datetime) would go through the host's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def week_of(ts: Column) -> Column:
    """The Monday of the week."""
    return F.trunc(F.to_date(ts), "week")


def month_of(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "month")


def seconds_between(start: Column, end: Column) -> Column:
    """end - start, each side cut to whole seconds."""
    days = F.datediff(F.to_date(end), F.to_date(start)).cast("bigint")
    return (
        days * 86400
        + (F.hour(end) - F.hour(start)) * 3600
        + (F.minute(end) - F.minute(start)) * 60
        + (F.second(end) - F.second(start))
    )


def months_between_starts(start: Column, end: Column) -> Column:
    """Month boundaries crossed from one date to another."""
    return (F.year(end) - F.year(start)) * 12 + (F.month(end) - F.month(start))
