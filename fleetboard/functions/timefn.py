"""Epoch seconds and local time, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Chicago"
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def epoch_of(as_of: int | Column | None) -> Column:
    """The "now" of a query in epoch seconds; None means the wall clock."""
    if as_of is None:
        return F.unix_timestamp()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("bigint")


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a TIMESTAMP_NTZ column, read as UTC."""
    return (
        F.unix_date(ts.cast("date")).cast("bigint") * 86400
        + F.hour(ts) * 3600
        + F.minute(ts) * 60
        + F.second(ts)
    )


def _local(seconds: Column, zone: str) -> Column:
    utc = F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def local_time(seconds: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Epoch seconds as ``yyyy-MM-dd HH:mm:ss`` text in ``zone``."""
    return _local(seconds, zone).cast("string")


def local_hour(seconds: Column, zone: str = DEFAULT_ZONE) -> Column:
    return F.hour(_local(seconds, zone))


def iso_date(text: Column) -> Column:
    """``yyyyMMdd`` text as ``yyyy-MM-dd`` text; NULL when it is no date."""
    return F.try_to_date(text, "yyyyMMdd").cast("string")


def rowtime(seconds: Column) -> Column:
    """Event time of a stream, for ``withWatermark``."""
    return F.timestamp_seconds(seconds)
