"""Epoch seconds to wall-clock columns, independent of the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


#: Epoch seconds of the years 1 to 9999, less a day at both ends for time zones.
FIRST_SECOND, LAST_SECOND = -62_135_510_400, 253_402_214_400


def timely(dt: Column) -> Column:
    """Whether epoch seconds fall into the calendar."""
    return F.coalesce(dt.between(FIRST_SECOND, LAST_SECOND), F.lit(False))


def obs_time(dt: Column, tz: str = "UTC") -> Column:
    """Epoch seconds as the local wall-clock TIMESTAMP_NTZ of ``tz``; null outside the calendar."""
    inside = F.when(timely(dt), dt.cast("bigint"))
    utc = F.timestamp_add("SECOND", inside, F.expr(EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def obs_date(dt: Column, tz: str = "UTC") -> Column:
    return F.to_date(obs_time(dt, tz))


def to_day(text: Column) -> Column:
    """Text as a date, null where it is none."""
    return text.try_cast("date")


def obs_hour(dt: Column, tz: str = "UTC") -> Column:
    return F.hour(obs_time(dt, tz))


def epoch_seconds(ts: Column) -> Column:
    """TIMESTAMP_NTZ (read as UTC) to whole epoch seconds.

    Built from the fields of ``ts``: a timestamp difference would pass through the session zone.
    """
    days = F.unix_date(F.to_date(ts)).cast("bigint")
    return ((days * 24 + F.hour(ts)) * 60 + F.minute(ts)) * 60 + F.second(ts)


def hour_start(date: Column, hour: Column) -> Column:
    """The TIMESTAMP_NTZ at which ``hour`` of ``date`` begins."""
    return F.timestamp_add("HOUR", hour, date.cast("timestamp_ntz"))


def epoch_hour(date: Column, hour: Column) -> Column:
    """Hours since 1970-01-01 00:00, an orderable integer for range frames."""
    return F.unix_date(date).cast("bigint") * 24 + hour
