"""Time buckets and labels that do not depend on the session time zone.

Readings carry epoch seconds, so buckets are whole-number arithmetic on them: a
bigint grouping key, computed in UTC and therefore unaffected by clock changes.
Only the few aggregated rows are turned into wall-clock times and labels, as
TIMESTAMP_NTZ. ``date_format`` is avoided on purpose: it would convert through the
session zone and move times that fall into that zone's clock-change gap.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR
WEEK = 7 * DAY

# Label texts of the reports.
WEEKDAYS = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
FROM_SEPARATOR = ", "
TO_SEPARATOR = " , "

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
_WEEK_STARTS = ("thursday", "friday", "saturday", "sunday", "monday", "tuesday", "wednesday")


def bucket_start(seconds: Column, width: int, offset: int = 0) -> Column:
    """Start, in epoch seconds, of the ``width``-second bucket that holds ``seconds``."""
    return seconds - F.pmod(seconds - F.lit(offset).cast("bigint"), F.lit(width).cast("bigint"))


def week_offset(week_start: str) -> int:
    """Seconds from the epoch, a Thursday, to the first ``week_start``."""
    if week_start.lower() not in _WEEK_STARTS:
        raise ValueError(f"week_start must be one of {_WEEK_STARTS}, not {week_start!r}")
    return _WEEK_STARTS.index(week_start.lower()) * DAY


def local_time(seconds: Column, tz: str = "UTC") -> Column:
    """Wall-clock time (TIMESTAMP_NTZ) in ``tz`` of an instant in epoch seconds."""
    utc = F.timestamp_add("SECOND", seconds, F.expr(_EPOCH))
    return utc if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_seconds(wall_time: Column, tz: str = "UTC") -> Column:
    """Whole epoch seconds of a wall-clock time (TIMESTAMP_NTZ) in ``tz``."""
    if tz != "UTC":
        wall_time = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall_time)
    return (wall_time - F.expr(_EPOCH)).cast("bigint")


def booking_time(date: Column, time: Column) -> Column:
    """TIMESTAMP_NTZ of a ``yyyy-MM-dd`` and a 24-hour ``HH:mm`` text; bad text gives NULL."""
    return F.concat(F.trim(date), F.lit(" "), F.nullif(F.trim(time), F.lit(""))).try_cast("timestamp_ntz")


def weekday_label(wall_time: Column) -> Column:
    names = F.array(*[F.lit(day) for day in WEEKDAYS])
    return F.get(names, F.weekday(wall_time.cast("date")))


def day_label(wall_time: Column, separator: str) -> Column:
    """``2017.09.28, Thu``"""
    day = F.translate(wall_time.cast("date").cast("string"), "-", ".")
    return F.concat(day, F.lit(separator), weekday_label(wall_time))


def clock_label(wall_time: Column) -> Column:
    """``1:00 PM``"""
    hour = F.hour(wall_time)
    twelve = F.pmod(hour + 11, F.lit(12)) + 1
    half = F.when(hour < 12, "AM").otherwise("PM")
    return F.concat(twelve.cast("string"), F.lit(":"), F.lpad(F.minute(wall_time).cast("string"), 2, "0"), F.lit(" "), half)


def hour_label(wall_time: Column) -> Column:
    """``07``"""
    return F.lpad(F.hour(wall_time).cast("string"), 2, "0")
