"""Text building: numbers, durations, clock times, key=value descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seconds range of the years 0001-9999; device clocks outside it have no calendar date.
FIRST_SECOND = -62135596800
LAST_SECOND = 253402300799


def fixed6(value: Column) -> Column:
    """Six decimals, ties to even, as printf("%.6f") prints a widened float."""
    return F.call_function("format_number", value.cast("double"), F.lit("0.000000"))


def number(value: Column) -> Column:
    return value.cast("string")


def duration(seconds: Column) -> Column:
    """45 -> 45s, 90 -> 1m 30s, 3700 -> 1h 1m 40s; negative values keep their sign as plain seconds."""
    s = seconds.cast("bigint")
    hours = F.floor(s / F.lit(3600))
    minutes = F.floor((s % 3600) / F.lit(60))
    rest = F.concat(number(s % 60), F.lit("s"))
    return (
        F.when(s < 60, F.concat(number(s), F.lit("s")))
        .when(s < 3600, F.concat(number(minutes), F.lit("m "), rest))
        .otherwise(F.concat(number(hours), F.lit("h "), number(minutes), F.lit("m "), rest))
    )


def calendar_time(epoch: Column) -> Column:
    return F.when(epoch.between(FIRST_SECOND, LAST_SECOND), F.timestamp_seconds(epoch))


def utc_stamp(epoch: Column) -> Column:
    """[2024-05-14 08:30:01 UTC]"""
    return F.concat(F.lit("["), F.date_format(calendar_time(epoch), "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC]"))


def clock(epoch: Column) -> Column:
    return F.date_format(calendar_time(epoch), "HH:mm:ss")


def event_date(epoch: Column) -> Column:
    """Partition date of a device clock value; NULL for clocks outside the calendar."""
    return F.to_date(calendar_time(epoch))


def cut(text: Column, length: int) -> Column:
    return F.substring(text, 1, length)


def log_line(epoch: Column, severity: Column, node_id: Column, description: Column) -> Column:
    """One line of the security alert log; a clock outside the calendar is printed as its number."""
    stamp = F.coalesce(utc_stamp(epoch), F.concat(F.lit("["), epoch.cast("string"), F.lit("]")), F.lit("[no time]"))
    return F.concat(
        stamp, F.lit(" ["), severity, F.lit("] "), node_id, F.lit(" — "), description
    )
