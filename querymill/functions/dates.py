"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the zone that run dates are taken in.
DEFAULT_ZONE = "Asia/Singapore"


def as_timestamp(value: Column, on_error: str = "fail") -> Column:
    """Wall-clock timestamp of a date or timestamp text.

    A text that is no timestamp stops the query (``on_error="fail"``) or gives
    NULL (``on_error="null"``), whatever the session's ANSI setting. The result
    carries no zone, so the session zone cannot move a date over midnight.
    """
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    parsed = value.try_cast("timestamp_ntz")
    if on_error == "null":
        return parsed
    refused = F.raise_error(
        F.concat(F.lit("not a timestamp: "), value.cast("string"))
    ).cast("timestamp_ntz")
    return F.coalesce(parsed, F.when(value.isNotNull(), refused))


def year_of(value: Column, on_error: str = "fail") -> Column:
    return F.year(as_timestamp(value, on_error))


def month_of(value: Column, on_error: str = "fail") -> Column:
    return F.month(as_timestamp(value, on_error))


def wall_clock() -> Column:
    """Current time without a zone; one value for the whole query."""
    return F.localtimestamp()


def today(zone: str = DEFAULT_ZONE, utc: Column | None = None) -> Column:
    """Date in ``zone`` at the UTC wall-clock time ``utc`` (default: now)."""
    if utc is None:
        utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.localtimestamp())
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def yesterday(zone: str = DEFAULT_ZONE, utc: Column | None = None) -> Column:
    """The day before :func:`today` in the same zone."""
    return F.date_sub(today(zone, utc), 1)


def iso_date(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM-dd")


def ordered_number(time: Column, kind: str) -> Column:
    """A date, timestamp or number of type ``kind`` as a double that grows with it.

    Numbers beyond 2**53 may fall together, but never change their order.
    """
    day = F.datediff(time.cast("date"), F.lit("1970-01-01").cast("date")).cast("double")
    if kind == "timestamp":
        return F.unix_micros(time).cast("double")
    if kind == "timestamp_ntz":
        # Days and time of day apart, so that no zone comes in.
        seconds = F.hour(time) * 3600 + F.minute(time) * 60 + F.extract(F.lit("SECOND"), time)
        return day * 86400 + seconds.cast("double")
    if kind == "date":
        return day
    return time.cast("double")
