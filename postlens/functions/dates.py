"""Two clocks: the UTC instant of a date string, and its written wall clock."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Dates that do not start with a year, after a weekday is taken off.
WRITTEN_FORMATS = [
    "d MMM yyyy HH:mm:ss Z",
    "MMM d HH:mm:ss Z yyyy",
    "MMM d, yyyy[ HH:mm[:ss]]",
    "MMMM d, yyyy[ HH:mm[:ss]]",
    "d MMM yyyy[ HH:mm[:ss]]",
    "M/d/yyyy[ H:mm[:ss]]",
]


def as_time(value) -> Column:
    """A datetime, an ISO string or a column as a timestamp column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        if value.tzinfo is None:
            value = value.replace(tzinfo=dt.timezone.utc)
        return F.lit(value)
    return F.lit(value).cast("timestamp")


def hours_before(moment: Column, hours: int) -> Column:
    return moment - F.make_dt_interval(hours=F.lit(hours))


def normalize_datetime(text: Column) -> Column:
    """Date text as a UTC timestamp; anything else is NULL.

    Read are ISO dates, also with slashes, RFC 822, the form of raw tweets
    (weekday, month, day, time, offset, year), month names with day and year,
    and month/day/year.
    """
    dashed = F.regexp_replace(text, r"^(\s*\d{4})/(\d{1,2})/(\d{1,2})", "$1-$2-$3")
    iso = F.when(text.rlike(r"^\s*\d{4}"), dashed).try_cast("timestamp")
    written = F.regexp_replace(F.trim(text), r"^(?:[A-Za-z]{3},\s*|(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)\s+)", "")
    written = F.regexp_replace(written, r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return F.coalesce(iso, *[F.try_to_timestamp(written, F.lit(f)) for f in WRITTEN_FORMATS])


def wall_clock(text: Column) -> Column:
    """The time as written, whatever offset follows it; bad text is NULL."""
    local = F.regexp_extract(
        text, r"^(\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?)?)(?:Z|[+-]\d{2}:?\d{2})?$", 1
    )
    return F.when(local != "", local).try_cast("timestamp")


def posted_at(timestamp: Column, created_at: Column) -> Column:
    """Wall clock of ``timestamp``, or of ``created_at`` where there is none."""
    return wall_clock(F.coalesce(timestamp, created_at))


def first_written(*texts: Column) -> Column:
    """Wall clock of the first text that is not empty."""
    return wall_clock(F.coalesce(*[F.nullif(t, F.lit("")) for t in texts]))


def hour_key(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd-HH")


def iso(moment: Column) -> Column:
    return F.date_format(moment, ISO_FORMAT)
