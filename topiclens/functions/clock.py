"""Time relative to the cut: the moment the study window starts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Start of the study window, its last day and the bin width in hours.
CUT = "2017-03-01 00:00:00"
LAST_DAY = 60
BIN_HOURS = 4


def seconds_since(ts: Column, cut: str = CUT) -> Column:
    """Whole seconds from the cut to `ts`; negative before the cut."""
    start = F.unix_timestamp(F.lit(cut).cast("timestamp"))
    return F.unix_timestamp(ts.cast("timestamp")) - start


def hours_since(ts: Column, cut: str = CUT) -> Column:
    return seconds_since(ts, cut) / F.lit(3600.0)


def days_since(date: Column, cut: str = CUT) -> Column:
    """Whole calendar days from the cut to a date (or date text)."""
    return F.datediff(date.cast("date"), F.lit(cut).cast("timestamp").cast("date"))


def hour_to_day(hours: Column) -> Column:
    """Day of an hour offset; floors, so hour -1 is on day -1."""
    return F.floor(hours / F.lit(24)).cast("int")


def hour_bin(hours: Column, width: int = BIN_HOURS) -> Column:
    """Start hour of the bin an hour offset falls in."""
    return (F.floor(hours / F.lit(width)) * F.lit(width)).cast("int")


def day_to_date(day: Column, cut: str = CUT) -> Column:
    return F.date_add(F.lit(cut).cast("timestamp").cast("date"), day.cast("int"))


def hour_to_timestamp(hours: Column, cut: str = CUT) -> Column:
    """Start of an hour offset as a timestamp."""
    start = F.unix_timestamp(F.lit(cut).cast("timestamp"))
    return F.timestamp_seconds(start + F.floor(hours * F.lit(3600)).cast("long"))
