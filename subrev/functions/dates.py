"""Date parsing and calendar arithmetic."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date format of the model and the texts a day-first reader accepts.
DATE_PATTERN = r"^\d{2}-\d{2}-\d{4}$"
DATE_FORMAT = "dd-MM-yyyy"
DAY_FIRST_PATTERN = r"^\d{2}-\d{2}-\d{4}( \d{2}:\d{2}:\d{2})?$"
ISO_PATTERN = r"^\d{4}-\d{2}-\d{2}( \d{2}:\d{2}:\d{2})?$"


def has_date_format(c: Column) -> Column:
    """True when the trimmed text looks like dd-mm-yyyy; false for null."""
    return F.coalesce(F.trim(c.cast("string")).rlike(DATE_PATTERN), F.lit(False))


def _reordered(t: Column) -> Column:
    """dd-mm-yyyy text, with or without time, in ISO order: casting that is far cheaper than a
    pattern-driven parse."""
    return F.concat(F.substring(t, 7, 4), F.lit("-"), F.substring(t, 4, 2), F.lit("-"), F.substring(t, 1, 2),
                    F.substring(t, 11, 9))


def _iso_text(t: Column) -> Column:
    return F.when(t.rlike(DAY_FIRST_PATTERN), _reordered(t)).when(t.rlike(ISO_PATTERN), t)


def parse_date(c: Column) -> Column:
    """Strict dd-mm-yyyy parse; anything else, and impossible dates, give null."""
    t = F.trim(c)
    return F.when(t.rlike(DATE_PATTERN), _reordered(t)).try_cast("date")


def parse_date_part(c: Column) -> Column:
    """Strict parse of the first word of a date-time text."""
    return parse_date(F.split_part(F.trim(c), F.lit(" "), F.lit(1)))


def parse_day_first(c: Column) -> Column:
    """Lenient parse to a date: day-first or ISO; a time of day is cut off."""
    return F.substring(_iso_text(F.trim(c)), 1, 10).try_cast("date")


def parse_day_first_time(c: Column) -> Column:
    """Lenient parse to a timestamp: day-first or ISO, with or without time."""
    return _iso_text(F.trim(c)).try_cast("timestamp")


def as_date_lit(d: date | str) -> Column:
    return F.lit(str(d)).cast("date")


def month_key(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def month_number(c: Column) -> Column:
    """Months since year 0, so that a difference is a calendar-month difference."""
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def months_between(start: Column, end: Column) -> Column:
    return month_number(end) - month_number(start)


def days_between(start: Column, end: Column) -> Column:
    return F.datediff(end, start).cast("bigint")


def days_in_month(c: Column) -> Column:
    return F.dayofmonth(F.last_day(c)).cast("bigint")


def hours_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end) / 3600.0


def format_date(c: Column) -> Column:
    return F.date_format(c, DATE_FORMAT)
