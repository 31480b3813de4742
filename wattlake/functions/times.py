"""Timestamps: ISO-8601 text, file stamps, UTC and local days, partition strings."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stamp at the start of a Bronze file name (22 characters) and ISO output.
FILE_STAMP = "yyyyMMdd'T'HHmmssSSSSSS'Z'"
FILE_STAMP_LENGTH = 22
ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def parse_iso(text: Column) -> Column:
    """ISO-8601 with ``Z`` or an offset; null and empty text give null, other text must parse."""
    return F.nullif(text, F.lit("")).cast("timestamp")


def format_iso(time: Column) -> Column:
    return F.date_format(time, ISO)


def parse_stamp(text: Column) -> Column:
    return F.to_timestamp(F.substring(text, 1, FILE_STAMP_LENGTH), FILE_STAMP)


def format_stamp(time: Column) -> Column:
    return F.date_format(time, FILE_STAMP)


def utc(moment: datetime) -> datetime:
    """Read a zone-less datetime as UTC."""
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def instant(moment: datetime) -> Column:
    """A driver-side moment as a literal, exact to the microsecond."""
    return F.lit(utc(moment).isoformat()).cast("timestamp")


def day_of(time: Column, time_zone: str | None = None) -> Column:
    """Calendar day of an instant, in UTC or in a named zone."""
    return F.to_date(F.from_utc_timestamp(time, time_zone) if time_zone else time)


def day_start(day: Column, time_zone: str | None = None) -> Column:
    """The instant a calendar day starts at, in UTC or in a named zone."""
    midnight = day.cast("timestamp")
    return F.to_utc_timestamp(midnight, time_zone) if time_zone else midnight


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def days_in_month(month: Column) -> Column:
    return F.dayofmonth(F.last_day(month))


def date_parts(time: Column) -> dict[str, Column]:
    """Zero-padded strings, the way partition folders are named."""
    return {
        "year": F.date_format(time, "yyyy"),
        "month": F.date_format(time, "MM"),
        "day": F.date_format(time, "dd"),
    }
