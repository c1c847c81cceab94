"""Small column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# The ISO layout of exported timestamps, as a format and as the text it accepts.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
ISO_TEXT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,6}$"


def parse_iso(text: Column) -> Column:
    """ISO text to a timestamp without zone; anything else is null, whatever the session zone."""
    return F.when(text.rlike(ISO_TEXT), text.try_cast("timestamp_ntz"))


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, ISO_FORMAT)


def month_key(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM")


def in_month(timestamp: Column, month: str) -> Column:
    """Same rows as comparing ``month_key``, but as a range that reaches the Parquet statistics."""
    start = dt.date.fromisoformat(f"{month}-01")
    following = (start + dt.timedelta(days=31)).replace(day=1)

    def bound(day: dt.date) -> Column:
        return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")

    return (timestamp >= bound(start)) & (timestamp < bound(following))


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)
