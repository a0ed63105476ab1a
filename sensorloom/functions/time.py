"""Time expressions. All of them assume a UTC session (see ``session.configure``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def parse_utc(text: Column) -> Column:
    """ISO-8601 text to timestamp; empty or malformed text gives null, also under ANSI."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def utc_iso(time: Column) -> Column:
    """Timestamp to ``2024-01-13T00:00:00Z``; fractions of a second are dropped."""
    return F.date_format(F.date_trunc("second", time), ISO_SECONDS)


def utc_iso_text(text: Column) -> Column:
    """Append the UTC marker to a time given as text, unless it is already there."""
    return F.when(text.endswith("Z"), text).otherwise(F.concat(text, F.lit("Z")))


def calendar_columns(time: Column) -> list[Column]:
    """``hour``, ``day_of_week`` (Sunday is 1) and ``month``."""
    return [
        F.hour(time).alias("hour"),
        F.dayofweek(time).alias("day_of_week"),
        F.month(time).alias("month"),
    ]


def next_hour(time: Column) -> Column:
    return time + F.expr("INTERVAL 1 HOUR")
