"""Display labels and rounding."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label of each Spark `dayofweek` number, 1 to 7, in display order.
WEEKDAY_ORDER = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]


def weekday_label(day: Column) -> Column:
    """Short weekday name; any other number is shown as text."""
    pairs = chain.from_iterable((F.lit(n), F.lit(s)) for n, s in enumerate(WEEKDAY_ORDER, 1))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), day.cast("int")), day.cast("string"))


def year_week_label(year: Column, week: Column) -> Column:
    """``2024-03``: year and zero-padded week; null if either is."""
    label = F.format_string("%d-%02d", year.cast("int"), week.cast("int"))
    return F.when(year.isNotNull() & week.isNotNull(), label)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return F.round(part / whole * 100, digits)
