from sensorloom.functions.labels import WEEKDAY_ORDER, percent, weekday_label, year_week_label
from sensorloom.functions.time import (
    calendar_columns,
    next_hour,
    parse_utc,
    utc_iso,
    utc_iso_text,
)

__all__ = [
    "WEEKDAY_ORDER",
    "calendar_columns",
    "next_hour",
    "parse_utc",
    "percent",
    "utc_iso",
    "utc_iso_text",
    "weekday_label",
    "year_week_label",
]
