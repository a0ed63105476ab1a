"""Small fixtures built from literal rows."""

from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

READING = "sensor_id string, datetime timestamp, pm25 double"


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def hours(start: str, n: int, step_hours: float = 1) -> list[dt.datetime]:
    return [at(start) + dt.timedelta(hours=i * step_hours) for i in range(n)]


def series_rows(sensor: str, n: int, start: str = "2024-01-01", step_hours: float = 1):
    return [(sensor, t, float(i + 1)) for i, t in enumerate(hours(start, n, step_hours))]


def record(value, utc, parameter="pm25", label="1hour") -> dict:
    return {
        "value": value,
        "parameter": {"id": 2, "name": parameter, "units": "ug/m3"},
        "period": {"label": label, "datetimeTo": {"utc": utc, "local": utc}},
    }


def envelope(sensor_id, results, interval="hourly", count=None) -> dict:
    return {
        "sensor_id": sensor_id,
        "interval": interval,
        "date_from": "",
        "date_to": "",
        "count": len(results) if count is None else count,
        "results": results,
    }


def land(folder: Path, name: str, document) -> None:
    """One pretty-printed object per file, as the feeds write them."""
    folder.mkdir(parents=True, exist_ok=True)
    text = document if isinstance(document, str) else json.dumps(document, indent=2)
    (folder / name).write_text(text)


def tuples(df, *columns: str) -> list[tuple]:
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=repr)
