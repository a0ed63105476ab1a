"""Lag features, latest rows, the next-hour feature row, gaps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F

from sensorloom.functions import calendar_columns, next_hour
from sensorloom.operators.series import ROWS_PER_TASK, over_history
from sensorloom.schemas import CALENDAR_COLUMNS, LAGS


def lag_columns(window: WindowSpec, lags: int = LAGS) -> list[Column]:
    return [F.lag("pm25", i).over(window).alias(f"lag_{i}") for i in range(1, lags + 1)]


def complete_features(lagged: DataFrame, lags: int = LAGS) -> DataFrame:
    """Rows that have all their lags, in the column order of the feature table."""
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    return lagged.dropna(subset=[*names, "pm25"]).select(
        "sensor_id", "datetime", "pm25", *CALENDAR_COLUMNS, *names
    )


def lag_features(
    hourly_readings: DataFrame, lags: int = LAGS, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """The previous ``lags`` readings of the sensor as columns; lags count rows, not hours."""
    lagged = over_history(
        hourly_readings,
        depth=lags,
        columns=lambda window: lag_columns(window, lags),
        values=["pm25"],
        rows_per_task=rows_per_task,
    )
    return complete_features(lagged, lags)


def latest_per_sensor(readings: DataFrame) -> DataFrame:
    """The newest row of every sensor, of readings with one row per (sensor, time).

    One pass and one row per sensor and map task: with columns of fixed width this is a hash
    aggregate, so no task sorts its rows. De-duplicate first: of two rows at the newest time the
    columns may come from either.
    """
    rest = [c for c in readings.columns if c not in ("sensor_id", "datetime")]
    return (
        readings.groupBy("sensor_id")
        .agg(F.max("datetime").alias("datetime"), *[F.max_by(c, "datetime").alias(c) for c in rest])
        .select(*readings.columns)
    )


def latest_row(readings: DataFrame) -> DataFrame:
    """The newest row of all, ties going to the largest sensor id."""
    return readings.orderBy(F.desc("datetime"), F.desc("sensor_id")).limit(1)


def next_hour_features(latest: DataFrame, lags: int = LAGS) -> DataFrame:
    """Feature row of the hour after each given feature row: lags move on by one."""
    following = next_hour(F.col("datetime"))
    return latest.select(
        "sensor_id",
        following.alias("datetime"),
        F.col("pm25").alias("last_pm25"),
        *calendar_columns(following),
        F.col("pm25").alias("lag_1"),
        *[F.col(f"lag_{i - 1}").alias(f"lag_{i}") for i in range(2, lags + 1)],
    )


def lag_by_time(readings: DataFrame, hours: Iterable[int] = (1, 24)) -> DataFrame:
    """The value exactly so many hours earlier, as columns ``pm25_{n}h_ago``; null across gaps.

    Needs one row per (sensor, time). Equi-joins on both, so no sensor is one task's burden.
    """
    rows = readings
    for n in hours:
        earlier = readings.select(
            "sensor_id",
            (F.col("datetime") + F.expr(f"INTERVAL {n} HOURS")).alias("datetime"),
            F.col("pm25").alias(f"pm25_{n}h_ago"),
        )
        rows = rows.join(earlier, ["sensor_id", "datetime"], "left")
    return rows


def gap_report(
    readings: DataFrame, min_hours: float = 1, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Places where a sensor was silent for more than ``min_hours``."""
    with_previous = over_history(
        readings.select("sensor_id", "datetime").distinct(),  # copies have no gap between them
        depth=1,
        columns=lambda window: [F.lag("datetime", 1).over(window).alias("previous")],
        rows_per_task=rows_per_task,
    )
    micros = F.unix_micros("datetime") - F.unix_micros("previous")
    return with_previous.withColumn("gap_hours", micros / 3_600_000_000).filter(
        F.col("gap_hours") > min_hours
    )
