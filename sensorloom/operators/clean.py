"""Readings: quality filter, selections, calendar columns, de-duplication, resampling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions import calendar_columns
from sensorloom.schemas import SERIES_KEY

# Fixed value: the marker that stations send for "no measurement".
MISSING_VALUE = -999


def is_valid(parameter: str = "pm25") -> Column:
    """Quality predicate. NaN is tested apart because Spark orders it above every number."""
    value = F.col("pm25")
    return (
        (F.col("parameter") == parameter)
        & value.isNotNull()
        & ~F.isnan(value)
        & (value > 0)
        & (value != MISSING_VALUE)
        & F.col("datetime").isNotNull()
    )


def clean(
    readings: DataFrame, parameter: str = "pm25", keep: Iterable[str] = ()
) -> DataFrame:
    """Valid readings of one parameter; ``keep`` names further columns to carry along."""
    return readings.filter(is_valid(parameter)).select("sensor_id", "datetime", "pm25", *keep)


def hourly(cleaned: DataFrame) -> DataFrame:
    """Clean readings with their calendar columns."""
    return cleaned.select(*SERIES_KEY, *calendar_columns(F.col("datetime")), "pm25")


def ordered(readings: DataFrame) -> DataFrame:
    """Global order by sensor and time (a sampled range shuffle, so no sensor is one task)."""
    return readings.orderBy(*SERIES_KEY)


def in_time_range(readings: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Keep ``start <= datetime <= end``; either side may be open. Reaches the parquet scan."""
    if start:
        readings = readings.filter(F.col("datetime") >= F.lit(start).cast("timestamp"))
    if end:
        readings = readings.filter(F.col("datetime") <= F.lit(end).cast("timestamp"))
    return readings


def sensor_ids(setting: str | Iterable) -> list[str]:
    """Ids from a comma-separated setting (blanks ignored) or a sequence; none is an error."""
    parts = setting.split(",") if isinstance(setting, str) else setting
    ids = [text for text in (str(part).strip() for part in parts) if text]
    if not ids:
        raise ValueError("no sensor is named")
    return ids


def only_sensors(readings: DataFrame, setting: str | Iterable) -> DataFrame:
    return readings.filter(F.col("sensor_id").isin(sensor_ids(setting)))


def dedup(readings: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One row per (sensor, time): the last by ``order_by``, ties going to the largest values.

    A plain aggregate, so copies collapse before the shuffle however many one key has. With columns
    of fixed width it is hash aggregates, one for each column after the first, of which all but the
    first get few rows: no task sorts.
    """
    rest = [c for c in readings.columns if c not in SERIES_KEY]
    ranked = [*(order_by or []), *[c for c in rest if c not in (order_by or [])]]
    if len(ranked) == 1:
        return readings.groupBy(*SERIES_KEY).agg(largest(ranked[0]))
    if all(_fixed_width(readings, c) for c in ranked):
        return _best_by_hash(readings, ranked).select(*readings.columns)
    best = F.max(F.struct(*(_numbers_last(readings, c).alias(c) for c in ranked))).alias("best")
    return (
        readings.groupBy(*SERIES_KEY)
        .agg(best)
        .select(*[c if c in SERIES_KEY else F.col(f"best.{c}") for c in readings.columns])
    )


_FIXED = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")


def _fixed_width(readings: DataFrame, column: str) -> bool:
    return dict(readings.dtypes)[column] in _FIXED


def _best_by_hash(readings: DataFrame, ranked: list[str]) -> DataFrame:
    """The largest combination of the ranked columns for each key; null ranks lowest.

    The last column is settled first, for each value of those before it, then the one before.
    """
    *others, last = [c for c in ranked]
    rows = readings.select(*SERIES_KEY, *(_numbers_last(readings, c).alias(c) for c in ranked))
    rows = rows.groupBy(*SERIES_KEY, *others).agg(F.max(last).alias(last))
    while others:
        column, settled = others.pop(), ranked[len(others) + 1 :]
        unknown = F.max(column).isNull()
        rows = rows.groupBy(*SERIES_KEY, *others).agg(
            F.max(column).alias(column),
            *(
                F.when(unknown, F.max(F.when(F.col(column).isNull(), F.col(c)))).otherwise(F.max_by(c, column)).alias(c)
                for c in settled
            ),
        )
    return rows


def largest(column: str) -> Column:
    """The largest value of a floating column; NaN, which Spark ranks above all, only if alone."""
    numbers = F.max(F.nanvl(column, F.lit(None).cast("double")))
    return F.coalesce(numbers, F.max(column)).alias(column)


def _numbers_last(readings: DataFrame, column: str) -> Column:
    """A column in which a NaN ranks as null, below every number."""
    if dict(readings.dtypes)[column] not in ("double", "float"):
        return F.col(column)
    return F.when(~F.isnan(column), F.col(column))


def hourly_resample(cleaned: DataFrame) -> DataFrame:
    """Mean and count per sensor and clock hour, for sources that are not hourly already."""
    return cleaned.groupBy(
        "sensor_id", F.date_trunc("hour", "datetime").alias("datetime")
    ).agg(F.avg("pm25").alias("pm25"), F.count(F.lit(1)).alias("n"))


def resampled_window(readings: DataFrame, until: Column, window_hours: int = 24) -> DataFrame:
    """``hourly_resample`` of the hours that begin in the window that ends at ``until``.

    The bounds are on the readings' own time, so they reach the scan.
    """
    time, since = F.col("datetime"), until - F.expr(f"INTERVAL {window_hours} HOURS")
    near = readings.filter((time >= since) & (time < until + F.expr("INTERVAL 1 HOUR")))
    return hourly_resample(near).filter((time >= since) & (time <= until))


def latest_time(readings: DataFrame) -> DataFrame:
    return readings.agg(F.max("datetime").alias("latest"))


def settled(
    readings: DataFrame, now: Column, lag_hours: int = 24, window_hours: int | None = None
) -> DataFrame:
    """Only readings old enough that the source no longer revises them.

    With ``window_hours``, only those of the window that ends there.
    """
    until = now - F.expr(f"INTERVAL {lag_hours} HOURS")
    recent = readings.filter(F.col("datetime") <= until)
    if window_hours is None:
        return recent
    return recent.filter(F.col("datetime") >= until - F.expr(f"INTERVAL {window_hours} HOURS"))


def hourly_or_daily(
    hourly_readings: DataFrame,
    daily_readings: DataFrame,
    until: Column,
    window_hours: int = 24,
    fallback_days: int = 30,
) -> DataFrame:
    """Per sensor, the hourly readings of the window that ends at ``until``.

    A sensor without any gets its daily readings of the last ``fallback_days`` instead;
    ``interval_used`` says which.
    """
    since = until - F.expr(f"INTERVAL {window_hours} HOURS")
    fallback_since = until - F.expr(f"INTERVAL {fallback_days} DAYS")
    time = F.col("datetime")
    columns = ["sensor_id", "datetime", "pm25"]
    recent = hourly_readings.filter((time >= since) & (time <= until)).select(*columns)
    daily = daily_readings.filter((time >= fallback_since) & (time <= until)).select(*columns)
    return prefer_hourly(recent, daily)


def prefer_hourly(
    hourly_readings: DataFrame, daily_readings: DataFrame, covering: DataFrame | None = None
) -> DataFrame:
    """All hourly readings, plus the daily ones of sensors that have no hourly reading.

    ``covering`` holds the hourly readings to look for, if not the given ones.
    """
    covered = hourly_readings if covering is None else covering
    covered = covered.select("sensor_id").distinct()
    return hourly_readings.withColumn("interval_used", F.lit("hourly")).unionByName(
        daily_readings.join(covered, "sensor_id", "left_anti").withColumn(
            "interval_used", F.lit("daily")
        )
    )
