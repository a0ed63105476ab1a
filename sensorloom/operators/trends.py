"""Daily, weekday, weekly, monthly and yearly aggregates.

All group keys are calendar parts: partial aggregation leaves a handful of rows per task.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.operators.ranks import median_rank, values_at_rank
from sensorloom.session import stored


def daily_means(cleaned: DataFrame, *by: str) -> DataFrame:
    return cleaned.groupBy(*by, F.to_date("datetime").alias("date")).agg(
        F.avg("pm25").alias("pm25_avg"), F.count(F.lit(1)).alias("n")
    )


def daily_trend(cleaned: DataFrame) -> DataFrame:
    """Daily mean, count and the mean of the last seven daily means.

    The window has no partition key, but its input is one row per calendar day.
    """
    week = Window.orderBy("date").rowsBetween(-6, 0)
    return (
        daily_means(cleaned)
        .withColumn("pm25_avg_7d", F.avg("pm25_avg").over(week))
        .orderBy("date")
    )


def daily_trend_by_sensor(cleaned: DataFrame) -> DataFrame:
    """The same per sensor; a window partition holds the days of one sensor."""
    week = Window.partitionBy("sensor_id").orderBy("date").rowsBetween(-6, 0)
    return daily_means(cleaned, "sensor_id").withColumn(
        "pm25_avg_7d", F.avg("pm25_avg").over(week)
    )


def weekday_stats(cleaned: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Count, mean, median, minimum and maximum per weekday (Sunday is 1).

    By default the median is exact: the seven groups' other figures are fetched, and a few
    counting passes then narrow down the medians. With ``accuracy`` it is Spark's sketch in a
    lazy one-pass plan, which ships seven sketches per task to seven reducers: fine for
    moderate data, a bottleneck for very many tasks.
    """
    day = F.dayofweek("datetime")
    number = F.nanvl("pm25", F.lit(None).cast("double"))  # a NaN has no rank
    figures = cleaned.groupBy(day.alias("day_of_week")).agg(
        F.count(number).alias("n_values"),
        F.min(number).alias("lowest"),
        F.max(number).alias("highest"),
        F.count(F.lit(1)).alias("n"),
        F.avg("pm25").alias("pm25_avg"),
        *([F.percentile_approx("pm25", 0.5, accuracy).alias("pm25_median")] if accuracy else []),
        F.min("pm25").alias("pm25_min"),
        F.max("pm25").alias("pm25_max"),
    )
    if not accuracy:
        rows = figures.collect()  # one row per weekday
        sizes = {r.day_of_week: (r.n_values, r.lowest, r.highest) for r in rows if r.n_values}
        ranks = {day_: median_rank(n) for day_, (n, _, _) in sizes.items()}
        found = values_at_rank(cleaned, "pm25", ranks, day, sizes, bins=512)
        figures = cleaned.sparkSession.createDataFrame(
            [(*row, found.get(row.day_of_week)) for row in rows],
            figures.schema.add("pm25_median", "double"),
        )
    return figures.select(
        "day_of_week", "n", "pm25_avg", "pm25_median", "pm25_min", "pm25_max"
    ).orderBy("day_of_week")


def weekly_trend(cleaned: DataFrame, iso_year: bool = False) -> DataFrame:
    """Mean and count per calendar year and ISO week.

    With ``iso_year`` the year is the one the ISO week belongs to, so that the days around
    New Year stay together.
    """
    year = F.extract(F.lit("YEAROFWEEK"), F.col("datetime")) if iso_year else F.year("datetime")
    return (
        cleaned.groupBy(
            year.cast("int").alias("year"), F.weekofyear("datetime").alias("week_of_year")
        )
        .agg(F.avg("pm25").alias("pm25_avg"), F.count(F.lit(1)).alias("n"))
        .orderBy("year", "week_of_year")
    )


def distinct_years(daily: DataFrame) -> DataFrame:
    return daily.select(F.year("date").alias("year")).dropna().distinct().orderBy("year")


def in_year(daily: DataFrame, year: int | None = None) -> DataFrame:
    """Days of one year; the latest one by default, for which the days are computed once.

    The year is a range of dates, so that it reaches a scan of stored days or of their readings.
    """
    if year is None:
        daily = stored(daily, "days")
        year = daily.agg(F.max(F.year("date"))).first()[0]
    if year is None:
        return daily.limit(0)
    first, last = (F.lit(dt.date(int(year), *day)) for day in ((1, 1), (12, 31)))
    return daily.filter(F.col("date").between(first, last))


def monthly_means(daily: DataFrame) -> DataFrame:
    """Mean of the daily means per year and month."""
    return (
        daily.groupBy(F.year("date").alias("year"), F.month("date").alias("month"))
        .agg(F.avg("pm25_avg").alias("pm25_avg"))
        .orderBy("year", "month")
    )


def yearly_summary(daily: DataFrame) -> DataFrame:
    """Mean, largest and smallest daily mean per year."""
    return (
        daily.groupBy(F.year("date").alias("year"))
        .agg(
            F.avg("pm25_avg").alias("year_avg"),
            F.max("pm25_avg").alias("year_max"),
            F.min("pm25_avg").alias("year_min"),
        )
        .orderBy("year")
    )
