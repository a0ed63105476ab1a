"""Quality filter, selections, de-duplication, fallback (fixtures E1, E8, E17)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import READING, at, series_rows, tuples
from sensorloom.functions import utc_iso, utc_iso_text, weekday_label, year_week_label
from sensorloom.operators import clean as cl
from sensorloom.operators import trends as tr

T = at("2024-01-01T01:00:00")


def test_quality_filter(spark):
    values = [1.5, 0.0, -1.0, -999.0, float("nan"), None]
    rows = [("s", T, v, "pm25") for v in values] + [("s", T, 9.0, "no2")]
    schema = "sensor_id string, datetime timestamp, pm25 double, parameter string"
    readings = spark.createDataFrame(rows, schema)
    assert tuples(cl.clean(readings)) == [("s", T, 1.5)]
    assert tuples(cl.clean(readings, "no2")) == [("s", T, 9.0)]


def test_dedup_keeps_one_row_and_the_last_pull(spark):
    df = spark.createDataFrame([("s", T, 1.0), ("s", T, 1.0), ("s", T, 2.0)], READING)
    assert tuples(cl.dedup(df)) == [("s", T, 2.0)]
    pulled = spark.createDataFrame([("s", T, 5.0, 1), ("s", T, 2.0, 2)], READING + ", pull int")
    assert tuples(cl.dedup(pulled, ["pull"])) == [("s", T, 2.0, 2)]


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.createDataFrame([("s", T, 1.0)], READING)
    plan = cl.dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning")
    assert "SortAggregate" not in plan


def test_sensor_setting():
    assert cl.sensor_ids(" 1, 7,,12 ") == ["1", "7", "12"]
    with pytest.raises(ValueError):
        cl.sensor_ids(" , ")
    assert cl.sensor_ids([3, " 4 "]) == ["3", "4"]


def test_open_time_ranges(spark):
    df = spark.createDataFrame(series_rows("s", 4), READING)
    assert cl.in_time_range(df).count() == 4
    assert cl.in_time_range(df, start="2024-01-01 01:00:00").count() == 3
    assert cl.in_time_range(df, end="2024-01-01 01:00:00").count() == 2
    now = F.lit(at("2024-01-02T02:00:00"))
    assert cl.settled(df, now, 24).count() == 3
    assert cl.settled(df, now, 24, window_hours=1).count() == 2


def test_fallback_to_daily(spark):
    until = F.lit(at("2024-01-10T12:00:00"))
    hourly = [("a", at("2024-01-10T10:00:00"), 1.0), ("b", at("2024-01-01T10:00:00"), 2.0)]
    daily = [
        ("a", at("2024-01-10T00:00:00"), 3.0),
        ("b", at("2024-01-09T00:00:00"), 4.0),
        ("b", at("2023-11-01T00:00:00"), 5.0),
    ]
    got = cl.hourly_or_daily(
        spark.createDataFrame(hourly, READING), spark.createDataFrame(daily, READING), until
    )
    assert tuples(got, "sensor_id", "pm25", "interval_used") == [
        ("a", 1.0, "hourly"),
        ("b", 4.0, "daily"),
    ]


def test_labels_and_iso_text(spark):
    row = spark.range(1).select(
        weekday_label(F.dayofweek(F.lit("2024-01-07").cast("date"))).alias("sun"),
        weekday_label(F.lit(7)).alias("sat"),
        weekday_label(F.lit(9)).alias("other"),
        year_week_label(F.lit(2024), F.lit(3)).alias("week"),
        year_week_label(F.lit(None).cast("int"), F.lit(3)).alias("none"),
        utc_iso(F.lit("2024-01-13 00:00:00.123456").cast("timestamp")).alias("iso"),
        utc_iso_text(F.lit("2024-01-01")).alias("plain"),
        utc_iso_text(F.lit("2024-01-01Z")).alias("marked"),
    ).first()
    assert tuple(row) == (
        "Sun",
        "Sat",
        "9",
        "2024-03",
        None,
        "2024-01-13T00:00:00Z",
        "2024-01-01Z",
        "2024-01-01Z",
    )


def test_moving_average_counts_rows_not_days(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-10"]
    df = spark.createDataFrame([("s", at(d), float(i)) for i, d in enumerate(days, 1)], READING)
    assert [r.pm25_avg_7d for r in tr.daily_trend(df).collect()] == [1.0, 1.5, 2.0]
    assert [r.n for r in tr.daily_trend(df).collect()] == [1, 1, 1]


def test_iso_week_at_new_year(spark):
    df = spark.createDataFrame(
        [("s", at("2023-01-01"), 1.0), ("s", at("2024-12-30"), 2.0)], READING
    )
    assert tuples(tr.weekly_trend(df), "year", "week_of_year") == [(2023, 52), (2024, 1)]
    iso = tr.weekly_trend(df, iso_year=True)
    assert tuples(iso, "year", "week_of_year") == [(2022, 52), (2025, 1)]


def test_yearly_views(spark):
    df = spark.createDataFrame(
        [("s", at("2023-05-01"), 1.0), ("s", at("2024-05-01"), 2.0), ("s", at("2024-05-02"), 4.0)],
        READING,
    )
    daily = tr.daily_means(df)
    assert tuples(tr.distinct_years(daily)) == [(2023,), (2024,)]
    assert tuples(tr.monthly_means(tr.in_year(daily))) == [(2024, 5, 3.0)]
    assert tuples(tr.monthly_means(tr.in_year(daily, 2023))) == [(2023, 5, 1.0)]
    assert tuples(tr.yearly_summary(daily)) == [(2023, 1.0, 1.0, 1.0), (2024, 3.0, 4.0, 2.0)]


def test_weekday_median_exact_and_sketched(spark):
    rows = [("s", at(f"2024-01-07T{h:02d}:00:00"), v) for h, v in enumerate([5.0, 1.0, 9.0, 3.0])]
    rows += [("s", at("2024-01-08T00:00:00"), 7.0)]
    df = spark.createDataFrame(rows, READING)
    want = [(1, 4, 4.5, 3.0, 1.0, 9.0), (2, 1, 7.0, 7.0, 7.0, 7.0)]
    assert tuples(tr.weekday_stats(df)) == want
    assert tuples(tr.weekday_stats(df, accuracy=10_000)) == want
