"""Row-based windows, cut and uncut, against plain Python (fixtures E9, E10, E14)."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from helpers import READING, at, series_rows, tuples
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators.series import _cut


def lags_by_hand(rows, lags=24):
    """Expected (sensor, time, value, lags...) of a list of readings."""
    result = []
    for sensor in {r[0] for r in rows}:
        own = sorted(r for r in rows if r[0] == sensor)
        for i in range(lags, len(own)):
            result.append((*own[i], *[own[i - k][2] for k in range(1, lags + 1)]))
    return sorted(result, key=repr)


def test_short_series(spark):
    rows = [r for n in (24, 25, 26) for r in series_rows(f"s{n}", n)]
    features = ft.lag_features(cl.hourly(spark.createDataFrame(rows, READING)))
    counts = {r.sensor_id: r["count"] for r in features.groupBy("sensor_id").count().collect()}
    assert counts == {"s25": 1, "s26": 2}


def skewed_rows(seed: int):
    """One sensor with most rows, half of them in one burst, and long silences."""
    rng = random.Random(seed)
    start, rows = at("2024-01-01"), set()
    for _ in range(300):
        rows.add(("hot", start + dt.timedelta(hours=rng.randrange(5000))))
        rows.add(("hot", start + dt.timedelta(hours=100, microseconds=rng.randrange(5000))))
    for i in range(40):
        rows.add((f"cold{i % 4}", start + dt.timedelta(hours=rng.randrange(900))))
        rows.add(("sparse", start + dt.timedelta(days=i * i)))
    return [(s, t, rng.random()) for s, t in sorted(rows)]


@pytest.mark.parametrize("lags, rows_per_task", [(3, 1), (24, 7), (1, 50), (24, 50), (24, 10_000)])
def test_cut_series_give_the_same_lags(spark, lags, rows_per_task):
    rows = skewed_rows(lags)
    readings = cl.hourly(spark.createDataFrame(rows, READING))
    features = ft.lag_features(readings, lags, rows_per_task)
    names = [f"lag_{i}" for i in range(1, lags + 1)]
    assert tuples(features, "sensor_id", "datetime", "pm25", *names) == lags_by_hand(rows, lags)
    assert features.filter("hour IS NULL").isEmpty()


def test_slices_are_bounded_also_in_a_burst(spark):
    df = spark.createDataFrame(skewed_rows(5), READING)
    sliced, cut = _cut(df, "sensor_id", "datetime", 50)
    assert cut
    sizes = sliced.groupBy("sensor_id", "_slice").count().collect()
    assert max(r["count"] for r in sizes) <= 50
    whole = {r.sensor_id for r in sizes if r._slice is None}
    assert whole == {"sparse", "cold0", "cold1", "cold2", "cold3"}
    assert not _cut(df, "sensor_id", "datetime", 10_000)[1]


def test_every_long_series_is_cut(spark):
    rows = series_rows("a", 100) + series_rows("b", 100) + series_rows("c", 500)
    readings = cl.hourly(spark.createDataFrame(rows, READING))
    features = ft.lag_features(readings, rows_per_task=30)
    names = [f"lag_{i}" for i in range(1, 25)]
    assert tuples(features, "sensor_id", "datetime", "pm25", *names) == lags_by_hand(rows)
    sliced, _ = _cut(readings, "sensor_id", "datetime", 30)
    assert max(r["count"] for r in sliced.groupBy("sensor_id", "_slice").count().collect()) <= 30


@pytest.mark.parametrize("rows_per_task", [1, 10_000])
def test_rows_without_a_time_feed_no_lag(spark, rows_per_task):
    rows = series_rows("a", 40) + [("a", None, 999.0), ("b", None, 1.0)]
    features = ft.lag_features(cl.hourly(spark.createDataFrame(rows, READING)), 3, rows_per_task)
    names = [f"lag_{i}" for i in range(1, 4)]
    assert tuples(features, "sensor_id", "datetime", "pm25", *names) == lags_by_hand(rows[:40], 3)


@pytest.mark.parametrize("rows_per_task", [1, 10_000])
def test_gaps(spark, rows_per_task):
    days = ["2024-01-01", "2024-01-02", "2024-01-10"]
    df = spark.createDataFrame([("s", at(d), 1.0) for d in days], READING)
    report = ft.gap_report(df, min_hours=24, rows_per_task=rows_per_task)
    assert tuples(report, "datetime", "previous", "gap_hours") == [
        (at("2024-01-10"), at("2024-01-02"), 192.0)
    ]


def test_lag_by_time_is_null_across_gaps(spark):
    times = ["2024-01-01T00:00:00", "2024-01-01T01:00:00", "2024-01-01T03:00:00", "2024-01-02T01:00:00"]
    df = spark.createDataFrame([("s", at(t), float(i)) for i, t in enumerate(times)], READING)
    assert tuples(ft.lag_by_time(df), "pm25", "pm25_1h_ago", "pm25_24h_ago") == [
        (0.0, None, None), (1.0, 0.0, None), (2.0, None, None), (3.0, None, 1.0)]


def test_next_hour_over_new_year(spark):
    rows = series_rows("s", 26, "2024-12-30T22:30:00")
    features = ft.lag_features(cl.hourly(spark.createDataFrame(rows, READING)))
    latest = ft.latest_per_sensor(features)
    assert latest.first().datetime == at("2024-12-31T23:30:00")
    coming = ft.next_hour_features(latest).first()
    assert (coming.hour, coming.month, coming.day_of_week) == (0, 1, 4)
    assert coming.datetime == at("2025-01-01T00:30:00")
    assert (coming.lag_1, coming.lag_2, coming.lag_24) == (26.0, 25.0, 3.0)


def test_latest_row_breaks_ties(spark):
    df = spark.createDataFrame(
        [("a", at("2024-01-02"), 1.0), ("b", at("2024-01-02"), 2.0), ("a", at("2024-01-01"), 9.0)],
        READING,
    )
    assert tuple(ft.latest_row(df).first()) == ("b", at("2024-01-02"), 2.0)
    assert tuples(ft.latest_per_sensor(df)) == [
        ("a", at("2024-01-02"), 1.0),
        ("b", at("2024-01-02"), 2.0),
    ]
