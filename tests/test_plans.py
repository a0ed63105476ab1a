"""Physical plans: pushdown, pruning, one shuffle where one is enough."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators import metrics as mt
from sensorloom.operators import trends as tr
from sensorloom.operators.split import time_split
from sensorloom.streaming import batches as bt

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def readings(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "hourly")
    cl.hourly(entry.series(spark, SF_DIR)).write.parquet(path)
    return spark.read.parquet(path)


def test_lags_need_one_shuffle_sort_and_window(readings):
    text = plan(ft.lag_features(readings))
    assert text.count("Exchange") == 1
    assert text.count("Sort [") == 1
    assert text.count("+- Window [") == 1


def test_time_range_reaches_the_scan(readings):
    text = plan(cl.in_time_range(readings, "2024-01-10", "2024-01-12").select("pm25"))
    assert "GreaterThanOrEqual(datetime" in text and "LessThanOrEqual(datetime" in text
    assert "ReadSchema: struct<datetime:timestamp,pm25:double>" in text


def test_time_range_reaches_the_scan_of_the_given_table(spark):
    text = plan(entry.time_range(spark, SF_DIR))
    assert "GreaterThanOrEqual(ts" in text and "LessThanOrEqual(ts" in text


def test_split_sides_are_pushed_filters(readings):
    split = time_split(readings, required=["sensor_id", "datetime"])
    assert "LessThan(datetime" in plan(split.train)
    assert "GreaterThanOrEqual(datetime" in plan(split.test)
    assert "Exchange" not in plan(split.train)


@pytest.mark.parametrize(
    "operator", [tr.daily_means, tr.weekly_trend, cl.hourly_resample, cl.dedup, cl.latest_time]
)
def test_aggregates_are_partial_before_the_shuffle(readings, operator):
    text = plan(operator(readings.select("sensor_id", "datetime", "pm25")))
    assert "partial_" in text.split("Exchange")[-1]


def test_trends_read_two_columns(readings):
    assert "ReadSchema: struct<datetime:timestamp,pm25:double>" in plan(tr.daily_means(readings))


def test_newest_rows_need_no_sort(readings):
    features = ft.lag_features(cl.dedup(readings.select("sensor_id", "datetime", "pm25")).transform(cl.hourly))
    versions = readings.select("sensor_id", "datetime", "pm25").withColumn(bt.VERSION, F.lit(1))
    for df in (
        cl.dedup(readings.select("sensor_id", "datetime", "pm25")),
        ft.latest_per_sensor(readings),
        ft.next_hour_features(ft.latest_per_sensor(features)),
        bt.newest(versions, ["sensor_id", "datetime"]),
    ):
        assert "SortAggregate" not in plan(df)


def test_two_column_dedup_is_hash_aggregates(readings):
    pulls = readings.select("sensor_id", "datetime", "pm25").withColumn("pull", F.lit(1))
    text = plan(cl.dedup(pulls, order_by=["pull"]))
    assert "SortAggregate" not in text and "HashAggregate" in text
    assert "partial_max" in text.split("Exchange")[-1]


def test_predictions_of_several_rules_are_one_scan(readings):
    features = ft.lag_features(readings)
    features.write.mode("overwrite").parquet(f"{readings.inputFiles()[0].rsplit('/', 1)[0]}-features")
    stored = readings.sparkSession.read.parquet(f"{readings.inputFiles()[0].rsplit('/', 1)[0]}-features")
    text = plan(mt.regression_metrics(entry.baseline_predictions(stored)))
    assert text.count("FileScan") == 1 and "ReadSchema: struct<sensor_id" not in text
    assert text.count("Window") == 0


def test_fallback_window_reaches_every_scan(spark):
    text = plan(entry.hourly_or_daily(spark, SF_DIR))
    assert text.count("FileScan") == text.count("GreaterThanOrEqual(ts") >= 2


def test_a_computed_input_of_lags_and_gaps_is_read_from_where_it_was_written(readings):
    for df in (ft.lag_features(cl.dedup(readings)), ft.gap_report(readings)):
        text = plan(df)
        assert "Aggregate" not in text and text.count("FileScan") == 1


def test_a_year_is_a_range_of_dates(readings):
    path = f"{readings.inputFiles()[0].rsplit('/', 1)[0]}-days"
    tr.daily_means(readings).write.mode("overwrite").parquet(path)
    days = readings.sparkSession.read.parquet(path)
    assert "GreaterThanOrEqual(date" in plan(tr.in_year(days, 2024))
    assert "GreaterThanOrEqual(date" in plan(tr.in_year(days))


def test_rank_passes_are_bounded_at_the_scan(readings, monkeypatch):
    """The passes that look for a cut skip what lies outside the span still open."""
    seen, collect = [], type(readings).collect
    monkeypatch.setattr(type(readings), "collect", lambda df: (seen.append(plan(df)), collect(df))[1])
    time_split(readings, required=["sensor_id", "datetime"])
    assert len(seen) >= 2 and all("GreaterThanOrEqual(datetime" in text for text in seen[1:])
