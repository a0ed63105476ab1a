"""Streams give what the batch operators give, also when batches are late or replayed."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from helpers import READING, at, envelope, hours, land, record, series_rows, tuples
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.plans import jobs
from sensorloom.plans import models as ml
from sensorloom.streaming import aggregates as ag
from sensorloom.streaming import batches as bt
from sensorloom.streaming import refresh as rf


def finish(query) -> None:
    assert query.awaitTermination(300)


def landed_stream(spark, path, batches):
    """One file and one micro-batch per list of readings."""
    for i, rows in enumerate(batches):
        frame = spark.createDataFrame(rows, READING).coalesce(1)
        frame.write.mode("append").parquet(f"{path}/part={i}")
    return (
        spark.readStream.schema(f"{READING}, part int").option("maxFilesPerTrigger", 1)
        .parquet(str(path)).drop("part")
    )


def batch_features(spark, rows, **options):
    distinct = {(s, t): v for s, t, v in rows}
    frame = spark.createDataFrame([(s, t, v) for (s, t), v in distinct.items()], READING)
    return tuples(ft.lag_features(cl.hourly(frame), **options))


@pytest.mark.parametrize("rows_per_task", [20, 10_000])
def test_refresh_in_order(spark, tmp_path, rows_per_task):
    rows = series_rows("a", 70) + series_rows("b", 40, "2024-01-01T12:00:00")
    rows.sort(key=lambda r: r[1])
    handle = rf.refresh_tables(str(tmp_path / "t"), rows_per_task=rows_per_task)
    for i in range(3):
        part = rows[i * 37 : (i + 1) * 37]
        handle(spark.createDataFrame(part, READING), i)
    assert tuples(rf.current_features(spark, str(tmp_path / "t")).drop("interval_used")) == batch_features(spark, rows)
    assert bt.versions(spark, str(tmp_path / "t"), "carry") == [2]


def test_refresh_with_late_repeated_and_replayed_batches(spark, tmp_path):
    root, rng = str(tmp_path / "t"), random.Random(4)
    rows = series_rows("a", 60) + series_rows("b", 50) + series_rows("c", 10)
    rng.shuffle(rows)
    batches = [rows[:50], rows[50:51], rows[51:], [("a", at("2024-01-01T05:00:00"), 777.0)]]
    handle = rf.refresh_tables(root)
    for i, part in enumerate(batches):
        handle(spark.createDataFrame(part, READING), i)
        if i == 2:  # the same batch again, as after a failure
            handle(spark.createDataFrame(part, READING), i)
    want = batch_features(spark, [r for part in batches for r in part])
    assert tuples(rf.current_features(spark, root).drop("interval_used")) == want
    assert rf.current_readings(spark, root).count() == 120


def test_late_readings_of_a_sparse_sensor_use_its_whole_history(spark, tmp_path):
    root, handle = str(tmp_path / "t"), rf.refresh_tables(str(tmp_path / "t"))
    dense = series_rows("dense", 400)
    sparse = series_rows("sparse", 60, step_hours=24)
    batches = [dense[:390] + sparse[:50], [dense[380], sparse[45]], dense[390:] + sparse[50:]]
    for i, part in enumerate(batches):
        handle(spark.createDataFrame([(s, t, v + i) for s, t, v in part], READING), i)
    rows = [(s, t, v + i) for i, part in enumerate(batches) for s, t, v in part]
    assert tuples(rf.current_features(spark, root).drop("interval_used")) == batch_features(spark, rows)


def test_refresh_skips_batches_without_readings(spark, tmp_path):
    root = str(tmp_path / "t")
    handle = rf.refresh_tables(root)
    handle(spark.createDataFrame(series_rows("a", 20), READING), 0)
    handle(spark.createDataFrame([], READING), 1)
    handle(spark.createDataFrame(series_rows("a", 10, "2024-01-01T20:00:00"), READING), 2)
    assert rf.current_features(spark, root).count() == 6


def test_landing_to_tables_and_predictions(spark, tmp_path):
    landing, root = tmp_path / "raw", str(tmp_path / "tables")
    times = [f"{t.isoformat()}Z" for t in hours("2024-01-01", 40)]
    model = ml.fit(
        ft.lag_features(cl.hourly(spark.createDataFrame(series_rows("x", 60), READING))), "lr"
    )
    for i, part in enumerate([times[:30], times[30:]]):
        results = [record(float(k + 1), t) for k, t in enumerate(part)]
        land(landing, f"sensor_7_hourly_2024010{i + 1}_000000.json", envelope(7, results))
        finish(
            rf.start_landing_refresh(spark, str(landing), root, once=True, model=model)
        )
    assert rf.current_features(spark, root).count() == 16
    assert rf.current_predictions(spark, root).count() == 16


@pytest.mark.parametrize("fallback, sensors", [(True, {"1", "2"}), (False, {"1"})])
def test_daily_documents_stand_in_for_missing_hourly_ones(spark, tmp_path, fallback, sensors):
    landing, root = tmp_path / "raw", str(tmp_path / "tables")
    page = {"results": [record(1.0, "2024-01-01T00:00:00Z")]}
    land(landing, "pm25_sensor_1_hourly_20240101_000000.json", page)
    daily = {"results": [record(9.0, "2024-01-02T00:00:00Z")]}
    land(landing, "pm25_sensor_1_daily_20240101_000000.json", daily)
    land(landing, "pm25_sensor_2_daily_20240101_000000.json", page)
    finish(rf.start_landing_refresh(spark, str(landing), root, once=True, fallback=fallback))
    readings = rf.current_readings(spark, root)
    assert {r.sensor_id for r in readings.collect()} == sensors
    assert readings.filter("pm25 = 9").isEmpty()


def test_hourly_and_daily_windows(spark, tmp_path):
    rows = [("a", at("2024-01-01") + dt.timedelta(minutes=17 * i), float(i)) for i in range(200)]
    stream = landed_stream(spark, tmp_path / "in", [rows[:90], rows[90:150], rows[150:]])
    for interval, part in (("1 hour", "hour"), ("1 day", "day")):
        root = str(tmp_path / part)
        sink = bt.versioned_sink(f"{root}/out", partial=lambda b: ag.window_partials(b, interval))
        finish(bt.start(stream, sink, f"{root}/cp", once=True))
        written = bt.read_versions(spark, f"{root}/out", ag.PARTIAL_MEANS)
        got = tuples(ag.windowed_means(written).selectExpr(
            "sensor_id", "datetime", "round(pm25, 6)", "n"))
        frame = spark.createDataFrame(rows, READING)
        want = tuples(frame.groupBy("sensor_id", ft.F.date_trunc(part, "datetime")).agg(
            ft.F.round(ft.F.avg("pm25"), 6), ft.F.count("pm25")))
        assert got == want


def test_stream_dedup_across_batches(spark, tmp_path):
    rows = series_rows("a", 30)
    revised = [(s, t, v + 0.5) for s, t, v in rows[10:]]
    stream = landed_stream(spark, tmp_path / "in", [rows, rows[5:], revised])
    sink = bt.versioned_sink(str(tmp_path / "out"), partial=ag.distinct_readings)
    finish(bt.start(stream, sink, str(tmp_path / "cp"), once=True))
    got = ag.distinct_readings(bt.read_versions(spark, str(tmp_path / "out"), READING))
    assert tuples(got) == sorted(rows[:10] + revised, key=repr)


def test_pre_aggregation_before_the_state(spark):
    readings = spark.createDataFrame(series_rows("a", 3), READING)
    for df, partial in (
        (ag.distinct_readings(readings), "partial_max"),
        (ag.window_partials(readings), "partial_sum"),
    ):
        assert partial in df._jdf.queryExecution().executedPlan().toString().split("Exchange")[-1]


def test_empty_batches_are_skipped_unless_wanted(spark, tmp_path):
    empty = spark.createDataFrame([], READING)
    bt.versioned_sink(str(tmp_path / "a"))(empty, 0)
    assert bt.versions(spark, str(tmp_path / "a")) == []
    bt.versioned_sink(str(tmp_path / "b"), save_empty=True)(empty, 0)
    assert bt.versions(spark, str(tmp_path / "b")) == [0]


def limited(spark, path, rows, limit):
    """Rows as seven files out of time order, so many of them in a batch."""
    rng = random.Random(9)
    rows = list(rows)
    rng.shuffle(rows)
    for i in range(7):
        spark.createDataFrame(rows[i::7], READING).coalesce(1).write.mode("append").parquet(path)
    reader = spark.readStream.schema(READING)
    return (reader.option("maxFilesPerTrigger", limit) if limit else reader).parquet(path)


@pytest.mark.parametrize("limit", [1, 2, None])
def test_windows_and_copies_do_not_depend_on_batches(spark, tmp_path, limit):
    rows = [("a", at("2024-01-01") + dt.timedelta(hours=5 * i), float(i)) for i in range(60)]
    rows += rows[::3]
    faulty = [(s, t, float("nan")) for s, t, _ in rows[::4]]
    for name, partial, combine, schema in (
        ("means", lambda b: ag.window_partials(b, "1 day"), ag.windowed_means, ag.PARTIAL_MEANS),
        ("copies", ag.distinct_readings, ag.distinct_readings, READING),
    ):
        if name == "copies":
            rows += faulty
        stream = limited(spark, str(tmp_path / f"{name}-in"), rows, limit)
        sink = bt.versioned_sink(str(tmp_path / name), partial=partial)
        finish(bt.start(stream, sink, str(tmp_path / f"{name}-cp"), once=True))
        got = combine(bt.read_versions(spark, str(tmp_path / name), schema))
        want = combine(partial(spark.createDataFrame(rows, READING)))
        assert tuples(got) == tuples(want)
        if name == "copies":
            assert got.filter("isnan(pm25)").isEmpty() and got.count() == 60


@pytest.mark.parametrize("limit", [1, 2, None])
def test_fallback_does_not_depend_on_batches(spark, tmp_path, limit):
    landing, root = tmp_path / "raw", str(tmp_path / "tables")
    times = [f"{t.isoformat()}Z" for t in hours("2024-01-01", 40)]
    # Sensor 1 has daily readings, and hourly ones that land last; sensor 2 has daily ones only.
    for i, (sensor, interval, some) in enumerate(
        [(1, "daily", times[:30]), (2, "daily", times[:28]), (2, "daily", times[28:33]), (1, "hourly", times[5:35])]
    ):
        page = {"results": [record(float(k + i), t) for k, t in enumerate(some)]}
        land(landing, f"pm25_sensor_{sensor}_{interval}_2024010{i + 1}_000000.json", page)
    finish(
        rf.start_landing_refresh(spark, str(landing), root, once=True, max_files_per_trigger=limit)
    )
    readings = rf.current_readings(spark, root)
    assert tuples(readings.groupBy("sensor_id", "interval_used").count()) == [
        ("1", "hourly", 30), ("2", "daily", 33)]
    assert tuples(rf.current_features(spark, root).groupBy("sensor_id", "interval_used").count()) == [
        ("1", "hourly", 6), ("2", "daily", 9)]
    counts = jobs.etl(spark, str(landing), f"{root}-batch")
    assert counts["clean"] == 63
    assert tuples(spark.read.parquet(f"{root}-batch/pm25_clean")) == tuples(readings)
