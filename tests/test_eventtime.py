"""Watermarks: bounded state, final windows, the cursor, readings that wait, unreadable documents."""

from __future__ import annotations

import datetime as dt
import json

import pandas as pd
import pytest

from helpers import READING, at, envelope, land, record, series_rows, tuples
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.plans import jobs
from sensorloom.streaming import batches as bt
from sensorloom.streaming import eventtime as et
from sensorloom.streaming import refresh as rf
from test_streaming import finish, landed_stream


def hour(day: float, value: float = 1.0, sensor: str = "a"):
    return (sensor, at("2024-01-01") + dt.timedelta(days=day), value)


def test_unique_readings_forget_old_keys(spark, tmp_path):
    """Copies within the allowance go; a row older than it is dropped and counted; state shrinks."""
    batches = [[hour(0), hour(1), hour(1)], [hour(1), hour(2), hour(20)], [hour(20), hour(21)], [hour(1.5), hour(21), hour(40)]]
    rows = et.unique_readings(landed_stream(spark, tmp_path / "in", batches), "3 days")
    query = bt.start(rows, bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp"), once=True)
    finish(query)
    got = bt.read_versions(spark, str(tmp_path / "out"), READING).drop(bt.VERSION)
    assert tuples(got) == sorted([hour(d) for d in (0, 1, 2, 20, 21, 40)], key=repr)
    log = et.CursorLog(spark, str(tmp_path / "cursor"))
    for progress in query.recentProgress:
        log.write(json.loads(progress.json))
    seen = {r.batch_id: r for r in et.read_cursor(spark, str(tmp_path / "cursor")).filter("n_rows > 0").collect()}
    assert [seen[i].n_late for i in sorted(seen)] == [0, 0, 0, 1]
    assert seen[2].watermark == at("2024-01-18") and seen[2].latest == at("2024-01-22")
    assert seen[3].n_state <= 3


def test_windows_come_once_and_final(spark, tmp_path):
    batches = [[hour(0, 1.0), hour(0.5, 3.0)], [hour(0.2, 5.0), hour(2)], [hour(6)], [hour(7)], [hour(7), hour(0.3, 100.0)]]
    windows = et.final_windows(landed_stream(spark, tmp_path / "in", batches), "1 day", "2 days")
    finish(bt.start(windows, bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp"), once=True))
    got = bt.read_versions(spark, str(tmp_path / "out"), f"{READING}, n long").drop(bt.VERSION)
    assert tuples(got) == [("a", at("2024-01-01"), 3.0, 3), ("a", at("2024-01-03"), 1.0, 1)]


def test_listener_writes_the_cursor_while_the_stream_runs(spark, tmp_path):
    log = et.CursorLog(spark, str(tmp_path / "cursor"))
    spark.streams.addListener(log)
    try:
        rows = et.unique_readings(landed_stream(spark, tmp_path / "in", [[hour(0)], [hour(1)]]), "1 day")
        finish(bt.start(rows, bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp"), once=True))
        deadline = dt.datetime.now() + dt.timedelta(seconds=30)
        while not (tmp_path / "cursor").exists() or len(list((tmp_path / "cursor").glob("[!.]*.json"))) < 2:
            assert dt.datetime.now() < deadline
    finally:
        spark.streams.removeListener(log)
    assert et.read_cursor(spark, str(tmp_path / "cursor")).filter("n_rows = 1").count() == 2


@pytest.fixture
def rocksdb(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, et.ROCKSDB)
    yield
    spark.conf.set(key, before)


def test_lags_from_state(spark, tmp_path, rocksdb):
    """In order: the rows of the batch operator. A late reading comes out marked, and changes nothing."""
    rows = sorted(series_rows("a", 60) + series_rows("b", 45), key=lambda r: r[1])
    late = ("a", at("2024-01-01T03:00:00"), 99.0)
    stream = landed_stream(spark, tmp_path / "in", [rows[:40], rows[40:80], [*rows[80:], late]])
    finish(bt.start(et.lags_in_state(stream, "30 days"), bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp"), once=True))
    fields = ", ".join(f"{c} double" for c in et.LAG_COLUMNS)
    lagged = bt.read_versions(spark, str(tmp_path / "out"), f"{READING}, late boolean, {fields}")
    want = tuples(ft.lag_features(cl.hourly(spark.createDataFrame(rows, READING))))
    assert tuples(et.state_features(lagged)) == want
    assert tuples(lagged.filter("late").select("sensor_id", "datetime", "pm25")) == [late]


def state_lags(spark, path, batches, allowance="30 days", **options):
    """The rows that ``lags_in_state`` gives, and the progress of its batches."""
    stream = landed_stream(spark, path / "in", batches)
    query = bt.start(et.lags_in_state(stream, allowance, **options), bt.versioned_sink(str(path / "out")), str(path / "cp"), once=True)
    finish(query)
    fields = ", ".join(f"{c} double" for c in et.LAG_COLUMNS)
    return bt.read_versions(spark, str(path / "out"), f"{READING}, late boolean, {fields}"), query.recentProgress


def test_state_calls_do_not_grow_with_the_sensors(spark, tmp_path, rocksdb):
    """A thousand sensors are some hundred calls, each with at most one timer; none loses its lags."""
    batches = [[hour(d, float(i), f"s{i}") for i in range(1000)] for d in (0, 1)]
    rows, progress = state_lags(spark, tmp_path, batches)
    assert 0 < sum(o.customMetrics["numRegisteredTimers"] for p in progress for o in p.stateOperators) <= et.SENSOR_GROUPS
    assert rows.filter("datetime > '2024-01-01T12:00:00' AND lag_1 = pm25 AND lag_2 IS NULL").count() == 1000


def test_sensors_that_share_a_group_keep_apart(spark, tmp_path, rocksdb):
    """Each sensor has its own tail, its own late rows, and is forgotten by its own silence."""
    first = series_rows("a", 30) + series_rows("b", 30) + [hour(0, 5.0, None), hour(0, 6.0, "")]
    batches = [
        first,
        [hour(40, 41.0), hour(0.1, 9.0), hour(40, 7.0, None), hour(40, 8.0, "")],
        [hour(70, 1.0, "clock")],
        [hour(71, 1.0, "clock")],
        [hour(72, 73.0), hour(72, 2.0, "b"), hour(72, 3.0, "b"), hour(72, 4.0, None)],
    ]
    rows, _ = state_lags(spark, tmp_path, batches, "60 days", groups=1)
    assert rows.filter("late").select("sensor_id", "pm25").collect() == [("a", 9.0)]
    later = {(r.sensor_id, r.datetime.month, r.datetime.day): r for r in rows.filter("NOT late AND datetime > '2024-02-01'").collect()}
    assert [later["a", 2, 10][f"lag_{i}"] for i in (1, 2, 24)] == [30.0, 29.0, 7.0]
    assert [later["a", 3, 13][f"lag_{i}"] for i in (1, 2, 24)] == [41.0, 30.0, 8.0]
    assert [later[None, 3, 13][f"lag_{i}"] for i in (1, 2, 3)] == [7.0, 5.0, None]
    assert [later["", 2, 10][f"lag_{i}"] for i in (1, 2)] == [6.0, None]
    assert [later["b", 3, 13][c] for c in ("pm25", "lag_1", "lag_24")] == [3.0, 30.0, 7.0]


def test_a_silent_sensor_of_a_group_is_forgotten(spark, tmp_path, rocksdb):
    batches = [
        series_rows("a", 30) + series_rows("b", 30),
        [hour(40, 41.0)],
        [hour(70, 1.0, "clock")],
        [hour(71, 1.0, "clock")],  # the watermark has come to day 68, that is 60 days after b's last
        [hour(72, 73.0), hour(72, 2.0, "b")],
        [hour(110, 1.0, "clock")],
        [hour(111, 1.0, "clock")],  # the group's next timer: a and b were last seen at day 72, and stay
        [hour(112, 74.0), hour(112, 3.0, "b")],
    ]
    rows, _ = state_lags(spark, tmp_path, batches, "2 days", groups=1)
    got = {(r.sensor_id, r.pm25): (r.lag_1, r.lag_2) for r in rows.filter("datetime > '2024-03-01'").collect()}
    assert got["a", 73.0] == (41.0, 30.0) and got["b", 2.0] == (None, None)
    assert got["a", 74.0] == (73.0, 41.0) and got["b", 3.0] == (2.0, None)


class FakeState(dict):
    """State and timers of one group, counting what is asked of them."""

    def __init__(self):
        self.calls, self.timers = 0, set()
        self.listTimers, self.deleteTimer, self.registerTimer = lambda: iter(sorted(self.timers)), self.timers.remove, self.timers.add

    def getMapState(self, *schema):
        return self

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value


def test_lags_of_a_group_come_in_parts(monkeypatch):
    """Input of several frames; output of bounded frames; state is asked for each entry, not each sensor."""
    monkeypatch.setattr(et, "ROWS_OUT", 100)
    rows = pd.DataFrame([r for i in range(400) for r in series_rows(f"s{i}", 5)], columns=["sensor_id", "datetime", "pm25"])
    state, processor = FakeState(), et.LastReadings()
    processor.init(state)
    out = list(processor.handleInputRows((0,), iter([rows[:900], rows[900:]]), None))
    assert max(map(len, out)) == 100 and state.calls <= 2 * et.GROUP_ENTRIES and len(state.timers) == 1
    made = pd.concat(out).sort_values(["sensor_id", "datetime"])
    assert len(made) == 2000 and made["pm25"].tolist() == [1.0, 2.0, 3.0, 4.0, 5.0] * 400
    assert made["lag_2"].fillna(0).tolist() == [0.0, 0.0, 1.0, 2.0, 3.0] * 400
    late = list(processor.handleInputRows((0,), iter([rows]), None))
    assert sum(map(len, late)) == 2000 and all(f["late"].all() and f["lag_1"].isna().all() for f in late)
    with pytest.raises(ValueError, match="without a time"):
        list(processor.handleInputRows((0,), iter([rows.assign(datetime=pd.NaT)]), None))


def test_new_readings_wait_until_they_are_settled(spark, tmp_path):
    root = str(tmp_path / "t")
    handle = rf.refresh_tables(root, lag_hours=24, clock=rf.event_clock)
    rows = series_rows("a", 24 * 4)
    handle(spark.createDataFrame(rows[:60], READING), 0)
    assert rf.current_readings(spark, root).count() == 36
    handle(spark.createDataFrame([], READING), 1)
    handle(spark.createDataFrame([*rows[55:], rows[3]], READING), 2)
    handle(spark.createDataFrame([*rows[55:], rows[3]], READING), 2)
    assert tuples(rf.current_readings(spark, root).drop("interval_used")) == sorted(rows[:72], key=repr)
    assert tuples(rf.cursor(spark, root)) == [
        (0, 60, 36, 24, rows[59][1], rows[59][1] + dt.timedelta(seconds=1)),
        (2, 42, 37, 24, rows[95][1], rows[95][1] + dt.timedelta(seconds=1)),
    ]
    settled = cl.settled(spark.createDataFrame(rows, READING), ft.F.lit(rows[95][1]), 24)
    assert tuples(rf.current_features(spark, root).drop("interval_used")) == tuples(ft.lag_features(cl.hourly(settled)))


def test_all_wait(spark, tmp_path):
    root = str(tmp_path / "t")
    handle = rf.refresh_tables(root, lag_hours=24, clock=rf.event_clock)
    handle(spark.createDataFrame(series_rows("a", 5), READING), 0)
    assert rf.current_readings(spark, root).isEmpty()
    handle(spark.createDataFrame([hour(10)], READING), 1)
    assert rf.current_readings(spark, root).count() == 5


def test_stream_keeps_unreadable_documents(spark, tmp_path):
    """The same landing folder gives batch and stream the same account."""
    landing, root = tmp_path / "raw", str(tmp_path / "tables")
    good = envelope(7, [record(1.0, "2024-01-01T00:00:00Z")])
    land(landing, "sensor_7_hourly_20240101_000000.json", good)
    land(landing, "sensor_8_hourly_20240101_000000.json", '{"sensor_id": 8, "results": [')
    finish(rf.start_landing_refresh(spark, str(landing), root, once=True))
    counts = jobs.etl(spark, str(landing), f"{root}-batch")
    assert counts["unreadable"] == 1
    land(landing, "sensor_9_hourly_20240102_000000.json", "no json")
    finish(rf.start_landing_refresh(spark, str(landing), root, once=True))
    bad = rf.unreadable(spark, root)
    assert sorted(r.file_name for r in bad.collect()) == [f"sensor_{i}_hourly_2024010{i - 7}_000000.json" for i in (8, 9)]
    jobs.etl(spark, str(landing), f"{root}-batch")
    assert tuples(spark.read.parquet(f"{root}-batch/unreadable"), "file_name", "_corrupt") == tuples(bad, "file_name", "_corrupt")


def test_scheduled_trigger_runs(spark, tmp_path):
    """The polling form: batches go on until the query is stopped."""
    stream = landed_stream(spark, tmp_path / "in", [[hour(0)], [hour(1)]])
    query = bt.start(stream, bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp"), every="1 second")
    try:
        deadline = dt.datetime.now() + dt.timedelta(seconds=60)
        while bt.versions(spark, str(tmp_path / "out")) != [0, 1]:
            assert dt.datetime.now() < deadline and query.exception() is None
    finally:
        query.stop()
    assert bt.read_versions(spark, str(tmp_path / "out"), READING).count() == 2
