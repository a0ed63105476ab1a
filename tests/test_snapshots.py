"""Versioned tables: commits, replays, compaction, retention, folders that are pruned."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import READING, at, series_rows, tuples
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.session import scratch_dir, scratch_scope, stored
from sensorloom.sources.snapshots import Manifest, Snapshots, folder_batch, folder_level
from sensorloom.sources.tables import child_names, path_exists
from sensorloom.streaming import batches as bt
from sensorloom.streaming import refresh as rf


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def numbers(spark, start, end):
    return spark.range(start, end, numPartitions=1).selectExpr("id", "id * 2 AS twice")


SUMS = "id long, twice long"


def test_a_hundred_batches_stay_few_folders(spark, tmp_path):
    """Equal rows before, during and after every compaction; folders and manifests bounded."""
    root, fan = str(tmp_path / "t"), 4
    tables, keys, most = Snapshots(spark, root, fan), 13, 0
    handle = bt.versioned_sink(root, merge=lambda df: bt.newest(df, ["id"]), fan=fan)
    for i in range(100):
        handle(spark.range(i % keys, i % keys + 2, numPartitions=1).selectExpr("id", f"id * 1000 + {i} AS twice"), i)
        most = max(most, len(tables.current().tables[bt.ROWS]))
    assert most <= fan * 4
    want = {}
    for i in range(100):
        for key in (i % keys, i % keys + 1):
            want[key] = key * 1000 + i
    assert dict(tuples(bt.newest(bt.read_versions(spark, root, SUMS), ["id"]))) == want
    assert len(child_names(spark, f"{root}/{bt.ROWS}")) <= most + 2 * fan
    assert len(child_names(spark, f"{root}/_manifests")) <= 4 * tables.keep
    levels = [folder_level(f) for f in tables.current().tables[bt.ROWS]]
    assert levels == sorted(levels, reverse=True) and levels[0] >= 3
    batches = [folder_batch(f) for f in tables.current().tables[bt.ROWS]]
    assert batches == sorted(batches) and batches[-1] == 99


def test_readers_see_all_of_a_commit_or_nothing(spark, tmp_path):
    tables = Snapshots(spark, str(tmp_path / "t"))
    assert tables.current() == Manifest() and tables.read("a", SUMS).isEmpty()
    a, b = tables.write("a", 0, numbers(spark, 0, 3)), tables.write("b", 0, numbers(spark, 3, 5))
    assert tables.read("a", SUMS).isEmpty()
    first = tables.commit(0, {"a": a, "b": b})
    more = tables.write("a", 1, numbers(spark, 9, 10))
    assert tables.read("a", SUMS).count() == 3 and tables.read("b", SUMS).count() == 2
    tables.commit(1, {"a": more})
    assert tables.read("a", SUMS).count() == 4
    assert tables.read("a", SUMS, first).count() == 3  # an older manifest is still readable


def test_a_reader_from_before_a_compaction_can_finish(spark, tmp_path):
    tables = Snapshots(spark, str(tmp_path / "t"), fan=2)
    for i in range(2):
        tables.commit(i, {"a": tables.write("a", i, numbers(spark, i, i + 1))})
    before = tables.read("a", SUMS)
    assert tables.compact("a", SUMS, lambda df: bt.newest(df, ["id"])) == 2
    tables.vacuum()
    assert before.count() == 2 and tables.read("a", SUMS).count() == 2
    assert tables.vacuum(keep=1) == 2
    assert tables.read("a", SUMS).count() == 2


def test_writers_that_meet_both_commit(spark, tmp_path):
    """A writer whose manifest is taken commits on top of the other's."""
    root = str(tmp_path / "t")
    one, two = Snapshots(spark, root), Snapshots(spark, root)
    name = one.write("a", 0, numbers(spark, 0, 1))
    other = two.write("b", 0, numbers(spark, 0, 1))
    calls = []

    def change(before):
        calls.append(before.sequence)
        if len(calls) == 1:
            two.commit(0, {"b": other})
        return Manifest(0, 0, {**before.tables, "a": (name,)})

    assert one.update(change).tables == {"a": (name,), "b": (other,)} and calls == [0, 1]
    assert [n for n in child_names(spark, f"{root}/_manifests") if n.endswith(".tmp")] == []


def test_failed_tries_leave_no_trace(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    handle = rf.refresh_tables(root)
    handle(spark.createDataFrame(series_rows("a", 30), READING), 0)
    part = spark.createDataFrame(series_rows("a", 5, "2024-01-02T06:00:00"), READING)
    with monkeypatch.context() as patch:
        patch.setattr(rf, "_carry_on", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            handle(part, 1)
    assert rf.current_readings(spark, root).count() == 30 and rf.current_features(spark, root).count() == 6
    handle(part, 1)
    handle(part, 1)  # a batch that is in already
    assert rf.current_readings(spark, root).count() == 35 and rf.current_features(spark, root).count() == 11


def test_compaction_of_refreshed_tables(spark, tmp_path):
    """Late, repeated and revised readings over many batches; rows are those of one batch."""
    root, rng = str(tmp_path / "t"), random.Random(8)
    rows = series_rows("a", 70) + series_rows("b", 50, step_hours=6)
    rng.shuffle(rows)
    handle = rf.refresh_tables(root, fan=3)
    parts = [rows[i * 18 : (i + 1) * 18] for i in range(7)]
    parts[5] = [(s, t, v + 0.5) for s, t, v in parts[1]] + parts[5]
    for i, part in enumerate(parts):
        handle(spark.createDataFrame(part, READING), i)
    newest = {(s, t): v for part in parts for s, t, v in part}
    frame = spark.createDataFrame([(s, t, v) for (s, t), v in newest.items()], READING)
    want = tuples(ft.lag_features(cl.hourly(frame)))
    assert tuples(rf.current_features(spark, root).drop("interval_used")) == want
    assert tuples(rf.current_readings(spark, root).drop("interval_used")) == tuples(frame)
    for table in ("clean", "features"):
        assert len(Snapshots(spark, root).current().tables[table]) <= 4
        assert len(child_names(spark, f"{root}/{table}")) <= 9


def test_days_are_folders_and_are_pruned(spark, tmp_path):
    root = str(tmp_path / "t")
    rf.refresh_tables(root)(spark.createDataFrame(series_rows("a", 24 * 10), READING), 0)
    one = rf.current_readings(spark, root, "2024-01-03", "2024-01-04")
    assert one.count() == 48
    assert "PartitionFilters: [isnotnull(day" in plan(one)
    days = Snapshots(spark, root).read("clean", f"{READING}, day date")
    files = days.filter(F.col("day") == F.lit("2024-01-03").cast("date")).select(F.input_file_name().alias("f"))
    assert {r.f.split("/")[-2] for r in files.distinct().collect()} == {"day=2024-01-03"}


def test_a_late_reading_opens_the_days_before_it_only(spark, tmp_path, monkeypatch):
    """Years of history, one late reading: the scan is of a week's folders."""
    root, read = str(tmp_path / "t"), []
    handle = rf.refresh_tables(root)
    handle(spark.createDataFrame(series_rows("a", 24 * 40), READING), 0)
    recent = rf._recent

    def seen(history, late, since):
        start = F.timestamp_micros(F.lit(since))
        days = history.filter((F.col(rf.DAY) >= F.to_date(start)) & (F.col("datetime") >= start))
        read.append({r.f.split("day=")[1][:10] for r in days.select(F.input_file_name().alias("f")).distinct().collect()})
        return recent(history, late, since)

    monkeypatch.setattr(rf, "_recent", seen)
    handle(spark.createDataFrame([("a", at("2024-02-08T07:00:00"), 5.0)], READING), 1)
    assert len(read) == 1 and min(read[0]) == "2024-02-01" and len(read[0]) == 9
    days = {(at("2024-01-01") + dt.timedelta(hours=i)): float(i + 1) for i in range(24 * 40)}
    days[at("2024-02-08T07:00:00")] = 5.0
    frame = spark.createDataFrame([("a", t, v) for t, v in days.items()], READING)
    assert tuples(rf.current_features(spark, root).drop("interval_used")) == tuples(ft.lag_features(cl.hourly(frame)))


def test_scratch_folders_go(spark):
    df = spark.range(3)
    with scratch_scope(spark):
        inner = scratch_dir(spark, "inner")
        df.write.parquet(inner)
        assert path_exists(spark, inner)
    assert not path_exists(spark, inner)
    outer = stored(df, "outer")
    assert outer.count() == 3 and "/sensorloom/" in outer.inputFiles()[0]
