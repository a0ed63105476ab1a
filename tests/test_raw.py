"""Raw documents: layouts, ids, faults, audits and round trips (fixtures E2 to E7, E16)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import at, envelope, land, record, tuples
from sensorloom.operators.clean import clean
from sensorloom.sources import raw as rw

GOOD = "2024-01-01T01:00:00Z"


def test_empty_or_missing_landing_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        rw.read_raw(spark, str(tmp_path / "nowhere"))
    land(tmp_path, "other.json", {"a": 1})
    with pytest.raises(ValueError):
        rw.read_raw(spark, str(tmp_path))


def test_mixed_ids_and_whole_numbers(spark, tmp_path):
    land(tmp_path, "sensor_5049_hourly_20240101_000000.json", envelope("5049", [record(3, GOOD)]))
    land(tmp_path, "sensor_5050_hourly_20240101_000000.json", envelope(5050, [record(1.5, GOOD)]))
    land(tmp_path, "sensor_abc_hourly_20240101_000000.json", envelope("abc", [record(2, GOOD)]))
    readings = rw.normalize(rw.read_raw(spark, str(tmp_path)))
    assert dict(readings.dtypes)["sensor_id"] == "string"
    assert tuples(readings, "sensor_id", "pm25") == [("5049", 3.0), ("5050", 1.5), ("abc", 2.0)]


def test_page_without_id_takes_it_from_the_file_name(spark, tmp_path):
    page = {"meta": {"found": 1, "limit": 100}, "results": [record(4.0, GOOD)]}
    land(tmp_path / "hourly", "pm25_sensor_5049_hourly_20240101_000000.json", page)
    readings = rw.normalize(rw.read_raw(spark, str(tmp_path)))
    assert tuples(readings) == [(4.0, at("2024-01-01T01:00:00"), "pm25", "1hour", "5049")]


def test_flat_and_nested_layouts_give_the_same_rows(spark, tmp_path):
    land(tmp_path, "sensor_1_hourly_a.json", envelope("1", [record(4.0, GOOD)]))
    land(tmp_path, "sensor_1_hourly_b.json", record(4.0, GOOD))
    rows = tuples(rw.normalize(rw.read_raw(spark, str(tmp_path))))
    assert len(rows) == 2 and rows[0] == rows[1]


def test_corrupt_file_is_kept_apart(spark, tmp_path):
    land(tmp_path, "sensor_1_hourly_a.json", '{"sensor_id": 1, "results": [')
    land(tmp_path, "sensor_2_hourly_a.json", envelope("2", [record(4.0, GOOD)]))
    raw = rw.read_raw(spark, str(tmp_path))
    broken = raw.filter(F.col("_corrupt").isNotNull()).select("sensor_id", "count", "file_name")
    assert [r.file_name for r in broken.collect()] == ["sensor_1_hourly_a.json"]
    assert tuples(rw.normalize(raw), "sensor_id") == [("2",)]


def test_bad_times_are_dropped_without_error(spark, tmp_path):
    times = [GOOD, "bad-ts", "", None]
    land(tmp_path, "sensor_1_x.json", envelope("1", [record(4.0, t) for t in times]))
    readings = rw.normalize(rw.read_raw(spark, str(tmp_path)))
    assert readings.filter("datetime IS NULL").count() == 3
    assert tuples(clean(readings)) == [("1", at("2024-01-01T01:00:00"), 4.0)]


def test_completeness_and_totals(spark, tmp_path):
    rows = [record(1.0, GOOD), record(2.0, GOOD)]
    land(tmp_path, "sensor_1_a.json", envelope("1", rows, count=3))
    land(tmp_path, "sensor_1_b.json", envelope("1", rows))
    land(tmp_path, "sensor_2_a.json", envelope("2", []))
    raw = rw.read_raw(spark, str(tmp_path))
    assert tuples(rw.incomplete_envelopes(raw), "sensor_id", "count", "records") == [("1", 3, 2)]
    assert rw.ingest_totals(raw).first().asDict() == {
        "n_sensors": 2,
        "n_records": 4,
        "n_files": 3,
    }


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, "y")], "id int, b string")
    assert tuples(rw.union_sources([a, b])) == [(1, "x", None), (2, None, "y")]


@pytest.mark.parametrize("most_records", [7, 10_000])
def test_round_trip_does_not_depend_on_packing(spark, tmp_path, most_records):
    rows = [(f"s{i % 3}", at("2024-01-01T00:00:00"), float(i), "pm25") for i in range(50)]
    rows += [("s1", at("2024-01-02T05:00:00"), 1.0, "pm25"), (None, None, None, None)]
    schema = "sensor_id string, datetime timestamp, pm25 double, parameter string"
    documents = []
    for parts in (1, 6):
        readings = spark.createDataFrame(rows, schema).repartition(parts)
        envelopes = rw.to_envelopes(readings, most_records=most_records)
        documents.append(tuples(envelopes))
    assert documents[0] == documents[1]
    assert (len(documents[0]) == 5) == (most_records == 10_000)
    rw.write_envelopes(envelopes, str(tmp_path / "out"))
    back = rw.read_raw(spark, str(tmp_path / "out"), multi_line=False, files="*.json")
    assert rw.incomplete_envelopes(back).isEmpty()
    assert tuples(back.filter("sensor_id = 's1'").select("date_from", "date_to").distinct()) == [
        ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z"),
        ("2024-01-02T05:00:00Z", "2024-01-02T05:00:00Z"),
    ]
    got = tuples(rw.normalize(back), "sensor_id", "datetime", "pm25", "parameter")
    assert got == sorted(rows, key=repr)
