"""Landed documents: a file for each, under names that the default readers expect."""

from __future__ import annotations

import json
import re

import pytest

from helpers import at, series_rows, tuples
from sensorloom.sources import landing as ld
from sensorloom.sources import raw as rw
from sensorloom.streaming import batches as bt
from test_streaming import finish

READING = "sensor_id string, datetime timestamp, pm25 double, parameter string"


def rows(*sensors):
    return [(*r, "pm25") for s in sensors for r in series_rows(s, 30)]


def envelopes(spark, some):
    return rw.to_envelopes(spark.createDataFrame(some, READING))


def test_a_file_for_each_document(spark, tmp_path):
    made = envelopes(spark, rows("7", "8"))
    ld.land(made, str(tmp_path / "raw"))
    names = sorted(p.name for p in (tmp_path / "raw").iterdir())
    assert len(names) == made.count() == 4
    assert all(re.fullmatch(r"sensor_[78]_hourly_2024010[12]T000000_[0-9a-f]{12}\.json", n) for n in names)
    held = json.loads((tmp_path / "raw" / names[0]).read_text())
    assert held["sensor_id"] == "7" and held["count"] == len(held["results"]) == 24
    raw = rw.read_raw(spark, str(tmp_path / "raw"))
    got = rw.normalize(raw).select("sensor_id", "datetime", "pm25", "parameter")
    assert tuples(got) == sorted(rows("7", "8"), key=repr)
    assert rw.ingest_totals(raw).first().asDict() == {"n_sensors": 2, "n_records": 60, "n_files": 4}


def test_landing_again_changes_nothing(spark, tmp_path):
    """As after a task that ran twice."""
    made = envelopes(spark, rows("7"))
    for _ in range(2):
        ld.land(made, str(tmp_path / "raw"))
    assert len(list((tmp_path / "raw").iterdir())) == 2
    ld.land(envelopes(spark, [("7", at("2024-01-01"), 9.0, "pm25")]), f"file://{tmp_path}/raw")
    assert len(list((tmp_path / "raw").iterdir())) == 3
    assert rw.normalize(rw.read_raw(spark, str(tmp_path / "raw"))).count() == 31


def test_ids_that_are_no_file_names(spark, tmp_path):
    odd = ["a_b", "a/b", "../c", "é", "", None, "a-b"]
    some = [(s, at("2024-01-01"), float(i), "pm25") for i, s in enumerate(odd)]
    ld.land(envelopes(spark, some), str(tmp_path / "raw"))
    assert len(list((tmp_path / "raw").iterdir())) == len(odd)
    got = rw.normalize(rw.read_raw(spark, str(tmp_path / "raw")))
    assert {r.sensor_id for r in got.collect()} >= {"a_b", "a/b", "../c", "é", "a-b"} and got.count() == len(odd)


def test_streams_land_and_read_documents(spark, tmp_path):
    """A stream of envelopes lands them; another reads the folder with its default options."""
    envelopes(spark, rows("7", "8")).write.json(str(tmp_path / "in"))
    schema = envelopes(spark, rows("7")).schema
    spark.dataSource.register(ld.LandingSource)
    source = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    sink = ld.documents(source).writeStream.format(ld.FORMAT).option("path", str(tmp_path / "raw"))
    finish(sink.option("checkpointLocation", str(tmp_path / "cp1")).trigger(availableNow=True).start())
    raw = rw.read_raw_stream(spark, str(tmp_path / "raw"))
    finish(bt.start(rw.normalize(raw), bt.versioned_sink(str(tmp_path / "out")), str(tmp_path / "cp2"), once=True))
    got = bt.read_versions(spark, str(tmp_path / "out"), READING).select("sensor_id", "datetime", "pm25", "parameter")
    assert tuples(got) == sorted(rows("7", "8"), key=repr)


def test_a_landing_is_not_overwritten(spark, tmp_path):
    spark.dataSource.register(ld.LandingSource)
    with pytest.raises(Exception, match="only added to"):
        ld.documents(envelopes(spark, rows("7"))).write.format(ld.FORMAT).option("path", str(tmp_path)).mode("overwrite").save()
