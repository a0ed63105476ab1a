"""The whole pipeline from landed files, through the functions and the command line."""

from __future__ import annotations

import pytest

from helpers import envelope, hours, land, record, tuples
from sensorloom import session
from sensorloom.__main__ import main
from sensorloom.plans import jobs


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for sensor in (5049, "abc"):
        results = [
            record(10.0 + i % 24, f"{t.isoformat()}Z")
            for i, t in enumerate(hours("2024-01-01", 120))
        ]
        results += [record(-999, "2024-01-01T00:00:00Z"), record(5, "bad"), results[0]]
        land(folder, f"sensor_{sensor}_hourly_20240201_000000.json", envelope(sensor, results))
    return str(folder)


def test_all_jobs(spark, landing, tmp_path):
    root = str(tmp_path)
    assert jobs.etl(spark, landing, root) == {
        "raw": 2,
        "unreadable": 0,
        "readings": 246,
        "clean": 242,
        "hourly": 240,
    }
    jobs.eda(spark, root)
    assert jobs.build_features(spark, root) == {"features": 192}
    small = {"random_forest": {"numTrees": 2}, "gbt_regression": {"maxIter": 2}}
    report = jobs.train(spark, root, params=small)
    # int(0.8 * 192) = 153; positions 152 and 153 share a time, and ties go to test.
    assert tuples(report, "side", "n") == [("test", 40), ("train", 152)]
    for model in ("lr", "rf", "gbt"):
        assert spark.read.parquet(jobs.predict(spark, root, model)).count() == 192
    assert spark.read.parquet(jobs.forecast(spark, root)).count() == 2
    metrics = spark.read.parquet(f"{root}/model_metrics")
    assert tuples(metrics, "model") == [
        ("gbt_regression",),
        ("linear_regression",),
        ("random_forest",),
    ]
    assert spark.read.parquet(f"{root}/holdout/linear_regression").count() == 40
    assert spark.read.parquet(f"{root}/eda/daily_trend").count() == 5
    jobs.report(spark, root, rows=7)
    assert spark.read.parquet(f"{root}/report/predictions").count() == 7
    assert spark.read.parquet(f"{root}/report/best_model").count() == 1
    assert tuples(spark.read.parquet(f"{root}/report/weekly"), "year_week") == [("2024-01",)]
    weekdays = tuples(spark.read.parquet(f"{root}/report/weekdays"), "weekday")
    assert weekdays == [("Fri",), ("Mon",), ("Thu",), ("Tue",), ("Wed",)]
    assert jobs.register_views(spark, root) == [t.rsplit("/", 1)[-1] for t in jobs.TABLES]
    by_day = spark.sql("SELECT date, avg(pm25) AS mean FROM pm25_clean GROUP BY date")
    stored = spark.sql("SELECT date, pm25_avg AS mean FROM daily_trend")
    assert tuples(by_day) == tuples(stored)
    jobs.train(spark, root, models=["lr"])
    assert spark.read.parquet(f"{root}/model_metrics").count() == 3


def test_command_line(spark, landing, tmp_path, capsys):
    root = ["--root", str(tmp_path)]
    main(["etl", "--raw", landing, *root])
    main(["eda", *root])
    main(["features", *root])
    main(["train", "--models", "lr", *root])
    main(["predict", *root])
    main(["forecast", "--model", "linear", *root])
    main(["report", "--year", "2024", "--rows", "5", *root])
    assert spark.read.parquet(str(tmp_path / "report/predictions")).count() == 5
    assert spark.read.parquet(str(tmp_path / "report/months")).count() == 1
    model = str(tmp_path / "models/linear_regression")
    live = ["--root", str(tmp_path / "live"), "--once", "--score-with", model]
    main(["stream", "--raw", landing, *live])
    out = capsys.readouterr().out
    assert "'hourly': 240" in out and "forecast/linear_regression" in out
    assert spark.read.parquet(str(tmp_path / "live/predictions")).count() == 192


def test_etl_chooses_readings_and_keeps_unreadable_documents(spark, tmp_path):
    landing, root = tmp_path / "raw", str(tmp_path / "t")
    times = [f"{t.isoformat()}Z" for t in hours("2024-01-01", 48)]
    for sensor in (1, 2):
        results = [record(float(i + 1), t) for i, t in enumerate(times)]
        land(landing, f"sensor_{sensor}_hourly_20240201_000000.json", envelope(sensor, results))
    (landing / "sensor_3_hourly_20240201_000000.json").write_text('{"sensor_id": 3, "results": [')
    counts = jobs.etl(
        spark, str(landing), root, sensors="2", start="2024-01-01 12:00:00", end="2024-01-02"
    )
    assert (counts["raw"], counts["unreadable"], counts["clean"]) == (3, 1, 13)
    assert tuples(spark.read.parquet(f"{root}/unreadable"), "file_name") == [
        ("sensor_3_hourly_20240201_000000.json",)]
    assert tuples(spark.read.parquet(f"{root}/pm25_clean").select("sensor_id").distinct()) == [("2",)]
    assert jobs.etl(spark, str(landing), root, lag_hours=24)["clean"] == 96
    with pytest.raises(ValueError):
        jobs.etl(spark, str(landing), root, sensors=" , ")


def test_scratch_follows_the_session(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    a, b = session.scratch_dir(spark, "x"), session.scratch_dir(spark, "x")
    assert a != b
    if named:
        assert a.startswith(named)


class FakeSession:
    def __init__(self, **conf):
        self.settings = {k.replace("_", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_a_cluster_must_name_its_shared_folder():
    with pytest.raises(ValueError):
        session.scratch_root(FakeSession(spark_master="yarn", spark_app_id="1"))
    named = FakeSession(spark_master="yarn", spark_checkpoint_dir="hdfs:///tmp/x")
    assert session.scratch_root(named) == "hdfs:///tmp/x"
    local = FakeSession(spark_master="local[2]", spark_app_id="2")
    assert session.scratch_root(local) == session.scratch_root(local)
