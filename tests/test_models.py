"""Metrics, models, stored models and forecasts against numpy and MLlib's own evaluator."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from helpers import at, hours, tuples
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators import metrics as mt
from sensorloom.operators.split import time_split
from sensorloom.plans import models as ml
from sensorloom.schemas import FEATURE_COLUMNS, SERIES_KEY
from sensorloom.sources import tables as tb

READING = "sensor_id string, datetime timestamp, pm25 double"


@pytest.fixture(scope="module")
def features(spark, tmp_path_factory):
    noise = np.random.default_rng(3)
    rows = [
        (s, t, float(20 + 8 * np.sin(i / 4 + k) + noise.normal()))
        for k, s in enumerate(["a", "b"])
        for i, t in enumerate(hours("2024-01-01", 150))
    ]
    path = str(tmp_path_factory.mktemp("features") / "table")
    frame = ft.lag_features(cl.hourly(spark.createDataFrame(rows, READING)))
    frame.write.parquet(path)
    return spark.read.parquet(path)


def ridge_by_hand(x, y, strength=0.1):
    """Ridge on inputs and target in standard units, given back in the original units."""
    sx, sy = x.std(axis=0), y.std()
    keep = sx > 0
    z = (x[:, keep] - x[:, keep].mean(axis=0)) / sx[keep]
    t = (y - y.mean()) / sy
    n = len(y)
    w = np.linalg.solve(z.T @ z / n + strength / sy * np.eye(z.shape[1]), z.T @ t / n)
    beta = np.zeros(x.shape[1])
    beta[keep] = w * sy / sx[keep]
    return beta, y.mean() - x.mean(axis=0) @ beta


def test_linear_regression_is_ridge(features):
    split = time_split(features, required=SERIES_KEY)
    model = ml.fit(split.train, "lr")
    train = split.train.toPandas()
    beta, intercept = ridge_by_hand(
        train[FEATURE_COLUMNS].to_numpy(float), train["pm25"].to_numpy()
    )
    rows = split.test.orderBy(*SERIES_KEY).toPandas()
    want = rows[FEATURE_COLUMNS].to_numpy(float) @ beta + intercept
    got = ml.score(model, split.test).orderBy("sensor_id", "date").toPandas()["predicted_pm25"]
    np.testing.assert_allclose(got, want, rtol=1e-9)


@pytest.mark.parametrize(
    "alias, params", [("lr", {}), ("rf", {"numTrees": 3}), ("gbt", {"maxIter": 2})]
)
def test_stored_model_predicts_the_same(features, tmp_path, alias, params):
    model = ml.fit(features, alias, tree_sample=1.0, **params)
    path = str(tmp_path / "model")
    ml.save(model, path)
    ml.save(model, path)
    before, after = ml.score(model, features), ml.score(ml.load(path), features)
    assert before.columns == ["sensor_id", "date", "actual_pm25", "predicted_pm25"]
    assert tuples(before) == tuples(after)


def test_model_names_and_defaults():
    names = {a: ml.model_name(a) for a in ("LR", "linear", "rf", "randomforest", "gbt")}
    assert names == {
        "LR": "linear_regression",
        "linear": "linear_regression",
        "rf": "random_forest",
        "randomforest": "random_forest",
        "gbt": "gbt_regression",
    }
    with pytest.raises(ValueError):
        ml.model_name("svm")


def test_default_parameters(spark):
    forest = ml.estimator("rf").getStages()[1]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMaxBins()) == (30, 6, 32)
    assert (forest.getSubsamplingRate(), forest.getSeed()) == (0.8, 42)
    assert forest.getFeatureSubsetStrategy() == "auto"
    boosted = ml.estimator("gbt").getStages()[1]
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (50, 5, 0.05)
    assert ml.estimator("lr").getStages()[1].getRegParam() == 0.1
    assert ml.estimator("gbt", maxIter=3).getStages()[1].getMaxIter() == 3


def test_metrics_equal_mllib(features):
    table = mt.naive_predictions(features).withColumn("model", F.lit("persistence"))
    mine = mt.regression_metrics(table).first()
    for name in ("rmse", "mae", "r2"):
        judge = RegressionEvaluator(
            labelCol="actual_pm25", predictionCol="predicted_pm25", metricName=name
        )
        assert mine[name] == pytest.approx(judge.evaluate(table), rel=1e-9)


def test_constant_target_has_no_r2(spark):
    rows = [("m", 1.0, 2.0), ("m", 1.0, 1.0)]
    table = spark.createDataFrame(rows, "model string, actual_pm25 double, predicted_pm25 double")
    row = mt.regression_metrics(table).first()
    assert row.r2 is None and row.mae == 0.5


def test_evaluate_uses_the_same_rows_for_all(features):
    split = time_split(features, required=SERIES_KEY)
    models = {"linear_regression": ml.fit(split.train, "lr")}
    models["random_forest"] = ml.fit(split.train, "rf", numTrees=3)
    metrics = ml.evaluate(models, split.test)
    assert {r.model for r in metrics.collect()} == set(models)
    best = mt.best_model(metrics).first()
    assert best.r2 == max(r.r2 for r in metrics.collect())


def test_forecast_per_sensor(features):
    model = ml.fit(features, "lr")
    rows = {r.sensor_id: r for r in ml.forecast_next_hour(features, model).collect()}
    assert set(rows) == {"a", "b"}
    assert rows["a"].datetime == at("2024-01-07T06:00:00")
    shifted = ft.next_hour_features(ft.latest_row(features))
    one = model.transform(shifted).first()
    assert one.sensor_id == "b" and rows["b"].forecast_pm25 == one.prediction


def test_best_model_prefers_larger_r2_then_name(spark):
    rows = [("b", 1.0, 1.0, 0.5), ("a", 2.0, 1.0, 0.5), ("c", 0.1, 0.1, None)]
    metrics = spark.createDataFrame(rows, "model string, rmse double, mae double, r2 double")
    assert mt.best_model(metrics).first().model == "a"


def test_collapse_and_tail(spark):
    rows = [(at("2024-01-01"), 1.0, 2.0), (at("2024-01-01"), 3.0, 4.0), (at("2024-01-02"), 5.0, 6.0)]
    rows.append((None, 9.0, 9.0))
    table = spark.createDataFrame(
        rows, "date timestamp, actual_pm25 double, predicted_pm25 double"
    )
    by_time = mt.collapse_by_time(table)
    assert tuples(by_time) == [(at("2024-01-01"), 2.0, 3.0), (at("2024-01-02"), 5.0, 6.0)]
    assert [tuple(r) for r in mt.last_rows(by_time, 1).collect()] == [(at("2024-01-02"), 5.0, 6.0)]
    only = mt.collapse_by_time(table.drop("predicted_pm25"))
    assert only.columns == ["date", "actual_pm25"]


def test_upsert_keeps_old_replaces_and_adds(spark, tmp_path):
    schema = "model string, rmse double, mae double, r2 double"
    old = spark.createDataFrame([("a", 1.0, 1.0, 1.0), ("b", 1.0, 1.0, 1.0)], schema)
    new = spark.createDataFrame([("b", 2.0, 2.0, 2.0), ("c", 2.0, 2.0, 2.0)], schema)
    path = str(tmp_path / "metrics")
    tb.upsert_table(old, path, ["model"])
    tb.upsert_table(new, path, ["model"])
    stored = spark.read.parquet(path)
    assert tuples(stored, "model", "rmse") == [("a", 1.0), ("b", 2.0), ("c", 2.0)]
    assert [p.name for p in tmp_path.iterdir()] == ["metrics"]


def test_unreadable_old_table_is_an_error_and_stays(spark, tmp_path):
    path = tmp_path / "metrics"
    path.mkdir()
    (path / "part-0.parquet").write_text("not parquet")
    new = spark.createDataFrame([("b", 2.0)], "model string, rmse double")
    with pytest.raises(Exception):
        tb.upsert_table(new, str(path), ["model"])
    assert (path / "part-0.parquet").exists()


def test_replace_table_may_read_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    tb.replace_table(spark.read.parquet(path).filter("id < 3"), path, single_file=True)
    assert spark.read.parquet(path).count() == 3
    assert len(list((tmp_path / "t").glob("part-*.parquet"))) == 1


def test_preview_and_present_columns(spark):
    df = spark.createDataFrame([(3, "x"), (1, "y"), (2, "z")], "id int, a string")
    assert [r.id for r in tb.preview(df, 2, ["id"]).collect()] == [1, 2]
    assert tb.present_columns(df, ["b", "a"]).columns == ["a"]
