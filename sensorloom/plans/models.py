"""MLlib models over the feature table: fit, compare, store, score, forecast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.features import latest_per_sensor, next_hour_features
from sensorloom.operators.metrics import predictions, regression_metrics, side_by_side
from sensorloom.operators.split import hash_sample
from sensorloom.schemas import FEATURE_COLUMNS

# Default hyper-parameters of each model.
DEFAULTS = {
    "linear_regression": {"regParam": 0.1},
    "random_forest": {
        "numTrees": 30,
        "maxDepth": 6,
        "maxBins": 32,
        "subsamplingRate": 0.8,
        "featureSubsetStrategy": "auto",
        "seed": 42,
    },
    "gbt_regression": {
        "maxIter": 50,
        "maxDepth": 5,
        "stepSize": 0.05,
        "subsamplingRate": 0.8,
        "seed": 42,
    },
}

# Accepted short names.
ALIASES = {
    "lr": "linear_regression",
    "linear": "linear_regression",
    "rf": "random_forest",
    "randomforest": "random_forest",
    "gbt": "gbt_regression",
}

ESTIMATORS = {
    "linear_regression": LinearRegression,
    "random_forest": RandomForestRegressor,
    "gbt_regression": GBTRegressor,
}
TREE_MODELS = {"random_forest", "gbt_regression"}


def model_name(alias: str) -> str:
    name = ALIASES.get(alias.lower(), alias.lower())
    if name not in ESTIMATORS:
        raise ValueError(f"unsupported model: {alias}")
    return name


def estimator(alias: str, inputs: Iterable[str] = FEATURE_COLUMNS, **params) -> Pipeline:
    """Vector assembly and regressor as one unit, so a stored model scores plain tables."""
    name = model_name(alias)
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(inputs), outputCol="features"),
            ESTIMATORS[name](
                featuresCol="features", labelCol="pm25", **{**DEFAULTS[name], **params}
            ),
        ]
    )


def fit(
    train: DataFrame,
    alias: str,
    inputs: Iterable[str] = FEATURE_COLUMNS,
    tree_sample: float = 0.3,
    **params,
) -> PipelineModel:
    """Fit one model; tree models learn from a reproducible sample of the training rows."""
    rows = hash_sample(train, tree_sample) if model_name(alias) in TREE_MODELS else train
    inputs = list(inputs)
    return estimator(alias, inputs, **params).fit(rows.select("pm25", *inputs))


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    return predictions(model.transform(features))


def evaluate(models: dict[str, PipelineModel], test: DataFrame) -> DataFrame:
    """Metrics of all models on the same held-out rows, which are read once."""
    rows = test
    for i, model in enumerate(models.values()):
        rows = model.transform(rows).withColumnRenamed("prediction", f"_prediction_{i}").drop("features")
    predicted = {name: F.col(f"_prediction_{i}") for i, name in enumerate(models)}
    return regression_metrics(side_by_side(rows, predicted))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def forecast_next_hour(features: DataFrame, model: PipelineModel) -> DataFrame:
    """Forecast for the hour after the newest feature row of every sensor."""
    upcoming = next_hour_features(latest_per_sensor(features))
    return model.transform(upcoming).select(
        "sensor_id",
        "datetime",
        "last_pm25",
        F.col("prediction").alias("forecast_pm25"),
    )
