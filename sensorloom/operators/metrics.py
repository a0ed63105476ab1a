"""Prediction tables, regression metrics, baseline, model ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def predictions(scored: DataFrame, *keep: str) -> DataFrame:
    """Prediction table. It keeps the sensor, so that equal times stay distinguishable."""
    return scored.select(
        "sensor_id",
        F.col("datetime").alias("date"),
        F.col("pm25").alias("actual_pm25"),
        F.col("prediction").alias("predicted_pm25"),
        *keep,
    )


def naive_predictions(features: DataFrame) -> DataFrame:
    """Persistence baseline: the previous reading."""
    return predictions(features.withColumn("prediction", F.col("lag_1")))


def side_by_side(rows: DataFrame, predicted: dict[str, Column]) -> DataFrame:
    """Prediction table of several models, from one pass over the rows: a block for each row."""
    pairs = [F.struct(F.lit(m).alias("model"), c.cast("double").alias("prediction")) for m, c in predicted.items()]
    blocks = rows.select("sensor_id", "datetime", "pm25", F.inline(F.array(*pairs)))
    return predictions(blocks, "model")


def metric_columns(actual: str, predicted: str) -> list[Column]:
    """RMSE, MAE and R2 as aggregates of one pass."""
    error = F.col(actual) - F.col(predicted)
    total = F.var_pop(actual) * F.count(actual)
    return [
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / F.nullif(total, F.lit(0.0))).alias("r2"),
    ]


def regression_metrics(predicted: DataFrame, by: str = "model") -> DataFrame:
    """One metrics row per model over the union of the models' prediction tables."""
    return known_predictions(predicted).groupBy(by).agg(*metric_columns("actual_pm25", "predicted_pm25"))


def known_predictions(predicted: DataFrame) -> DataFrame:
    return predicted.filter(F.col("actual_pm25").isNotNull() & F.col("predicted_pm25").isNotNull())


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the largest R2; on a tie the first by name."""
    return metrics.orderBy(F.desc_nulls_last("r2"), "model").limit(1)


def collapse_by_time(predicted: DataFrame) -> DataFrame:
    """Mean over the sensors that share a time; rows without a time are left out."""
    present = [c for c in ("actual_pm25", "predicted_pm25") if c in predicted.columns]
    return (
        predicted.dropna(subset=["date"])
        .groupBy("date")
        .agg(*[F.avg(c).alias(c) for c in present])
    )


def last_rows(by_time: DataFrame, n: int = 200) -> DataFrame:
    """The newest ``n`` rows, oldest first."""
    return by_time.orderBy(F.desc("date")).limit(n).orderBy("date")
