"""Aggregates over a stream of readings that no late row is lost from.

Every batch writes its own partial result as a version; readers combine the versions. There is no
state and no watermark: a row counts whenever it comes, in whatever batch, and a replayed batch
overwrites its version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.clean import largest

PARTIAL_MEANS = "sensor_id string, datetime timestamp, total double, n long"


def window_partials(readings: DataFrame, interval: str = "1 hour") -> DataFrame:
    """Sum and count per sensor and tumbling window (``1 hour`` or ``1 day``) of a batch."""
    return (
        readings.groupBy("sensor_id", F.window("datetime", interval).alias("span"))
        .agg(F.sum("pm25").alias("total"), F.count("pm25").alias("n"))
        .select("sensor_id", F.col("span.start").alias("datetime"), "total", "n")
    )


def windowed_means(partials: DataFrame) -> DataFrame:
    """Mean and count per sensor and window over all batches."""
    total, n = F.sum("total"), F.sum("n")
    return partials.groupBy("sensor_id", "datetime").agg((total / n).alias("pm25"), n.alias("n"))


def merged_partials(partials: DataFrame) -> DataFrame:
    """One partial result of several."""
    sums = [F.sum(c).alias(c) for c in ("total", "n")]
    return partials.groupBy("sensor_id", "datetime").agg(*sums)


def distinct_readings(readings: DataFrame) -> DataFrame:
    """One reading per (sensor, time), of different values the largest, as in batch.

    For a batch, and again for the union of what the batches wrote.
    """
    return readings.groupBy("sensor_id", "datetime").agg(largest("pm25"))
