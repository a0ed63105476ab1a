"""Chronological train/test split and reproducible sampling."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions import percent
from sensorloom.operators.ranks import group_sizes, values_at_rank


class Split(NamedTuple):
    train: DataFrame
    test: DataFrame
    cut: Column


def split_time(features: DataFrame, fraction: float = 0.8) -> int | None:
    """Microseconds of the row at 0-based position ``int(n * fraction)`` in time order."""
    micros = features.select(F.unix_micros("datetime").alias("micros"), "datetime")
    sizes = group_sizes(micros, "micros")
    if not sizes:
        return None
    rank = int(sizes[0][0] * fraction)
    return values_at_rank(micros, "micros", {0: rank}, sizes=sizes, time="datetime").get(0)


def time_split(
    features: DataFrame, fraction: float = 0.8, required: list[str] | None = None
) -> Split:
    """Rows before the cut train, rows at or after it test; ties at the cut all go to test.

    Rows with a null in any column are left out first. Where a table is known to be complete
    but for some columns, name those in ``required``: the passes that look for the cut then
    read only them and the time. The cut is a literal, so both sides are plain filters that
    reach the scan.
    """
    complete = features.dropna(subset=required)
    micros = split_time(complete, fraction)
    if micros is None:
        raise ValueError("no complete rows to split")
    cut = F.timestamp_micros(F.lit(micros))
    time = F.col("datetime")
    return Split(complete.filter(time < cut), complete.filter(time >= cut), cut)


def split_report(
    features: DataFrame, cut: Column, required: list[str] | None = None
) -> DataFrame:
    """Rows, share, first and last time of each side, in one pass."""
    sides = (
        features.dropna(subset=required)
        .groupBy(F.when(F.col("datetime") < cut, "train").otherwise("test").alias("side"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("datetime").alias("first_time"),
            F.max("datetime").alias("last_time"),
        )
    )
    total = F.sum("n").over(Window.partitionBy())  # over the two rows of the report
    return sides.select(
        "side", "n", percent(F.col("n"), total).alias("pct"), "first_time", "last_time"
    )


def hash_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, chosen by a hash of (seed, sensor, time).

    The choice depends on the rows alone, not on partitioning or on a retried task.
    """
    if fraction >= 1:
        return df
    identity = F.concat_ws("|", F.lit(seed), "sensor_id", F.unix_micros("datetime"))
    uniform = F.conv(F.substring(F.md5(identity), 1, 8), 16, 10).cast("long")
    return df.filter(uniform < F.lit(int(fraction * 2**32)))
