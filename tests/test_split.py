"""Order statistics, split and sampling against sorted lists (fixture E13)."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from helpers import READING, at, hours, series_rows, tuples
from sensorloom.operators import ranks as rk
from sensorloom.operators.ranks import group_sizes, median_rank, values_at_rank
from sensorloom.operators.split import hash_sample, split_report, time_split
from sensorloom.operators.trends import weekday_stats

rng = random.Random(1)
SAMPLES = {
    "ties": [3.0] * 50 + [1.0] * 30 + [2.0],
    "one": [7.25],
    "uniform": [rng.random() for _ in range(500)],
    "heavy_tail": [10.0 ** rng.uniform(-200, 200) for _ in range(200)],
    "infinite": [1.0, 2.0, float("inf"), 3.0, float("inf")],
    "neighbours": [1.0, 1.0 + 2**-52, 1.0 + 2**-51],
    "negative": [-5.5, 0.0, -0.25, 1e9, -1e9],
}


@pytest.mark.parametrize("name", SAMPLES)
@pytest.mark.parametrize("bins", [3, 4096])
def test_value_at_rank(spark, name, bins):
    values = SAMPLES[name] if bins > 3 else SAMPLES[name][:9]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").coalesce(2)
    for rank in {0, len(values) // 2, len(values) - 1}:
        assert values_at_rank(df, "v", {0: rank}, bins=bins) == {0: sorted(values)[rank]}


def test_ranks_per_group(spark):
    rows = [(g, float(i * 7 % 101)) for i in range(100) for g in ("a", "b")] + [("c", 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    sizes = group_sizes(df, "v", F.col("g"))
    assert sizes["a"][0] == 100
    ranks = {g: median_rank(n) for g, (n, _, _) in sizes.items()}
    middle = sorted(float(i * 7 % 101) for i in range(100))[49]
    assert values_at_rank(df, "v", ranks, F.col("g"), sizes) == {"a": middle, "b": middle, "c": 1.0}
    assert values_at_rank(df, "v", {"a": 100}, F.col("g")) == {}


def test_ties_at_the_cut_go_to_test(spark):
    times = hours("2024-01-01", 7) + [at("2024-01-02")] * 3
    df = spark.createDataFrame([(f"s{i}", t, 1.0) for i, t in enumerate(times)], READING)
    split = time_split(df)
    assert split.train.count() == 7 and split.test.count() == 3
    assert split.test.agg(F.min("datetime")).first()[0] == at("2024-01-02")
    report = {r.side: r for r in split_report(df, split.cut).collect()}
    assert (report["train"].n, report["train"].pct) == (7, 70.0)
    assert (report["test"].n, report["test"].pct) == (3, 30.0)


def test_incomplete_rows_take_no_part(spark):
    rows = series_rows("s", 10) + [("s", at("2030-01-01"), None), ("s", None, 1.0)]
    split = time_split(spark.createDataFrame(rows, READING))
    assert split.train.count() == 8 and split.test.count() == 2
    with pytest.raises(ValueError):
        time_split(spark.createDataFrame([("s", None, 1.0)], READING))


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(series_rows("a", 2000) + series_rows("b", 2000), READING)
    kept = tuples(hash_sample(df, 0.3))
    assert kept == tuples(hash_sample(df.repartition(7, "pm25"), 0.3))
    assert 1000 < len(kept) < 1400
    assert kept != tuples(hash_sample(df, 0.3, seed=7))
    assert hash_sample(df, 1.0).count() == 4000 and hash_sample(df, 0.0).count() == 0
    # Sensors that report at the same hours are sampled independently of each other.
    assert {t for s, t, _ in kept if s == "a"} != {t for s, t, _ in kept if s == "b"}


def test_ranks_leave_out_nan(spark):
    nan = float("nan")
    rows = [("a", v) for v in (nan, nan, nan, 1.0)] + [("b", nan)] + [("c", None)]
    rows += [("d", v) for v in (float("inf"), float("-inf"), 3.0, nan, None, 3.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    sizes = rk.group_sizes(df, "v", F.col("g"))
    assert sizes == {"a": (1, 1.0, 1.0), "d": (4, float("-inf"), float("inf"))}
    ranks = {g: rk.median_rank(n) for g, (n, *_) in sizes.items()}
    assert rk.values_at_rank(df, "v", ranks, F.col("g"), sizes) == {"a": 1.0, "d": 3.0}


def test_weekday_median_of_faulty_readings_ends(spark):
    sunday = at("2024-01-07T05:00:00")
    for values, want in (([float("nan")] * 3 + [1.0], 1.0), ([float("nan")] * 2, None), ([None], None)):
        df = spark.createDataFrame([("s", sunday, v) for v in values], READING)
        assert [r.pm25_median for r in weekday_stats(df).collect()] == [want]
