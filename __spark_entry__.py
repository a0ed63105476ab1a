"""Queries over the given tables and the SQL that checks them.

``events`` plays the readings table: ``user_id`` is the sensor, ``ts`` the time, ``value`` the
measurement. ``orders`` spans several years and serves the yearly and weekly views.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sensorloom.functions import (
    parse_utc,
    utc_iso,
    utc_iso_text,
    weekday_label,
    year_week_label,
)
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators import metrics as mt
from sensorloom.operators import split as sp
from sensorloom.operators import trends as tr
from sensorloom.plans import models as ml
from sensorloom.schemas import CALENDAR_COLUMNS, LAG_COLUMNS, METRICS, SERIES_KEY
from sensorloom.session import configure, scratch_dir, stored
from sensorloom.sources import landing as ld
from sensorloom.sources import raw as rw
from sensorloom.sources import tables as tb
from sensorloom.streaming import aggregates as ag
from sensorloom.streaming import batches as bt
from sensorloom.streaming import eventtime as et
from sensorloom.streaming import refresh as rf

# The corpus operators can be left out; an import error inside them isn't hidden.
CORPUS = CORPUS_SQL = PIPELINE = None
try:
    PIPELINE = import_module("corpus_pipeline")
    CORPUS = import_module("sensorloom.llm.queries")
    CORPUS_SQL = import_module("sensorloom.llm.sql")
except ModuleNotFoundError as missing:
    if not re.fullmatch(r"corpus_pipeline|sensorloom\.llm(\..*)?", missing.name or ""):
        raise

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double"
ORDERS = (
    "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp, "
    "o_orderpriority string"
)
NUDGE = 1e-9
STUMP_INPUTS = ["hour", "day_of_week"]
STUMP_STEP = 0.25
BASELINES = {"persistence": "lag_1", "previous_day": "lag_24"}


# --- inputs -------------------------------------------------------------------------------


def _from_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").cast("string").alias("sensor_id"),
        F.col("ts").alias("datetime"),
        F.col("value").alias("pm25"),
        F.col("event_type").alias("parameter"),
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _from_events(tb.read_table(configure(spark), f"{sf_dir}/events.parquet", EVENTS))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as clean readings of one parameter."""
    return cl.clean(readings(spark, sf_dir).withColumn("parameter", F.lit("pm25")))


def order_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = tb.read_table(configure(spark), f"{sf_dir}/orders.parquet", ORDERS)
    return orders.select(
        F.col("o_custkey").cast("string").alias("sensor_id"),
        F.col("o_orderdate").alias("datetime"),
        F.col("o_totalprice").alias("pm25"),
        F.col("o_orderpriority").alias("priority"),
    )


def faulty_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, some with the faults that real feeds have."""
    event = F.col("event_id")
    value = (
        F.when(event % 97 == 0, F.lit(None).cast("double"))
        .when(event % 89 == 0, F.lit(float("nan")))
        .when(event % 83 == 0, F.lit(-999.0))
        .when(event % 79 == 0, F.lit(0.0))
        .otherwise(F.col("pm25"))
    )
    time = F.when(event % 73 != 0, F.col("datetime"))
    parameter = F.when(event % 5 == 0, "no2").otherwise("pm25")
    return readings(spark, sf_dir).select(
        "sensor_id", time.alias("datetime"), value.alias("pm25"), parameter.alias("parameter")
    )


def distinct_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per sensor and time."""
    return cl.dedup(series(spark, sf_dir))


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ft.lag_features(cl.hourly(distinct_series(spark, sf_dir)))


def stored_features(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The feature table as later jobs see it: written once, then scanned; some columns of it only."""
    rows = feature_rows(spark, sf_dir)
    return stored(rows.select(*columns) if columns else rows, "features")


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rw.to_envelopes(readings(spark, sf_dir))


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tr.daily_means(order_series(spark, sf_dir))


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Six digits, with a nudge: sums differ in their last bits between engines, and means of
    2, 4, ... 32 values often lie exactly between two six-digit numbers."""
    return df.withColumns({c: F.round(F.col(c) + NUDGE, 6) for c in columns})


def date_text(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.col("date").cast("string"))


# --- readings -----------------------------------------------------------------------------


def clean_readings(spark, sf_dir):
    return cl.clean(faulty_readings(spark, sf_dir))


def hourly_calendar(spark, sf_dir):
    return cl.hourly(series(spark, sf_dir))


def ordered_readings(spark, sf_dir):
    return cl.ordered(cl.hourly(series(spark, sf_dir)))


def preview_head(spark, sf_dir):
    return tb.preview(cl.hourly(series(spark, sf_dir)), 50, ["sensor_id", "datetime"])


def time_range(spark, sf_dir):
    return cl.in_time_range(series(spark, sf_dir), "2024-01-10 00:00:00", "2024-01-12 12:00:00")


def sensor_subset(spark, sf_dir):
    return cl.only_sensors(series(spark, sf_dir), " 1, 7,,12 ")


def dedup_readings(spark, sf_dir):
    """Every reading pulled twice, the second time sometimes revised; the last pull wins."""
    first = readings(spark, sf_dir)
    revised = F.when(F.col("event_id") % 2 == 0, F.col("pm25") + 1).otherwise(F.col("pm25"))
    second = first.withColumn("pm25", revised)
    both = first.withColumn("pull", F.lit(1)).unionByName(second.withColumn("pull", F.lit(2)))
    return cl.dedup(both.select("sensor_id", "datetime", "pm25", "pull"), order_by=["pull"])


def hourly_resample(spark, sf_dir):
    return rounded(cl.hourly_resample(series(spark, sf_dir)), "pm25")


def latest_time(spark, sf_dir):
    return cl.latest_time(readings(spark, sf_dir))


def hourly_or_daily(spark, sf_dir):
    clean = series(spark, sf_dir)
    newest = cl.latest_time(clean).select(F.unix_micros("latest")).first()[0]
    until = F.timestamp_micros(F.lit(newest)) - F.expr("INTERVAL 24 HOURS")
    daily = tr.daily_means(clean, "sensor_id").select(
        "sensor_id",
        F.col("date").cast("timestamp").alias("datetime"),
        F.col("pm25_avg").alias("pm25"),
    )
    return rounded(cl.hourly_or_daily(cl.resampled_window(clean, until), daily, until), "pm25")


# --- raw documents ------------------------------------------------------------------------


def raw_json_roundtrip(spark, sf_dir):
    """Landed one document per file, read by the default reader."""
    return rw.normalize(rw.read_raw(spark, landed(spark, sf_dir)))


def raw_json_stream(spark, sf_dir):
    """The same folder as a stream, by the default reader."""
    root = scratch_dir(spark, "raw-stream")
    raw = rw.read_raw_stream(spark, landed(spark, sf_dir))
    _finish(bt.start(rw.normalize(raw), bt.versioned_sink(f"{root}/out"), f"{root}/checkpoint", once=True))
    schema = "pm25 double, datetime timestamp, parameter string, period_label string, sensor_id string"
    return bt.read_versions(spark, f"{root}/out", schema).drop(bt.VERSION)


def landed(spark, sf_dir):
    landing = scratch_dir(spark, "landing")
    ld.land(rw.to_envelopes(readings(spark, sf_dir), span="month"), landing)
    return landing


def normalize_readings(spark, sf_dir):
    """Every event in the envelope layout and again in the flat layout, some times broken."""
    event = F.col("event_id")
    text = F.when(event % 53 == 0, "bad-ts").when(event % 59 == 0, "")
    text = text.otherwise(utc_iso(F.col("datetime")))
    record = F.struct(
        F.col("pm25").alias("value"),
        F.struct(F.col("parameter").alias("name")).alias("parameter"),
        F.struct(F.lit("1hour").alias("label"), F.struct(text.alias("utc")).alias("datetimeTo"))
        .alias("period"),
    )
    rows = readings(spark, sf_dir).select("sensor_id", record.alias("record"))
    nested = rows.select("sensor_id", F.array("record").alias("results"))
    flat = rows.select("sensor_id", "record.*")
    return rw.normalize(rw.union_sources([nested, flat]))


def envelope_check(spark, sf_dir):
    """Records below 10 get lost after packing; the check finds how many per sensor."""
    kept = F.filter("results", lambda record: record["value"] >= 10)
    broken = envelopes(spark, sf_dir).withColumn("results", kept)
    return (
        rw.incomplete_envelopes(broken)
        .groupBy("sensor_id")
        .agg(F.sum(F.col("count") - F.col("records")).alias("missing"))
    )


def union_sources(spark, sf_dir):
    return rw.union_sources(
        [
            readings(spark, sf_dir).select("sensor_id", "datetime", "pm25", "parameter"),
            order_series(spark, sf_dir),
        ]
    )


def ingest_totals(spark, sf_dir):
    return rw.ingest_totals(rw.read_raw(spark, landed(spark, sf_dir)))


def stage_counts(spark, sf_dir):
    """Rows after each stage, counted while the stages' tables are written."""
    path = scratch_dir(spark, "stages")
    raw, n_raw = tb.counted(faulty_readings(spark, sf_dir), "raw")
    kept, n_clean = tb.counted(cl.clean(raw), "clean")
    tb.write_table(kept, f"{path}/clean")
    rows = ft.lag_features(cl.hourly(tb.read_table(spark, f"{path}/clean")))
    rows, n_features = tb.counted(rows, "features")
    tb.write_table(rows, f"{path}/features")
    stages = {"raw": n_raw, "clean": n_clean, "features": n_features}
    return spark.createDataFrame(
        [(stage, seen.get["n"]) for stage, seen in stages.items()], "stage string, n long"
    )


def utc_iso_times(spark, sf_dir):
    text = F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss")
    marked = F.when(F.col("event_id") % 2 == 0, F.concat(text, F.lit("Z"))).otherwise(text)
    return readings(spark, sf_dir).select(
        "event_id",
        utc_iso(F.col("datetime")).alias("iso"),
        utc_iso_text(marked).alias("iso_text"),
        parse_utc(utc_iso_text(marked)).alias("parsed"),
    )


# --- trends -------------------------------------------------------------------------------


def daily_trend(spark, sf_dir):
    return date_text(rounded(tr.daily_trend(series(spark, sf_dir)), "pm25_avg", "pm25_avg_7d"))


def daily_trend_by_sensor(spark, sf_dir):
    trend = tr.daily_trend_by_sensor(series(spark, sf_dir))
    return date_text(rounded(trend, "pm25_avg", "pm25_avg_7d"))


def weekday_stats(spark, sf_dir):
    return rounded(tr.weekday_stats(series(spark, sf_dir)), "pm25_avg")


def weekday_labels(spark, sf_dir):
    """Readings per weekday label; number 8 is no weekday and stays text."""
    day = F.when(F.col("event_id") % 10 == 0, 8).otherwise(F.dayofweek("datetime"))
    return (
        readings(spark, sf_dir)
        .groupBy(weekday_label(day).alias("weekday"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekly_trend(spark, sf_dir):
    return rounded(tr.weekly_trend(order_series(spark, sf_dir)), "pm25_avg")


def weekly_trend_iso(spark, sf_dir):
    return rounded(tr.weekly_trend(order_series(spark, sf_dir), iso_year=True), "pm25_avg")


def year_week_labels(spark, sf_dir):
    label = year_week_label(F.col("year"), F.col("week_of_year"))
    return tr.weekly_trend(order_series(spark, sf_dir)).select(label.alias("year_week"), "n")


def yearly_monthly(spark, sf_dir):
    return rounded(tr.monthly_means(tr.in_year(order_days(spark, sf_dir))), "pm25_avg")


def yearly_summary(spark, sf_dir):
    summary = tr.yearly_summary(order_days(spark, sf_dir))
    return rounded(summary, "year_avg", "year_max", "year_min")


def distinct_years(spark, sf_dir):
    return tr.distinct_years(order_days(spark, sf_dir))


# --- features -----------------------------------------------------------------------------


def latest_per_sensor(spark, sf_dir):
    return ft.latest_per_sensor(cl.hourly(distinct_series(spark, sf_dir)))


def next_hour_features(spark, sf_dir):
    return ft.next_hour_features(ft.latest_per_sensor(feature_rows(spark, sf_dir)))


def lag_by_time(spark, sf_dir):
    hours = cl.hourly_resample(series(spark, sf_dir)).select("sensor_id", "datetime", "pm25")
    lagged = ft.lag_by_time(hours, (1, 24))
    return rounded(lagged, "pm25", "pm25_1h_ago", "pm25_24h_ago")


def gap_report(spark, sf_dir):
    return rounded(ft.gap_report(series(spark, sf_dir), min_hours=24), "gap_hours")


# --- split, baseline and metrics ----------------------------------------------------------


def time_split(spark, sf_dir):
    split = sp.time_split(stored_features(spark, sf_dir, *SERIES_KEY), required=SERIES_KEY)
    train = split.train.withColumn("side", F.lit("train"))
    both = train.unionByName(split.test.withColumn("side", F.lit("test")))
    return both.select("sensor_id", "datetime", "side")


def split_report(spark, sf_dir):
    features = stored_features(spark, sf_dir, *SERIES_KEY)
    cut = sp.time_split(features).cut  # no column may be null
    return sp.split_report(features, cut)


def hash_sample(spark, sf_dir):
    return sp.hash_sample(series(spark, sf_dir), 0.3)


def naive_predictions(spark, sf_dir):
    return mt.naive_predictions(feature_rows(spark, sf_dir))


def baseline_predictions(features: DataFrame) -> DataFrame:
    """Predictions of simple rules, one block of rows per rule."""
    return mt.side_by_side(features, {name: F.col(column) for name, column in BASELINES.items()})


def naive_metrics(spark, sf_dir):
    used = [*SERIES_KEY, "pm25", *BASELINES.values()]
    split = sp.time_split(stored_features(spark, sf_dir, *used), required=SERIES_KEY)
    metrics = mt.regression_metrics(baseline_predictions(split.test))
    return rounded(metrics, "rmse", "mae", "r2")


def best_model(spark, sf_dir):
    metrics = mt.regression_metrics(baseline_predictions(feature_rows(spark, sf_dir)))
    return rounded(mt.best_model(metrics), "rmse", "mae", "r2")


def metrics_upsert(spark, sf_dir):
    """Stored: both rules on training rows. New: one of them, and a third, on test rows."""
    split = sp.time_split(stored_features(spark, sf_dir), required=SERIES_KEY)
    path = scratch_dir(spark, "metrics")
    tb.upsert_table(
        mt.regression_metrics(baseline_predictions(split.train)), path, ["model"]
    )
    mean = sum((F.col(c) for c in LAG_COLUMNS), F.lit(0.0)) / len(LAG_COLUMNS)
    rules = {"previous_day": F.col(BASELINES["previous_day"]), "mean_of_day": mean}
    fresh = mt.side_by_side(split.test, rules)
    tb.upsert_table(mt.regression_metrics(fresh), path, ["model"])
    return rounded(tb.read_table(spark, path, METRICS), "rmse", "mae", "r2")


def hourly_predictions(spark, sf_dir) -> DataFrame:
    """Baseline predictions on clock hours, so that sensors share times."""
    return mt.naive_predictions(feature_rows(spark, sf_dir)).withColumn(
        "date", F.date_trunc("hour", "date")
    )


def pred_by_time(spark, sf_dir):
    by_time = mt.collapse_by_time(hourly_predictions(spark, sf_dir))
    return rounded(by_time, "actual_pm25", "predicted_pm25")


def pred_tail(spark, sf_dir):
    tail = mt.last_rows(mt.collapse_by_time(hourly_predictions(spark, sf_dir)), 200)
    return rounded(tail, "actual_pm25", "predicted_pm25")


# --- models -------------------------------------------------------------------------------


def lr_one_feature(spark, sf_dir):
    features = stored_features(spark, sf_dir)
    model = ml.fit(sp.time_split(features, required=SERIES_KEY).train, "lr", inputs=["lag_1"])
    return rounded(ml.score(model, features), "predicted_pm25")


def _scored(alias: str):
    def query(spark, sf_dir):
        features = stored_features(spark, sf_dir)
        model = ml.fit(sp.time_split(features, required=SERIES_KEY).train, alias)
        return rounded(ml.score(model, features), "predicted_pm25")

    return query


def _stumps(alias: str, **params):
    """Trees of one split over few-valued inputs, from all training rows: SQL can find these too."""

    def query(spark, sf_dir):
        features = stored_features(spark, sf_dir)
        train = sp.time_split(features, required=SERIES_KEY).train
        model = ml.fit(
            train, alias, STUMP_INPUTS, tree_sample=1.0, maxDepth=1, subsamplingRate=1.0, **params
        )
        return rounded(ml.score(model, features), "predicted_pm25")

    return query


def forecast_next_hour(spark, sf_dir):
    features = stored_features(spark, sf_dir)
    model = ml.fit(sp.time_split(features, required=SERIES_KEY).train, "lr")
    return rounded(ml.forecast_next_hour(features, model), "forecast_pm25")


# --- streams ------------------------------------------------------------------------------


def event_files(spark: SparkSession, sf_dir: str, batches: int = 3) -> DataFrame:
    """All events as a stream of several batches, each spread over the whole time.

    So every batch but the first brings rows that are older than some seen before.
    """
    path = scratch_dir(spark, "event-files")
    events = tb.read_table(configure(spark), f"{sf_dir}/events.parquet", EVENTS)
    share = F.pmod(F.xxhash64("event_id"), F.lit(batches)).cast("int")
    for part in range(batches):
        events.filter(share == part).write.mode("append").parquet(path)
    files = -(-len(spark.read.schema(EVENTS).parquet(path).inputFiles()) // batches)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    return _from_events(stream)


def _finish(query) -> None:
    query.awaitTermination()  # raises what the stream raised; the data decide how long it takes


def stream_hourly(spark, sf_dir):
    root = scratch_dir(spark, "stream-hourly")
    sink = bt.versioned_sink(f"{root}/out", partial=ag.window_partials, merge=ag.merged_partials)
    _finish(bt.start(event_files(spark, sf_dir), sink, f"{root}/checkpoint", once=True))
    partials = bt.read_versions(spark, f"{root}/out", ag.PARTIAL_MEANS)
    return rounded(ag.windowed_means(partials), "pm25")


def stream_dedup(spark, sf_dir):
    """Every event arrives twice."""
    root = scratch_dir(spark, "stream-dedup")
    twice = event_files(spark, sf_dir).union(event_files(spark, sf_dir, batches=2))
    sink = bt.versioned_sink(f"{root}/out", partial=ag.distinct_readings, merge=ag.distinct_readings)
    _finish(bt.start(twice, sink, f"{root}/checkpoint", once=True))
    return ag.distinct_readings(bt.read_versions(spark, f"{root}/out", rf.READING))


#: How events arrive: in batches of some days, some later than their batch, some twice.
BATCH_DAYS, WAIT_DAYS = 6, 8
ARRIVALS = "CASE event_id % 25 WHEN 3 THEN 3 WHEN 4 THEN 2 ELSE 0 END"


def arriving_files(spark: SparkSession, sf_dir: str, late: bool = True) -> DataFrame:
    """Events as a stream of batches in the order of time, each some files.

    With ``late``, some events come one or more batches after their own, and some come again.
    """
    events = tb.read_table(configure(spark), f"{sf_dir}/events.parquet", EVENTS)
    first = events.agg(F.min(F.unix_micros("ts"))).first()[0]
    day = F.floor((F.unix_micros("ts") - F.lit(first)) / (BATCH_DAYS * 86_400_000_000)).cast("int")
    rows = events.withColumn("batch", day)
    if late:
        again = rows.filter("event_id % 10 = 0").withColumn("batch", F.col("batch") + 1)
        rows = rows.withColumn("batch", F.col("batch") + F.expr(ARRIVALS)).unionByName(again)
    sizes = {r.batch: r.n for r in rows.groupBy("batch").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Every batch is as many files, so that the stream takes one after the other.
    files = max(1, min(min(sizes.values()) // 8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    path = scratch_dir(spark, "arriving")
    for batch in sorted(sizes):
        part = rows.filter(F.col("batch") == batch).drop("batch")
        (part.coalesce(1) if files == 1 else part.repartition(files)).write.mode("append").parquet(path)
    written = len(spark.read.schema(EVENTS).parquet(path).inputFiles())
    if written != files * len(sizes):
        raise ValueError(f"{written} files for {len(sizes)} batches of {files}")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files).parquet(path)
    return _from_events(stream)


def stream_unique(spark, sf_dir):
    """Copies within the watermark go, later ones are dropped: state is bounded."""
    root = scratch_dir(spark, "stream-unique")
    unique = et.unique_readings(arriving_files(spark, sf_dir), f"{WAIT_DAYS} days")
    rows = unique.select(*SERIES_KEY, "pm25")
    _finish(bt.start(rows, bt.versioned_sink(f"{root}/out"), f"{root}/checkpoint", once=True))
    return bt.read_versions(spark, f"{root}/out", rf.READING).drop(bt.VERSION)


def stream_final_windows(spark, sf_dir):
    """Daily means, each emitted once, when the watermark has passed."""
    root = scratch_dir(spark, "stream-final")
    windows = et.final_windows(arriving_files(spark, sf_dir), "1 day", f"{WAIT_DAYS} days")
    _finish(bt.start(windows, bt.versioned_sink(f"{root}/out"), f"{root}/checkpoint", once=True))
    schema = "sensor_id string, datetime timestamp, pm25 double, n long"
    return rounded(bt.read_versions(spark, f"{root}/out", schema).drop(bt.VERSION), "pm25")


def stream_cursor(spark, sf_dir):
    """Event time, watermark and late rows of every batch, as the progress of the stream tells."""
    root = scratch_dir(spark, "stream-cursor")
    rows = et.unique_readings(arriving_files(spark, sf_dir), f"{WAIT_DAYS} days")
    query = bt.start(rows, bt.versioned_sink(f"{root}/out"), f"{root}/checkpoint", once=True)
    _finish(query)
    log = et.CursorLog(spark, f"{root}/cursor")
    for progress in query.recentProgress:
        log.write(json.loads(progress.json))
    made = et.read_cursor(spark, f"{root}/cursor").filter("n_rows > 0")
    order = Window.orderBy("batch_id")  # a row per batch
    return made.select(
        (F.row_number().over(order) - 1).cast("long").alias("batch"), "n_rows", "earliest", "latest", "watermark", "n_late"
    )


def stream_held_back(spark, sf_dir):
    """The refresh's own cursor: readings of the last days wait until later ones have come."""
    root = scratch_dir(spark, "stream-held")
    stream = arriving_files(spark, sf_dir)
    handle = rf.refresh_tables(root, lag_hours=24 * WAIT_DAYS, clock=rf.event_clock)
    _finish(bt.start(stream, handle, f"{root}/checkpoint", once=True))
    return rf.cursor(spark, root)


def stream_state_lags(spark, sf_dir):
    """Lags from per-sensor state, of batches in time order."""
    root = scratch_dir(spark, "stream-state")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", et.ROCKSDB)
    try:
        stream = et.lags_in_state(arriving_files(spark, sf_dir, late=False), f"{WAIT_DAYS} days")
        _finish(bt.start(stream, bt.versioned_sink(f"{root}/out"), f"{root}/checkpoint", once=True))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    fields = ", ".join(f"{c} double" for c in LAG_COLUMNS)
    lagged = bt.read_versions(spark, f"{root}/out", f"{rf.READING}, late boolean, {fields}")
    return et.state_features(lagged)


def stream_lags(spark, sf_dir):
    root = scratch_dir(spark, "stream-lags")
    stream = cl.clean(event_files(spark, sf_dir).withColumn("parameter", F.lit("pm25")))
    _finish(bt.start(stream, rf.refresh_tables(root), f"{root}/checkpoint", once=True))
    return rf.current_features(spark, root).drop("interval_used")


# --- contract -----------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Clean readings with calendar columns and 24 lags."""
    return feature_rows(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return sensor_queries() | (CORPUS.QUERIES | {"pipeline": PIPELINE.run} if CORPUS else {})


_ARRIVING = f"""base AS (
    SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, ts AS datetime, value AS pm25,
           CAST(floor((epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events))
                      / ({BATCH_DAYS} * 86400000000)) AS INTEGER) AS day FROM events),
  arriving AS (
    SELECT sensor_id, datetime, pm25, day + ({ARRIVALS}) AS batch FROM base
    UNION ALL SELECT sensor_id, datetime, pm25, day + 1 FROM base WHERE event_id % 10 = 0),
  marks AS (
    SELECT batch, mark AS next_mark, lag(mark) OVER (ORDER BY batch) AS watermark,
           lag(mark, 2) OVER (ORDER BY batch) AS late_mark  -- rows are late by the batch before
    FROM (
      SELECT batch, max(date_trunc('milliseconds', max(datetime))) OVER (ORDER BY batch)
                    - INTERVAL {WAIT_DAYS} DAY AS mark
      FROM arriving GROUP BY batch))"""


def oracle_sql() -> dict[str, str]:
    if not CORPUS:
        return sensor_sql()
    pipeline = {"pipeline": PIPELINE.ORACLE_SQL} if PIPELINE.ORACLE_SQL else {}
    return sensor_sql() | CORPUS_SQL.ORACLE | pipeline


def sensor_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "clean_readings": clean_readings,
        "hourly_calendar": hourly_calendar,
        "ordered_readings": ordered_readings,
        "preview_head": preview_head,
        "time_range": time_range,
        "sensor_subset": sensor_subset,
        "dedup_readings": dedup_readings,
        "hourly_resample": hourly_resample,
        "latest_time": latest_time,
        "hourly_or_daily": hourly_or_daily,
        "raw_json_roundtrip": raw_json_roundtrip,
        "raw_json_stream": raw_json_stream,
        "normalize_readings": normalize_readings,
        "envelope_check": envelope_check,
        "union_sources": union_sources,
        "ingest_totals": ingest_totals,
        "stage_counts": stage_counts,
        "utc_iso": utc_iso_times,
        "daily_trend": daily_trend,
        "daily_trend_by_sensor": daily_trend_by_sensor,
        "weekday_stats": weekday_stats,
        "weekday_labels": weekday_labels,
        "weekly_trend": weekly_trend,
        "weekly_trend_iso": weekly_trend_iso,
        "year_week_label": year_week_labels,
        "yearly_monthly": yearly_monthly,
        "yearly_summary": yearly_summary,
        "distinct_years": distinct_years,
        "lag_features": feature_rows,
        "latest_per_sensor": latest_per_sensor,
        "next_hour_features": next_hour_features,
        "gap_report": gap_report,
        "lag_by_time": lag_by_time,
        "time_split": time_split,
        "split_report": split_report,
        "hash_sample": hash_sample,
        "naive_predictions": naive_predictions,
        "naive_metrics": naive_metrics,
        "best_model": best_model,
        "metrics_upsert": metrics_upsert,
        "pred_by_time": pred_by_time,
        "pred_tail": pred_tail,
        "lr_one_feature": lr_one_feature,
        "ml_scored": _scored("lr"),
        "rf_stump": _stumps("rf", numTrees=1, bootstrap=False, featureSubsetStrategy="all"),
        "gbt_stumps": _stumps("gbt", maxIter=2, stepSize=STUMP_STEP),
        "rf_scored": _scored("rf"),
        "gbt_scored": _scored("gbt"),
        "forecast_next_hour": forecast_next_hour,
        "stream_hourly": stream_hourly,
        "stream_dedup": stream_dedup,
        "stream_lags": stream_lags,
        "stream_unique": stream_unique,
        "stream_final_windows": stream_final_windows,
        "stream_cursor": stream_cursor,
        "stream_held_back": stream_held_back,
        "stream_state_lags": stream_state_lags,
    }


# --- SQL for the same results -------------------------------------------------------------

_LAGS = ", ".join(LAG_COLUMNS)
_READINGS = """readings AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS sensor_id, ts AS datetime, value AS pm25,
         event_type AS parameter
  FROM events)"""
_CLEAN = f"""{_READINGS}, clean AS (
  SELECT sensor_id, datetime, pm25 FROM readings
  WHERE pm25 IS NOT NULL AND NOT isnan(pm25) AND pm25 > 0 AND datetime IS NOT NULL)"""
_FAULTY = f"""{_READINGS}, faulty AS (
  SELECT sensor_id,
         CASE WHEN event_id % 73 <> 0 THEN datetime END AS datetime,
         CASE WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN CAST('NaN' AS DOUBLE)
              WHEN event_id % 83 = 0 THEN -999.0
              WHEN event_id % 79 = 0 THEN 0.0
              ELSE pm25 END AS pm25,
         CASE WHEN event_id % 5 = 0 THEN 'no2' ELSE 'pm25' END AS parameter
  FROM readings), kept AS (
  SELECT sensor_id, datetime, pm25 FROM faulty
  WHERE parameter = 'pm25' AND pm25 IS NOT NULL AND NOT isnan(pm25) AND pm25 > 0
    AND pm25 <> -999 AND datetime IS NOT NULL)"""
_CALENDAR = """CAST(hour(datetime) AS INTEGER) AS hour,
         CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week,
         CAST(month(datetime) AS INTEGER) AS month"""
_LAG_EXPRESSIONS = ", ".join(
    f"lag(pm25, {i}) OVER (PARTITION BY sensor_id ORDER BY datetime) AS lag_{i}"
    for i in range(1, 25)
)
_FEATURES = f"""{_CLEAN}, features AS (
  SELECT * FROM (
    SELECT sensor_id, datetime, pm25, {_CALENDAR}, {_LAG_EXPRESSIONS}
    FROM (SELECT sensor_id, datetime, max(pm25) AS pm25 FROM clean GROUP BY ALL))
  WHERE lag_24 IS NOT NULL)"""
_CUT = f"""{_FEATURES}, cut AS (
  SELECT datetime AS cut_time FROM (
    SELECT datetime, row_number() OVER (ORDER BY datetime) AS position FROM features)
  WHERE position = (SELECT CAST(floor(count(*) * 0.8) AS BIGINT) + 1 FROM features))"""
_ORDER_DAYS = """days AS (
  SELECT CAST(o_orderdate AS DATE) AS date, avg(o_totalprice) AS pm25_avg
  FROM orders GROUP BY 1)"""


_INPUTS = CALENDAR_COLUMNS + LAG_COLUMNS
_N = len(_INPUTS)


def _gram_row(column: str) -> str:
    """Row of the ridge system in standard units; a constant input takes no part."""
    cells = [
        "1 + 0.1 / stddev_pop(pm25)"
        if other == column
        else f"coalesce(covar_pop({column}, {other}) / nullif(stddev_pop({column}) * "
        f"stddev_pop({other}), 0), 0)"
        for other in [*_INPUTS, "pm25"]
    ]
    return "[" + ", ".join(cells) + "]"


# Ridge regression on all inputs: Gauss-Jordan elimination, one column per step.
_RIDGE = f"""{_CUT}, train AS (SELECT * FROM features WHERE datetime < (SELECT cut_time FROM cut)),
  solved AS (
    SELECT 1 AS k, [{", ".join(_gram_row(c) for c in _INPUTS)}] AS m FROM train
    UNION ALL
    SELECT k + 1,
           [CASE WHEN i = k THEN [x / m[k][k] for x in m[k]]
                 ELSE [m[i][j] - m[i][k] * m[k][j] / m[k][k] for j in range(1, {_N + 2})]
            END for i in range(1, {_N + 1})]
    FROM solved WHERE k <= {_N}),
  fitted AS (
    SELECT {", ".join(f"coalesce(w[{i}] * sy / nullif(s_{c}, 0), 0) AS b_{c}, m_{c}"
                      for i, c in enumerate(_INPUTS, 1))}, my
    FROM (SELECT [m[i][{_N + 1}] for i in range(1, {_N + 1})] AS w
          FROM solved WHERE k = {_N + 1}),
         (SELECT {", ".join(f"stddev_pop({c}) AS s_{c}, avg({c}) AS m_{c}" for c in _INPUTS)},
                 stddev_pop(pm25) AS sy, avg(pm25) AS my FROM train))"""
_RIDGE_VALUE = "my + " + " + ".join(f"b_{c} * ({c} - m_{c})" for c in _INPUTS)
_NEXT_HOUR = f"""newest AS (
  SELECT sensor_id, datetime + INTERVAL 1 HOUR AS datetime, pm25, {_LAGS}
  FROM features
  QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY datetime DESC) = 1),
  upcoming AS (
  SELECT sensor_id, datetime, pm25 AS last_pm25, {_CALENDAR}, pm25 AS lag_1,
         {", ".join(f"lag_{i - 1} AS lag_{i}" for i in range(2, 25))}
  FROM newest)"""


def _metrics(model: str, predicted: str, source: str) -> str:
    return f"""SELECT '{model}' AS model,
         round(sqrt(avg((pm25 - p) * (pm25 - p))) + 1e-9, 6) AS rmse,
         round(avg(abs(pm25 - p)) + 1e-9, 6) AS mae,
         round(1 - sum((pm25 - p) * (pm25 - p)) / (var_pop(pm25) * count(*)) + 1e-9, 6) AS r2
  FROM (SELECT pm25, {predicted} AS p FROM {source})"""




def _stump(name: str, rows: str, label: str) -> str:
    """CTEs for the one split that leaves the least variance, and the mean on either side of it."""
    values = " UNION ALL ".join(
        f"SELECT '{c}' AS input, {c} AS v, count(*) AS n, sum({label}) AS s FROM {rows} GROUP BY ALL"
        for c in STUMP_INPUTS
    )
    side = "CASE input " + " ".join(f"WHEN '{c}' THEN {c}" for c in STUMP_INPUTS) + " END"
    return f"""{name}_sums AS (
      SELECT input, v, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
             sum(n) OVER (PARTITION BY input) AS n, sum(s) OVER (PARTITION BY input) AS s
      FROM ({values}) WINDOW w AS (PARTITION BY input ORDER BY v)),
    {name}_best AS (
      SELECT input, v, sl / nl AS low, (s - sl) / (n - nl) AS high FROM {name}_sums WHERE nl < n
      ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, input, v LIMIT 1),
    {name} AS (
      SELECT features.*, CASE WHEN {side} <= v THEN low ELSE high END AS {name}_value
      FROM features, {name}_best)"""


# A boosting round fits twice the residuals, the gradient of the squared error.
_STUMPS = f"""{_CUT}, first_train AS (
    SELECT * FROM features WHERE datetime < (SELECT cut_time FROM cut)), {_stump("first", "first_train", "pm25")},
  rest AS (
    SELECT *, 2 * (pm25 - first_value) AS residual FROM first
    WHERE datetime < (SELECT cut_time FROM cut)), {_stump("second", "rest", "residual")}"""
_TRAIN = "features WHERE datetime < (SELECT cut_time FROM cut)"
_TEST = "features WHERE datetime >= (SELECT cut_time FROM cut)"
_MEAN_OF_DAY = "(" + " + ".join(LAG_COLUMNS) + ") / 24"
_BY_TIME = f"""{_FEATURES}, by_time AS (
  SELECT date_trunc('hour', datetime) AS date, round(avg(pm25) + 1e-9, 6) AS actual_pm25,
         round(avg(lag_1) + 1e-9, 6) AS predicted_pm25
  FROM features GROUP BY 1)"""


def sensor_sql() -> dict[str, str]:
    return {
        "clean_readings": f"WITH {_FAULTY} SELECT * FROM kept",
        "hourly_calendar": f"WITH {_CLEAN} SELECT sensor_id, datetime, {_CALENDAR}, pm25 FROM clean",
        "ordered_readings": f"""WITH {_CLEAN}
            SELECT sensor_id, datetime, {_CALENDAR}, pm25 FROM clean
            ORDER BY sensor_id, datetime""",
        "preview_head": f"""WITH {_CLEAN}
            SELECT sensor_id, datetime, {_CALENDAR}, pm25 FROM clean
            ORDER BY sensor_id, datetime LIMIT 50""",
        "time_range": f"""WITH {_CLEAN} SELECT * FROM clean
            WHERE datetime BETWEEN TIMESTAMP '2024-01-10 00:00:00'
                               AND TIMESTAMP '2024-01-12 12:00:00'""",
        "sensor_subset": f"WITH {_CLEAN} SELECT * FROM clean WHERE sensor_id IN ('1', '7', '12')",
        "dedup_readings": f"""WITH {_READINGS}
            SELECT sensor_id, datetime,
                   max(pm25 + CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END) AS pm25, 2 AS pull
            FROM readings GROUP BY sensor_id, datetime""",
        "hourly_resample": f"""WITH {_CLEAN}
            SELECT sensor_id, date_trunc('hour', datetime) AS datetime,
                   round(avg(pm25) + 1e-9, 6) AS pm25, count(*) AS n
            FROM clean GROUP BY 1, 2""",
        "latest_time": "SELECT max(ts) AS latest FROM events",
        "hourly_or_daily": f"""WITH {_CLEAN}, bound AS (
              SELECT max(datetime) - INTERVAL 24 HOUR AS until FROM clean),
            hours AS (
              SELECT sensor_id, date_trunc('hour', datetime) AS datetime, avg(pm25) AS pm25
              FROM clean GROUP BY 1, 2),
            days AS (
              SELECT sensor_id, date_trunc('day', datetime) AS datetime, avg(pm25) AS pm25
              FROM clean GROUP BY 1, 2),
            recent AS (
              SELECT hours.* FROM hours, bound
              WHERE datetime BETWEEN until - INTERVAL 24 HOUR AND until)
            SELECT sensor_id, CAST(datetime AS TIMESTAMP) AS datetime, round(pm25 + 1e-9, 6) AS pm25,
                   'hourly' AS interval_used FROM recent
            UNION ALL
            SELECT sensor_id, CAST(datetime AS TIMESTAMP), round(pm25 + 1e-9, 6), 'daily'
            FROM days, bound
            WHERE datetime BETWEEN until - INTERVAL 30 DAY AND until
              AND sensor_id NOT IN (SELECT sensor_id FROM recent)""",
        "raw_json_roundtrip": f"""WITH {_READINGS}
            SELECT pm25, date_trunc('second', datetime) AS datetime, parameter,
                   'hourly' AS period_label, sensor_id
            FROM readings""",
        "raw_json_stream": f"""WITH {_READINGS}
            SELECT pm25, date_trunc('second', datetime) AS datetime, parameter,
                   'hourly' AS period_label, sensor_id
            FROM readings""",
        "normalize_readings": f"""WITH {_READINGS}, one AS (
              SELECT pm25,
                     CASE WHEN event_id % 53 <> 0 AND event_id % 59 <> 0
                          THEN date_trunc('second', datetime) END AS datetime,
                     parameter, '1hour' AS period_label, sensor_id
              FROM readings)
            SELECT * FROM one UNION ALL SELECT * FROM one""",
        "envelope_check": f"""WITH {_READINGS}
            SELECT sensor_id, count(*) AS missing FROM readings WHERE NOT pm25 >= 10
            GROUP BY sensor_id""",
        "union_sources": f"""WITH {_READINGS}
            SELECT sensor_id, datetime, pm25, parameter, NULL AS priority FROM readings
            UNION ALL
            SELECT CAST(o_custkey AS VARCHAR), o_orderdate, o_totalprice, NULL, o_orderpriority
            FROM orders""",
        "ingest_totals": """SELECT count(DISTINCT user_id) AS n_sensors, count(*) AS n_records,
                   count(DISTINCT (user_id, date_trunc('month', ts))) AS n_files
            FROM events""",
        "stage_counts": f"""WITH {_FAULTY}
            SELECT 'raw' AS stage, count(*) AS n FROM faulty
            UNION ALL SELECT 'clean', count(*) FROM kept
            UNION ALL SELECT 'features', CAST(sum(greatest(n - 24, 0)) AS BIGINT)
            FROM (SELECT count(*) AS n FROM kept GROUP BY sensor_id)""",
        "utc_iso": """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
                   strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso_text,
                   date_trunc('second', ts) AS parsed
            FROM events""",
        "daily_trend": f"""WITH {_CLEAN}, days AS (
              SELECT CAST(datetime AS DATE) AS date, avg(pm25) AS pm25_avg, count(*) AS n
              FROM clean GROUP BY 1)
            SELECT CAST(date AS VARCHAR) AS date, round(pm25_avg + 1e-9, 6) AS pm25_avg, n,
                   round(avg(pm25_avg) OVER (
                     ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 1e-9, 6) AS pm25_avg_7d
            FROM days""",
        "daily_trend_by_sensor": f"""WITH {_CLEAN}, days AS (
              SELECT sensor_id, CAST(datetime AS DATE) AS date, avg(pm25) AS pm25_avg,
                     count(*) AS n
              FROM clean GROUP BY 1, 2)
            SELECT sensor_id, CAST(date AS VARCHAR) AS date, round(pm25_avg + 1e-9, 6) AS pm25_avg, n,
                   round(avg(pm25_avg) OVER (
                     PARTITION BY sensor_id ORDER BY date
                     ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) + 1e-9, 6) AS pm25_avg_7d
            FROM days""",
        "weekday_stats": f"""WITH {_CLEAN}
            SELECT CAST(dayofweek(datetime) + 1 AS INTEGER) AS day_of_week, count(*) AS n,
                   round(avg(pm25) + 1e-9, 6) AS pm25_avg, quantile_disc(pm25, 0.5) AS pm25_median,
                   min(pm25) AS pm25_min, max(pm25) AS pm25_max
            FROM clean GROUP BY 1""",
        "weekday_labels": """SELECT weekday, count(*) AS n FROM (
              SELECT CASE WHEN event_id % 10 = 0 THEN '8' ELSE strftime(ts, '%a') END AS weekday
              FROM events) GROUP BY 1""",
        "weekly_trend": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year,
                   CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
                   round(avg(o_totalprice) + 1e-9, 6) AS pm25_avg, count(*) AS n
            FROM orders GROUP BY 1, 2""",
        "weekly_trend_iso": """SELECT CAST(isoyear(o_orderdate) AS INTEGER) AS year,
                   CAST(weekofyear(o_orderdate) AS INTEGER) AS week_of_year,
                   round(avg(o_totalprice) + 1e-9, 6) AS pm25_avg, count(*) AS n
            FROM orders GROUP BY 1, 2""",
        "year_week_label": """SELECT CAST(year(o_orderdate) AS VARCHAR) || '-' ||
                   lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS year_week,
                   count(*) AS n
            FROM orders GROUP BY 1""",
        "yearly_monthly": f"""WITH {_ORDER_DAYS}
            SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
                   round(avg(pm25_avg) + 1e-9, 6) AS pm25_avg
            FROM days WHERE year(date) = (SELECT max(year(date)) FROM days) GROUP BY 1, 2""",
        "yearly_summary": f"""WITH {_ORDER_DAYS}
            SELECT CAST(year(date) AS INTEGER) AS year, round(avg(pm25_avg) + 1e-9, 6) AS year_avg,
                   round(max(pm25_avg) + 1e-9, 6) AS year_max, round(min(pm25_avg) + 1e-9, 6) AS year_min
            FROM days GROUP BY 1""",
        "distinct_years": "SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders",
        "lag_features": f"WITH {_FEATURES} SELECT * FROM features",
        "latest_per_sensor": f"""WITH {_CLEAN}
            SELECT sensor_id, datetime, {_CALENDAR}, pm25 FROM clean
            QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY datetime DESC, pm25 DESC) = 1""",
        "next_hour_features": f"WITH {_FEATURES}, {_NEXT_HOUR} SELECT * FROM upcoming",
        "lag_by_time": f"""WITH {_CLEAN}, hours AS (
              SELECT sensor_id, date_trunc('hour', datetime) AS datetime, avg(pm25) AS pm25
              FROM clean GROUP BY 1, 2)
            SELECT h.sensor_id, h.datetime, round(h.pm25 + 1e-9, 6) AS pm25,
                   round(a.pm25 + 1e-9, 6) AS pm25_1h_ago, round(b.pm25 + 1e-9, 6) AS pm25_24h_ago
            FROM hours h
            LEFT JOIN hours a ON a.sensor_id = h.sensor_id AND a.datetime = h.datetime - INTERVAL 1 HOUR
            LEFT JOIN hours b ON b.sensor_id = h.sensor_id AND b.datetime = h.datetime - INTERVAL 24 HOUR""",
        "gap_report": f"""WITH {_CLEAN}, gaps AS (
              SELECT sensor_id, datetime,
                     lag(datetime) OVER (PARTITION BY sensor_id ORDER BY datetime) AS previous
              FROM clean)
            SELECT sensor_id, datetime, previous,
                   round((epoch_us(datetime) - epoch_us(previous)) / 3600000000.0 + 1e-9, 6) AS gap_hours
            FROM gaps WHERE epoch_us(datetime) - epoch_us(previous) > 24 * 3600000000""",
        "time_split": f"""WITH {_CUT}
            SELECT sensor_id, datetime,
                   CASE WHEN datetime < (SELECT cut_time FROM cut) THEN 'train' ELSE 'test' END AS side
            FROM features""",
        "split_report": f"""WITH {_CUT}, sides AS (
              SELECT CASE WHEN datetime < (SELECT cut_time FROM cut) THEN 'train' ELSE 'test' END
                       AS side, datetime
              FROM features)
            SELECT side, count(*) AS n,
                   round(count(*) * 100.0 / (SELECT count(*) FROM sides), 1) AS pct,
                   min(datetime) AS first_time, max(datetime) AS last_time
            FROM sides GROUP BY side""",
        "hash_sample": f"""WITH {_CLEAN} SELECT * FROM clean
            WHERE CAST('0x' || substr(md5('42|' || sensor_id || '|' || epoch_us(datetime)), 1, 8)
                       AS BIGINT) < CAST(floor(0.3 * 4294967296) AS BIGINT)""",
        "naive_predictions": f"""WITH {_FEATURES}
            SELECT sensor_id, datetime AS date, pm25 AS actual_pm25, lag_1 AS predicted_pm25
            FROM features""",
        "naive_metrics": f"""WITH {_CUT} {_metrics("persistence", "lag_1", _TEST)}
            UNION ALL {_metrics("previous_day", "lag_24", _TEST)}""",
        "best_model": f"""WITH {_FEATURES} SELECT * FROM (
            {_metrics("persistence", "lag_1", "features")}
            UNION ALL {_metrics("previous_day", "lag_24", "features")})
            ORDER BY r2 DESC, model LIMIT 1""",
        "metrics_upsert": f"""WITH {_CUT} {_metrics("persistence", "lag_1", _TRAIN)}
            UNION ALL {_metrics("previous_day", "lag_24", _TEST)}
            UNION ALL {_metrics("mean_of_day", _MEAN_OF_DAY, _TEST)}""",
        "pred_by_time": f"WITH {_BY_TIME} SELECT * FROM by_time",
        "pred_tail": f"WITH {_BY_TIME} SELECT * FROM by_time ORDER BY date DESC LIMIT 200",
        "lr_one_feature": f"""WITH {_CUT}, moments AS (
              SELECT covar_pop(pm25, lag_1)
                       / (var_pop(lag_1) * (1 + 0.1 / stddev_pop(pm25))) AS slope,
                     avg(pm25) AS mean_y, avg(lag_1) AS mean_x
              FROM {_TRAIN})
            SELECT sensor_id, datetime AS date, pm25 AS actual_pm25,
                   round(mean_y + slope * (lag_1 - mean_x) + 1e-9, 6) AS predicted_pm25
            FROM features, moments""",
        "rf_stump": f"""WITH {_STUMPS}
            SELECT sensor_id, datetime AS date, pm25 AS actual_pm25,
                   round(first_value + 1e-9, 6) AS predicted_pm25
            FROM first""",
        "gbt_stumps": f"""WITH {_STUMPS}
            SELECT first.sensor_id, first.datetime AS date, first.pm25 AS actual_pm25,
                   round(first_value + {STUMP_STEP} * second_value + 1e-9, 6) AS predicted_pm25
            FROM first JOIN second USING (sensor_id, datetime)""",
        "ml_scored": f"""WITH RECURSIVE {_RIDGE}
            SELECT sensor_id, datetime AS date, pm25 AS actual_pm25,
                   round({_RIDGE_VALUE} + 1e-9, 6) AS predicted_pm25
            FROM features, fitted""",
        "forecast_next_hour": f"""WITH RECURSIVE {_RIDGE}, {_NEXT_HOUR}
            SELECT sensor_id, datetime, last_pm25,
                   round({_RIDGE_VALUE} + 1e-9, 6) AS forecast_pm25
            FROM upcoming, fitted""",
        "stream_hourly": f"""WITH {_READINGS}
            SELECT sensor_id, date_trunc('hour', datetime) AS datetime,
                   round(avg(pm25) + 1e-9, 6) AS pm25, count(*) AS n
            FROM readings GROUP BY 1, 2""",
        "stream_dedup": f"""WITH {_READINGS}
            SELECT sensor_id, datetime, max(pm25) AS pm25 FROM readings GROUP BY 1, 2""",
        "stream_lags": f"WITH {_FEATURES} SELECT * FROM features",
        "stream_state_lags": f"WITH {_FEATURES} SELECT * FROM features",
        "stream_unique": f"""WITH {_ARRIVING}
            SELECT DISTINCT sensor_id, datetime, pm25 FROM arriving JOIN marks USING (batch)
            WHERE late_mark IS NULL OR datetime > late_mark""",
        "stream_final_windows": f"""WITH {_ARRIVING},
            days AS (SELECT *, date_trunc('day', datetime) AS day FROM arriving JOIN marks USING (batch))
            SELECT sensor_id, day AS datetime, round(avg(pm25) + 1e-9, 6) AS pm25, count(*) AS n
            FROM days
            WHERE (late_mark IS NULL OR day + INTERVAL 1 DAY > late_mark)
              AND day + INTERVAL 1 DAY <= (SELECT max(next_mark) FROM marks)
            GROUP BY 1, 2""",
        "stream_cursor": f"""WITH {_ARRIVING}
            SELECT CAST(batch AS BIGINT) AS batch, count(*) AS n_rows,
                   date_trunc('milliseconds', min(datetime)) AS earliest,
                   date_trunc('milliseconds', max(datetime)) AS latest,
                   coalesce(any_value(watermark), TIMESTAMP '1970-01-01') AS watermark,
                   count(*) FILTER (WHERE datetime <= late_mark) AS n_late
            FROM arriving JOIN marks USING (batch) GROUP BY batch""",
        "stream_held_back": f"""WITH {_ARRIVING},
            seen AS (SELECT batch, count(*) AS n_rows, max(max(datetime)) OVER (ORDER BY batch) AS latest
                     FROM arriving GROUP BY batch),
            keys AS (SELECT sensor_id, datetime, batch FROM arriving),
            taken AS (SELECT DISTINCT sensor_id, datetime, (SELECT min(s.batch) FROM seen s
                        WHERE s.batch >= k.batch AND k.datetime <= s.latest - INTERVAL {WAIT_DAYS} DAY) AS taken_in, batch
                      FROM keys k)
            SELECT CAST(s.batch AS BIGINT) AS batch, s.n_rows,
                   (SELECT count(DISTINCT (sensor_id, datetime)) FROM taken WHERE taken_in = s.batch) AS n_taken,
                   (SELECT count(DISTINCT (sensor_id, datetime)) FROM taken
                    WHERE batch <= s.batch AND (taken_in IS NULL OR taken_in > s.batch)) AS n_held,
                   s.latest, s.latest + INTERVAL 1 SECOND AS cursor
            FROM seen s""",
    }
