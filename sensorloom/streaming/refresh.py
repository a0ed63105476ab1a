"""Keep clean, feature and prediction tables fresh from landed documents.

Each micro-batch is handled with batch operators, so long series are cut as in batch. The
last readings of every sensor (the carry) are kept beside the tables, so a batch that only
moves forward in time never reads the history. A sensor that received a late or repeated
reading is recomputed from that reading on, from the days before it alone. Tables are versioned
(``sources.snapshots``), their folders partitioned by day.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators.series import ROWS_PER_TASK, over_history
from sensorloom.plans.models import score
from sensorloom.schemas import CALENDAR_COLUMNS, LAG_COLUMNS, LAGS, SERIES_KEY
from sensorloom.session import configure, scratch_scope, stored
from sensorloom.sources import raw as rw
from sensorloom.sources.snapshots import Manifest, Snapshots
from sensorloom.sources.tables import counted, delete_path
from sensorloom.streaming import batches as bt

READING = "sensor_id string, datetime timestamp, pm25 double"
#: How far back a late reading's sensor is read: first this, then that, then all.
LOOKBACK_DAYS = (7, 100)
FEATURE = ", ".join(
    [READING, *[f"{c} int" for c in CALENDAR_COLUMNS], *[f"{c} double" for c in LAG_COLUMNS]]
)
PREDICTION = "sensor_id string, date timestamp, actual_pm25 double, predicted_pm25 double"
DAY = "day"
#: Columns and keys of the tables; a row's newest version counts.
TABLES = {
    "clean": (READING, SERIES_KEY),
    "features": (FEATURE, SERIES_KEY),
    "predictions": (PREDICTION, ["sensor_id", "date"]),
}

#: Daily readings have tables of their own here; they count for sensors without hourly ones.
DAILY = "daily"
#: Documents that don't parse have a table of their own here.
DOCUMENTS = "documents"
UNREADABLE = "file_name string, sensor_id string, _corrupt string"
#: How far event time had come after each batch, how many rows it took and how many wait.
PROGRESS = "batch long, n_rows long, n_taken long, n_held long, latest timestamp, cursor timestamp"
#: From the newest event time so far (null before any) to the time that counts as now.
Clock = Callable[[dt.datetime | None], dt.datetime | None]


def wall_clock(latest: dt.datetime | None) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def event_clock(latest: dt.datetime | None) -> dt.datetime | None:
    """The newest reading says what time it is: results don't depend on when the stream runs."""
    return latest


def _by_day(df: DataFrame, time: str = "datetime") -> DataFrame:
    return df.withColumn(DAY, F.to_date(time))


def _days(df: DataFrame, start: str | None, end: str | None) -> DataFrame:
    """Only the days from ``start`` to ``end``, chosen by folder."""
    if start:
        df = df.filter(F.col(DAY) >= F.to_date(F.lit(start)))
    if end:
        df = df.filter(F.col(DAY) <= F.to_date(F.lit(end)))
    return df


def _newest(tables: Snapshots, table: str, start: str | None = None, end: str | None = None) -> DataFrame:
    schema, keys = TABLES[table]
    rows = _days(tables.read(table, f"{schema}, {DAY} date"), start, end)
    return bt.newest(rows.drop(DAY), keys)


def _current(
    spark: SparkSession, root: str, table: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The newest rows of hourly series, and of daily series whose sensor has no hourly reading."""
    hourly, daily = Snapshots(spark, root), Snapshots(spark, f"{root}/{DAILY}")
    rows = _newest(hourly, table, start, end)
    if not daily.current().tables.get("clean"):
        return rows.withColumn("interval_used", F.lit("hourly"))
    covered = hourly.read("clean", f"{READING}, {DAY} date")
    return cl.prefer_hourly(rows, _newest(daily, table, start, end), covered)


def current_readings(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Readings in force; of the days from ``start`` to ``end`` only, if given."""
    return _current(spark, root, "clean", start, end)


def current_features(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    return _current(spark, root, "features", start, end)


def current_predictions(
    spark: SparkSession, root: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    return _current(spark, root, "predictions", start, end)


def cursor(spark: SparkSession, root: str) -> DataFrame:
    """One row per batch: rows it brought, took and left waiting, newest time, where to read on."""
    return Snapshots(spark, root).read("progress", PROGRESS).drop(bt.VERSION)


def unreadable(spark: SparkSession, root: str) -> DataFrame:
    """Landed documents that did not parse, as ``etl`` keeps them."""
    return Snapshots(spark, f"{root}/{DOCUMENTS}").read("unreadable", UNREADABLE).drop(bt.VERSION)


def _forward_features(new: DataFrame, carry: DataFrame, rows_per_task: int) -> DataFrame:
    """Features of rows that all lie after the carried rows of their sensor."""
    known = F.col("known")
    rows = cl.hourly(new).withColumn("known", F.lit(False))
    rows = rows.unionByName(cl.hourly(carry).withColumn("known", F.lit(True)))
    lagged = over_history(
        rows, LAGS, ft.lag_columns, values=["pm25"], rows_per_task=rows_per_task
    )
    return ft.complete_features(lagged.filter(~known))


def _recent(history: DataFrame, late: DataFrame, since: int | None) -> DataFrame:
    """Newest readings of the late sensors since a time (microseconds), or from the beginning.

    The time chooses days, so folders of earlier ones are not opened.
    """
    if since is not None:
        start = F.timestamp_micros(F.lit(since))
        history = history.filter((F.col(DAY) >= F.to_date(start)) & (F.col("datetime") >= start))
    rows = history.drop(DAY).join(late.select("sensor_id"), "sensor_id", "left_semi")
    return stored(bt.newest(rows, SERIES_KEY), "recent")


def _first_day(history: DataFrame) -> dt.date:
    """The earliest day that has a folder; no file is read."""
    days = re.findall(rf"/{DAY}=(\d+-\d\d-\d\d)/", "\n".join(history.inputFiles()))
    return dt.date.fromisoformat(min(days))


def _redone_features(history: DataFrame, late: DataFrame, first: int, rows_per_task: int) -> DataFrame:
    """Features of the late sensors from their first new reading on (``first`` of all of them).

    The scan goes back some days from there. A sensor that has too few readings in that time is
    read further back, at last from its beginning.
    """
    begins = dt.datetime.combine(_first_day(history), dt.time(), dt.timezone.utc).timestamp() * 1e6
    found, short = [], late
    for days in (*LOOKBACK_DAYS, None):
        since = None if days is None or first - days * 86_400_000_000 <= begins else first - days * 86_400_000_000
        rows = _recent(history, short, since)
        if since is None:
            found.append(rows)
            break
        earlier = rows.join(short, "sensor_id").filter(F.col("datetime") < F.col("first_new"))
        supply = earlier.groupBy("sensor_id").agg(F.count(F.lit(1)).alias("n"))
        supply = short.join(supply, "sensor_id", "left").withColumn("enough", F.coalesce("n", F.lit(0)) >= LAGS)
        supply = stored(supply.drop("n"), "supply")
        found.append(rows.join(supply.filter("enough").select("sensor_id"), "sensor_id", "left_semi"))
        short = supply.filter("NOT enough").drop("enough")
        if short.isEmpty():
            break
    redone = ft.lag_features(cl.hourly(rw.union_sources(found)), rows_per_task=rows_per_task)
    redone = redone.join(late, "sensor_id").filter(F.col("datetime") >= F.col("first_new"))
    return redone.drop("first_new")


def _carry_on(carry: DataFrame, new: DataFrame) -> DataFrame:
    """The last readings of every sensor, those of ``new`` in place of older ones."""
    versioned = carry.withColumn(bt.VERSION, F.lit(0)).unionByName(new.withColumn(bt.VERSION, F.lit(1)))
    newest_first = Window.partitionBy("sensor_id").orderBy(F.desc("datetime"))
    ranked = bt.newest(versioned, SERIES_KEY).withColumn("rank", F.row_number().over(newest_first))
    return ranked.filter(F.col("rank") <= LAGS).drop("rank")


def compact(spark: SparkSession, root: str, fan: int = 8) -> int:
    """Merge the folders of the tables that are due, and delete what no reader needs any more."""
    gone = 0
    for path in (root, f"{root}/{DAILY}"):
        tables = Snapshots(spark, path, fan)
        for table, (schema, keys) in TABLES.items():
            with_day = [*keys, DAY]
            gone += tables.compact(table, f"{schema}, {DAY} date", lambda df: bt.newest(df, with_day), [DAY])
        gone += tables.compact("progress", PROGRESS, lambda df: df.drop(bt.VERSION))
        tables.vacuum()
    return gone


def refresh_tables(
    root: str,
    model: PipelineModel | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    fan: int = 8,
    lag_hours: int | None = None,
    clock: Clock = wall_clock,
) -> bt.Handler:
    """Handler for batches of clean readings (``sensor_id, datetime, pm25``).

    A batch's rows of all tables become visible together, or not at all. Every ``fan`` batches
    their folders are merged. With ``lag_hours``, readings newer than that (by ``clock``), which the
    source may still revise, wait in a table of their own and are taken by a later batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        tables = Snapshots(spark, root, fan)
        before = tables.current()
        if batch_id <= before.batch:
            return  # a replay of what is in
        with scratch_scope(spark):
            refreshed(tables, before, batch, batch_id)
        if tables.due("clean") or tables.due("features") or tables.due("predictions"):
            compact(spark, root, fan)
        tables.vacuum()

    def refreshed(tables: Snapshots, before: Manifest, batch: DataFrame, batch_id: int) -> None:
        spark = tables.spark
        batch = batch.select("sensor_id", "datetime", "pm25")
        waiting = tables.read("held", READING, before).drop(bt.VERSION)
        n_rows, newest = batch.agg(F.count(F.lit(1)), F.max(F.unix_micros("datetime"))).first()
        if not n_rows:
            return  # nothing came; what waits is looked at with the next readings
        latest = max(x for x in (newest, before.notes.get("latest")) if x is not None)
        rows, held = batch, batch.limit(0)
        if lag_hours is not None:
            now = clock(dt.datetime.fromtimestamp(latest / 1e6, dt.timezone.utc))
            until = F.lit(int(now.timestamp() * 1_000_000) - lag_hours * 3_600_000_000)
            both = batch.unionByName(waiting)
            rows = both.filter(F.unix_micros("datetime") <= until)
            held = both.filter(F.unix_micros("datetime") > until)
        rows, n_taken = counted(cl.dedup(rows), "taken")
        held, n_held = counted(cl.dedup(held), "held")
        folder = tables.write("clean", batch_id, _by_day(rows), [DAY])
        fields = f"{READING}, {DAY} date"
        new = tables.read_folders("clean", [folder], fields).select("sensor_id", "datetime", "pm25")
        carry = tables.read("carry", READING, before).drop(bt.VERSION)

        spans = new.groupBy("sensor_id").agg(F.min("datetime").alias("first_new"))
        known = carry.groupBy("sensor_id").agg(F.max("datetime").alias("last_known"))
        spans = spans.join(known, "sensor_id", "left").select(
            "sensor_id", "first_new", F.coalesce(F.col("first_new") <= F.col("last_known"), F.lit(False)).alias("late")
        )
        spans = stored(spans, "spans")
        first = F.unix_micros(F.min(F.when(F.col("late"), F.col("first_new"))))
        n_spans, n_late, first = spans.agg(F.count(F.lit(1)), F.count_if("late"), first).first()
        added, replaced = {}, {}
        if lag_hours is not None:
            replaced["held"] = tables.write("held", batch_id, held)
        if not n_spans:
            delete_path(spark, f"{root}/clean/{folder}")  # nothing to keep, or to look through later
        else:
            added, replaced["carry"] = derived(
                tables, before, batch_id, folder, new, carry, spans, n_spans > n_late, first
            )
        notes = {"latest": latest}
        progress = [(batch_id, n_rows, n_taken.get["n"], n_held.get["n"] if lag_hours is not None else 0, latest)]
        progress = spark.createDataFrame(progress, "batch long, n_rows long, n_taken long, n_held long, us long")
        times = F.timestamp_micros("us")
        progress = progress.select("batch", "n_rows", "n_taken", "n_held", times.alias("latest"), (times + F.expr("INTERVAL 1 SECOND")).alias("cursor"))
        added["progress"] = tables.write("progress", batch_id, progress.coalesce(1))
        tables.commit(batch_id, added, replaced, notes)

    def derived(tables, before, batch_id, folder, new, carry, spans, some_forward, first):
        """Write features (and predictions) of a batch's readings; the new folders, and the carry."""
        forward, late = (spans.filter(c).select("sensor_id", "first_new") for c in (~F.col("late"), F.col("late")))
        made = []
        if some_forward:
            rows = [df.join(forward.select("sensor_id"), "sensor_id", "left_semi") for df in (new, carry)]
            made.append(_forward_features(*rows, rows_per_task))
        if first is not None:
            live = [*before.tables.get("clean", ()), folder]
            history = tables.read_folders("clean", live, f"{READING}, {DAY} date")
            made.append(_redone_features(history, late, first, rows_per_task))
        features = _by_day(rw.union_sources(made))
        added = {"clean": folder, "features": tables.write("features", batch_id, features, [DAY])}
        if model is not None:
            written = tables.read_folders("features", [added["features"]], f"{FEATURE}, {DAY} date")
            scored = score(model, written.drop(bt.VERSION))
            added["predictions"] = tables.write("predictions", batch_id, _by_day(scored, "date"), [DAY])
        return added, tables.write("carry", batch_id, _carry_on(carry, new))

    return handle


def start_landing_refresh(
    spark: SparkSession,
    landing: str,
    root: str,
    parameter: str = "pm25",
    multi_line: bool = True,
    files: str = rw.RAW_FILES,
    every: str = "600 seconds",
    once: bool = False,
    max_files_per_trigger: int | None = None,
    fallback: bool = True,
    model: PipelineModel | None = None,
    sensors: str | Iterable | None = None,
    start: str | None = None,
    end: str | None = None,
    lag_hours: int | None = None,
    clock: Clock = wall_clock,
    fan: int = 8,
) -> StreamingQuery:
    """Landing folder to fresh tables under ``root``; of some sensors or times only, if given.

    Daily documents have tables of their own below ``root``, or are left out without
    ``fallback``. They count for sensors without an hourly reading in all that has landed, which
    is decided on reading; so results don't depend on batches. Documents that don't parse are kept
    (``unreadable``), and how far the stream has come can be read (``cursor``).
    """
    configure(spark)
    raw = rw.read_raw_stream(spark, landing, multi_line, files, max_files_per_trigger)
    options = {"model": model, "fan": fan, "lag_hours": lag_hours, "clock": clock}
    daily = refresh_tables(f"{root}/{DAILY}", **options) if fallback else None
    refresh = bt.by_interval(refresh_tables(root, **options), daily)

    def handle(documents: DataFrame, batch_id: int) -> None:
        documents.persist()  # JSON is parsed once, for the readings and for what is no JSON
        try:
            _keep_unreadable(documents, root, batch_id, fan)
            readings = rw.normalize(documents.withColumn("interval", rw.interval_of(documents)), keep=["interval"])
            if not fallback:
                readings = readings.filter(F.col("interval") != "daily")
            readings = cl.in_time_range(cl.clean(readings, parameter, keep=["interval"]), start, end)
            if sensors is not None:
                readings = cl.only_sensors(readings, sensors)
            refresh(readings, batch_id)
        finally:
            documents.unpersist()

    return bt.start(raw, handle, f"{root}/checkpoint", every=every, once=once)


def _keep_unreadable(documents: DataFrame, root: str, batch_id: int, fan: int) -> None:
    spark = documents.sparkSession
    tables = Snapshots(spark, f"{root}/{DOCUMENTS}", fan)
    if batch_id <= tables.current().batch:
        return
    bad = documents.filter(F.col("_corrupt").isNotNull()).select("file_name", "sensor_id", "_corrupt")
    if not bad.isEmpty():
        tables.commit(batch_id, {"unreadable": tables.write("unreadable", batch_id, bad)})
        tables.compact("unreadable", UNREADABLE, lambda df: df.drop(bt.VERSION))
        tables.vacuum()
