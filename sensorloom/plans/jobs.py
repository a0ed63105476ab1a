"""The batch pipeline: raw documents to clean, trend, feature, model and prediction tables.

Each job reads and writes tables under one root, so jobs can run as separate applications.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions import weekday_label, year_week_label
from sensorloom.operators import clean as cl
from sensorloom.operators import features as ft
from sensorloom.operators import metrics as mt
from sensorloom.operators import trends as tr
from sensorloom.operators.split import split_report, time_split
from sensorloom.plans import models as ml
from sensorloom.schemas import SERIES_KEY
from sensorloom.session import configure, stored
from sensorloom.sources import raw as rw
from sensorloom.sources import tables as tb


TABLES = [
    "pm25_clean",
    "pm25_hourly",
    "eda/daily_trend",
    "eda/weekday_stats",
    "eda/weekly_trend",
    "features",
    "model_metrics",
]


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def model_path(root: str, name: str) -> str:
    return table_path(root, f"models/{name}")


def register_views(spark: SparkSession, root: str) -> list[str]:
    """Make the tables that exist under ``root`` available to SQL, under their own names.

    ``pm25_clean`` gets a ``date`` column for daily queries.
    """
    configure(spark)
    found = []
    for name in TABLES:
        if not tb.path_exists(spark, table_path(root, name)):
            continue
        table = tb.read_table(spark, table_path(root, name))
        if name == "pm25_clean":
            table = table.withColumn("date", F.to_date("datetime"))
        view = name.rsplit("/", 1)[-1]
        table.createOrReplaceTempView(view)
        found.append(view)
    return found


def etl(
    spark: SparkSession,
    raw_path: str | list[str],
    root: str,
    parameter: str = "pm25",
    multi_line: bool = True,
    files: str = rw.RAW_FILES,
    fallback: bool = True,
    sensors: str | Iterable | None = None,
    start: str | None = None,
    end: str | None = None,
    lag_hours: int | None = None,
) -> dict[str, int]:
    """Raw documents to the ``pm25_clean`` and ``pm25_hourly`` tables; returns stage counts.

    Daily readings count only for sensors without an hourly one, as in the stream, or not at all
    without ``fallback``. ``sensors``, ``start``, ``end`` and ``lag_hours`` (leave out what the
    source may still revise) choose among the readings. Documents that don't parse are counted,
    and kept in the table ``unreadable`` if there are any.

    Raw is read once, and again only for unreadable documents. Counts are observed on the writes.
    The hourly table is written in (sensor, time) order, which gives later scans tight row-group
    statistics.
    """
    configure(spark)
    raw = rw.read_raw(spark, raw_path, multi_line, files)
    seen = Observation("raw")
    documents = raw.observe(
        seen, F.count(F.lit(1)).alias("n"), F.count("_corrupt").alias("unreadable")
    )
    documents = documents.withColumn("interval", rw.interval_of(documents))
    readings, n_readings = tb.counted(rw.normalize(documents, keep=["interval"]), "readings")
    chosen = cl.in_time_range(cl.clean(readings, parameter, keep=["interval"]), start, end)
    if sensors is not None:
        chosen = cl.only_sensors(chosen, sensors)
    if lag_hours is not None:
        chosen = cl.settled(chosen, F.current_timestamp(), lag_hours)
    landed = stored(chosen, "landed")
    daily = F.col("interval") == "daily"
    hourly, rest = (landed.filter(c).drop("interval") for c in (~daily, daily & F.lit(fallback)))
    kept, n_clean = tb.counted(cl.prefer_hourly(hourly, rest), "clean")
    tb.write_table(kept, table_path(root, "pm25_clean"))
    if seen.get["unreadable"]:
        bad = raw.filter(F.col("_corrupt").isNotNull()).select("file_name", "sensor_id", "_corrupt")
        tb.write_table(bad, table_path(root, "unreadable"))
    clean = tb.read_table(spark, table_path(root, "pm25_clean")).drop("interval_used")
    distinct = cl.dedup(clean)
    hours, n_hourly = tb.counted(cl.ordered(cl.hourly(distinct)), "hourly")
    tb.write_table(hours, table_path(root, "pm25_hourly"))
    return {
        "raw": seen.get["n"],
        "unreadable": seen.get["unreadable"],
        "readings": n_readings.get["n"],
        "clean": n_clean.get["n"],
        "hourly": n_hourly.get["n"],
    }


def eda(spark: SparkSession, root: str, source: str = "pm25_clean") -> None:
    """Trend tables; ``source="pm25_hourly"`` leaves out repeated readings."""
    configure(spark)
    readings = tb.read_table(spark, table_path(root, source))
    daily_path = table_path(root, "eda/daily_trend")
    tb.write_table(tr.daily_trend(readings), daily_path)
    tb.write_table(tr.weekday_stats(readings), table_path(root, "eda/weekday_stats"))
    tb.write_table(tr.weekly_trend(readings), table_path(root, "eda/weekly_trend"))
    daily = tb.read_table(spark, daily_path)
    tb.write_table(tr.monthly_means(daily), table_path(root, "eda/monthly"))
    tb.write_table(tr.yearly_summary(daily), table_path(root, "eda/yearly"))


def build_features(spark: SparkSession, root: str) -> dict[str, int]:
    configure(spark)
    hours = tb.read_table(spark, table_path(root, "pm25_hourly"))
    rows, n = tb.counted(ft.lag_features(hours), "features")
    tb.write_table(rows, table_path(root, "features"))
    return {"features": n.get["n"]}


def train(
    spark: SparkSession,
    root: str,
    models: Iterable[str] = ("lr", "rf", "gbt"),
    tree_sample: float = 0.3,
    params: dict[str, dict] | None = None,
) -> DataFrame:
    """Fit and store models, their held-out predictions and their metrics.

    Returns the split report. All models are measured on the same held-out rows.
    """
    configure(spark)
    features = tb.read_table(spark, table_path(root, "features"))
    # `build_features` leaves no null or NaN but perhaps in the key.
    split = time_split(features, required=SERIES_KEY)
    held_out = []
    for alias in models:
        name = ml.model_name(alias)
        options = (params or {}).get(name, {})
        model = ml.fit(split.train, name, tree_sample=tree_sample, **options)
        ml.save(model, model_path(root, name))
        target = table_path(root, f"holdout/{name}")
        tb.write_table(ml.score(model, split.test), target)
        held_out.append(tb.read_table(spark, target).withColumn("model", F.lit(name)))
    tb.write_table(mt.naive_predictions(split.test), table_path(root, "holdout/persistence"))
    metrics = mt.regression_metrics(rw.union_sources(held_out))
    tb.upsert_table(metrics, table_path(root, "model_metrics"), ["model"])
    return split_report(features, split.cut, required=SERIES_KEY)


def predict(spark: SparkSession, root: str, model: str = "lr") -> str:
    """Score the whole feature table with a stored model; held-out predictions stay apart."""
    configure(spark)
    name = ml.model_name(model)
    features = tb.read_table(spark, table_path(root, "features"))
    target = table_path(root, f"scored/{name}")
    tb.write_table(ml.score(ml.load(model_path(root, name)), features), target)
    return target


def forecast(spark: SparkSession, root: str, model: str = "lr") -> str:
    configure(spark)
    name = ml.model_name(model)
    features = tb.read_table(spark, table_path(root, "features"))
    target = table_path(root, f"forecast/{name}")
    tb.write_table(
        ml.forecast_next_hour(features, ml.load(model_path(root, name))), target
    )
    return target


def report(
    spark: SparkSession,
    root: str,
    model: str = "lr",
    table: str = "holdout",
    rows: int | None = 200,
    year: int | None = None,
) -> None:
    """The small tables that a dashboard shows: best model, labelled weeks, months of a year (the
    latest if none is given), newest predictions (``rows`` None: all)."""
    configure(spark)
    metrics = tb.read_table(spark, table_path(root, "model_metrics"))
    tb.write_table(mt.best_model(metrics), table_path(root, "report/best_model"))
    weekly = tb.read_table(spark, table_path(root, "eda/weekly_trend"))
    label = year_week_label(F.col("year"), F.col("week_of_year"))
    tb.write_table(weekly.withColumn("year_week", label), table_path(root, "report/weekly"))
    weekdays = tb.read_table(spark, table_path(root, "eda/weekday_stats"))
    tb.write_table(
        weekdays.withColumn("weekday", weekday_label(F.col("day_of_week"))),
        table_path(root, "report/weekdays"),
    )
    daily = tb.read_table(spark, table_path(root, "eda/daily_trend"))
    months = tr.monthly_means(tr.in_year(daily, year))
    tb.write_table(months, table_path(root, "report/months"))
    predicted = tb.read_table(spark, table_path(root, f"{table}/{ml.model_name(model)}"))
    by_time = mt.collapse_by_time(predicted)
    newest = by_time.orderBy("date") if rows is None else mt.last_rows(by_time, rows)
    tb.write_table(newest, table_path(root, "report/predictions"))
