"""Raw JSON documents: reading, normalising, auditing and writing them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom import schemas
from sensorloom.functions import parse_utc, utc_iso

# The two landing name forms are sensor_{id}_{interval}_{time}.json and
# pm25_sensor_{id}_{interval}_{time}.json.
RAW_FILES = "*sensor_*.json"
ID_IN_NAME = "sensor_([^_]+)_"
INTERVAL_IN_NAME = "sensor_[^_]+_([^_]+)_"


def _raw_options(multi_line: bool, files: str) -> dict[str, str]:
    return {
        "multiLine": str(multi_line).lower(),
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": "_corrupt",
        "pathGlobFilter": files,
        "recursiveFileLookup": "true",
    }


def read_raw(
    spark: SparkSession,
    paths: str | list[str],
    multi_line: bool = True,
    files: str = RAW_FILES,
) -> DataFrame:
    """All raw documents below ``paths`` as one scan with a declared schema.

    ``multi_line`` is for one (possibly pretty-printed) object per file; files that Spark
    wrote hold one object per line and need ``multi_line=False, files="*.json"``.
    """
    try:
        raw = spark.read.schema(schemas.RAW).options(**_raw_options(multi_line, files)).json(paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise ValueError(f"no raw files found in {paths}") from error
        raise
    if raw.isEmpty():
        raise ValueError(f"no raw files matching {files} in {paths}")
    return raw.select("*", "_metadata.file_name")


def read_raw_stream(
    spark: SparkSession,
    path: str,
    multi_line: bool = True,
    files: str = RAW_FILES,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """The same documents as a stream over a landing folder."""
    reader = spark.readStream.schema(schemas.RAW).options(**_raw_options(multi_line, files))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path).select("*", "_metadata.file_name")


def _own_or_named(raw: DataFrame, column: str, pattern: str) -> Column:
    """A text field of the document, else the part of its file name that says the same."""
    own = F.col(column).cast("string")
    if "file_name" not in raw.columns:
        return own
    return F.coalesce(own, F.nullif(F.regexp_extract("file_name", pattern, 1), F.lit("")))


def sensor_of(raw: DataFrame) -> Column:
    return _own_or_named(raw, "sensor_id", ID_IN_NAME)


def interval_of(raw: DataFrame) -> Column:
    """``hourly`` or ``daily``; hourly where neither the document nor its name says."""
    return F.coalesce(_own_or_named(raw, "interval", INTERVAL_IN_NAME), F.lit("hourly"))


def normalize(raw: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """One row per measurement, whichever layout the document has.

    Works on batch and streaming frames. A frame may hold envelopes, flat documents or both.
    ``keep`` names document fields to carry along.
    """
    flat = F.array(F.struct("value", "parameter", "period"))
    if "results" not in raw.columns:
        records = flat
    elif "period" not in raw.columns:
        records = F.col("results")
    else:
        records = F.coalesce("results", F.when(F.col("period").isNotNull(), flat))
    return (
        raw.select(sensor_of(raw).alias("sensor_id"), *keep, records.alias("records"))
        .select("sensor_id", *keep, F.inline("records"))
        .select(
            F.col("value").cast("double").alias("pm25"),
            parse_utc(F.col("period.datetimeTo.utc")).alias("datetime"),
            F.col("parameter.name").alias("parameter"),
            F.col("period.label").alias("period_label"),
            "sensor_id",
            *keep,
        )
    )


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name; a column missing from one source is null there."""
    frames = iter(frames)
    result = next(frames)
    for frame in frames:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def record_count() -> Column:
    return F.coalesce(F.array_size("results"), F.lit(0)).cast("long")


def incomplete_envelopes(raw: DataFrame) -> DataFrame:
    """Envelopes whose declared count differs from the records they hold."""
    return raw.withColumn("records", record_count()).filter(F.col("count") != F.col("records"))


def ingest_totals(raw: DataFrame) -> DataFrame:
    """Sensors, records and files of a landing."""
    totals = [
        F.count_distinct("sensor").alias("n_sensors"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("n_records"),
    ]
    columns = [sensor_of(raw).alias("sensor"), record_count().alias("records")]
    if "file_name" in raw.columns:
        columns.append(F.col("file_name"))
        totals.append(F.count_distinct("file_name").alias("n_files"))
    return raw.select(*columns).agg(*totals)


def to_envelopes(
    readings: DataFrame, interval: str = "hourly", most_records: int = 10_000, span: str = "day"
) -> DataFrame:
    """Pack ``sensor_id, datetime, pm25, parameter`` rows into envelope documents.

    A document holds a sensor's readings of one day (or ``span``), in time order, and says from when
    to when. A day with more than ``most_records`` readings is dealt out over several documents by a hash of
    the reading, so a sensor that holds most of the readings is not one task's burden. The
    documents depend on the readings alone, not on how these are partitioned.
    """
    record = F.struct(
        F.col("pm25").cast("double").alias("value"),
        F.struct(F.col("parameter").alias("name")).alias("parameter"),
        F.struct(
            F.lit(interval).alias("label"),
            F.struct(utc_iso(F.col("datetime")).alias("utc")).alias("datetimeTo"),
        ).alias("period"),
    )
    rows = readings.select(
        F.col("sensor_id").cast("string").alias("sensor_id"),
        F.to_date(F.date_trunc(span, "datetime")).alias("day"),
        F.struct("datetime", record.alias("record")).alias("reading"),
    )
    days = rows.groupBy("sensor_id", "day").agg(F.count(F.lit(1)).alias("n"))
    crowded = days.filter(F.col("n") > most_records).select(
        F.col("sensor_id").alias("s"),
        F.col("day").alias("d"),
        F.ceil(F.col("n") * 2 / most_records).alias("parts"),
    )
    same_day = F.col("sensor_id").eqNullSafe(F.col("s")) & F.col("day").eqNullSafe(F.col("d"))
    part = F.pmod(F.xxhash64("reading"), F.coalesce("parts", F.lit(1)))
    grouped = (
        rows.join(crowded, same_day, "left")
        .groupBy("sensor_id", "day", part.alias("part"))
        .agg(F.sort_array(F.collect_list("reading")).alias("readings"))
    )
    first, last = (F.element_at("readings", i)["datetime"] for i in (1, -1))
    return grouped.select(
        "sensor_id",
        F.lit(interval).alias("interval"),
        utc_iso(first).alias("date_from"),
        utc_iso(last).alias("date_to"),
        F.size("readings").cast("long").alias("count"),
        F.col("readings.record").alias("results"),
    )


def write_envelopes(envelopes: DataFrame, path: str) -> None:
    """Write envelopes as JSON lines, many in a file; read back with ``multi_line=False, files="*.json"``.

    ``landing.land`` writes a file for each instead, under the names of a landing folder.
    """
    envelopes.write.mode("overwrite").json(path)
