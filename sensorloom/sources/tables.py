"""Parquet tables: scans, sinks, safe replacement, keyed upsert, pass-through counts."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import filesystem, scratch_dir, scratch_scope, stored


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def preview(df: DataFrame, n: int, order_by: list[str]) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order_by).limit(n)


def present_columns(df: DataFrame, wanted: list[str]) -> DataFrame:
    """Those of the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def counted(df: DataFrame, stage: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here in the next job; read ``observation.get["n"]`` after it.

    Count above a global sort, not below it: a range shuffle reads its input twice, once to
    sample it.
    """
    seen = Observation(stage)
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def bucketed_table(
    df: DataFrame, key: str, buckets: int, label: str
) -> tuple[DataFrame, Callable[[], None]]:
    """Write to the shared scratch folder in buckets of a key; joins on it then leave it in place.

    One shuffle here instead of one in every join. Returns the table, and a function that drops it.
    """
    spark, path = df.sparkSession, scratch_dir(df.sparkSession, label)
    name = f"sensorloom_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, key).write.format("parquet").option("path", path)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(name)

    def drop() -> None:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, path)

    return spark.table(name), drop


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Old rows whose key is not in ``new``, plus all of ``new``."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = filesystem(spark, path)
    return fs.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, target = filesystem(spark, path)
    fs.delete(target, True)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none if there is no such folder."""
    fs, target = filesystem(spark, path)
    if not fs.exists(target):
        return []
    return [status.getPath().getName() for status in fs.listStatus(target)]


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, from_path = filesystem(spark, source)
    if not fs.rename(from_path, filesystem(spark, target)[1]):
        raise OSError(f"could not rename {source} to {target}")


def replace_table(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite a table that ``df`` may itself be reading.

    The new rows are fully written beside the table before the old ones are touched, and the
    old ones are put back if the final rename fails. ``single_file`` is for small tables only.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    fresh, previous = f"{path}__new_{version}", f"{path}__old_{version}"
    (df.coalesce(1) if single_file else df).write.parquet(fresh)
    had_table = path_exists(spark, path)
    if had_table:
        _rename(spark, path, previous)
    try:
        _rename(spark, fresh, path)
    except Exception:
        if had_table:
            _rename(spark, previous, path)
        raise
    if had_table:
        delete_path(spark, previous)
    spark.catalog.refreshByPath(path)


def upsert_table(new: DataFrame, path: str, key: list[str]) -> None:
    """Keyed upsert into a small stored table; errors reading the old rows are not hidden.

    The new rows, which are looked at twice, are written first, so that they are computed once.
    """
    spark = new.sparkSession
    with scratch_scope(spark):
        _upsert_stored(stored(new, "new-rows"), path, key)


def _upsert_stored(new: DataFrame, path: str, key: list[str]) -> None:
    spark = new.sparkSession
    merged = upsert(spark.read.parquet(path), new, key) if path_exists(spark, path) else new
    replace_table(merged, path, single_file=True)
