"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_APP_FOLDERS: dict[str, str] = {}
_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch paths of the innermost scope", default=None)


def configure(spark: SparkSession) -> SparkSession:
    """Pin calendar arithmetic to UTC; master, memory and parallelism stay the cluster's choice."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder that every executor can reach, as named by ``spark.checkpoint.dir``.

    A machine-local folder is only ever used in local mode, where driver and executors
    are one process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.conf.get("spark.app.id")
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="sensorloom-")
    return _LOCAL_ROOTS[app]


def filesystem(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its own type."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _app_folder(spark: SparkSession) -> str:
    """This application's folder below the shared scratch folder; it goes when the driver ends."""
    app = spark.conf.get("spark.app.id")
    if app not in _APP_FOLDERS:
        folder = f"{scratch_root(spark)}/sensorloom/{app}-{uuid.uuid4().hex}"
        fs, target = filesystem(spark, folder)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _APP_FOLDERS[app] = folder
    return _APP_FOLDERS[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A path below the shared scratch folder that no other call returns.

    What is written there is deleted at the end of the enclosing ``scratch_scope``, else when the
    driver ends.
    """
    path = f"{_app_folder(spark)}/{label}-{uuid.uuid4().hex}"
    if (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is written to scratch folders inside; only for work whose results lie elsewhere."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        for path in paths:
            fs, target = filesystem(spark, path)
            fs.delete(target, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: computed once, and its size is known."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
