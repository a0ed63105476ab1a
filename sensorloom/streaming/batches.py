"""Micro-batch plumbing: triggers, idempotent versioned sinks, reading the newest version.

A batch writes new folders and then commits them together with its number, so a failed try leaves
no trace, and a batch that is in already is not taken again. Readers take the newest version of
each key; folders are merged as they become many.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.sources.snapshots import VERSION, Snapshots, folder_batch
from sensorloom.sources.tables import counted, delete_path

Handler = Callable[[DataFrame, int], None]
#: The table of a sink's folder.
ROWS = "rows"


def start(
    stream: DataFrame,
    handle: Handler,
    checkpoint: str,
    every: str = "600 seconds",
    once: bool = False,
    output_mode: str = "append",
) -> StreamingQuery:
    """Poll on a schedule, or process what has landed and stop (``once``)."""
    writer = (
        stream.writeStream.outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(handle)
    )
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def versions(spark: SparkSession, root: str, table: str = ROWS) -> list[int]:
    """The batches that live folders of a table go up to, oldest first."""
    return [folder_batch(name) for name in Snapshots(spark, root).current().tables.get(table, ())]


def versioned_sink(
    path: str,
    save_empty: bool = False,
    partial: Callable[[DataFrame], DataFrame] | None = None,
    merge: Callable[[DataFrame], DataFrame] | None = None,
    fan: int = 8,
) -> Handler:
    """Write each batch, or its ``partial`` result, as its own version.

    Batches without rows leave none by default. A batch is computed once, as stateful streams need.
    With ``merge``, which makes one partial result of the rows of several, ``fan`` versions become
    one, and what they replace is deleted.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        tables = Snapshots(batch.sparkSession, path, fan)
        if batch_id <= tables.current().batch:
            return  # a replay of what is in
        made, n = counted(partial(batch) if partial else batch, "rows")
        folder = tables.write(ROWS, batch_id, made)
        if not n.get["n"] and not save_empty:
            delete_path(tables.spark, f"{path}/{ROWS}/{folder}")
            return
        tables.commit(batch_id, {ROWS: folder})
        if merge is not None:
            schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in made.schema)
            tables.compact(ROWS, schema, merge)
            tables.vacuum()

    return handle


def by_interval(handle_hourly: Handler, handle_daily: Handler | None) -> Handler:
    """Hand hourly and daily readings (column ``interval``) to handlers of their own.

    They are kept apart, and readers choose between them over all that is stored: a choice made
    inside a batch would depend on how files fall into batches.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        daily = F.col("interval") == "daily"
        batch.persist()  # read by both handlers
        try:
            handle_hourly(batch.filter(~daily).drop("interval"), batch_id)
            if handle_daily is not None:
                handle_daily(batch.filter(daily).drop("interval"), batch_id)
        finally:
            batch.unpersist()

    return handle


def read_versions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a sink's live versions, with ``batch_id``."""
    return Snapshots(spark, path).read(ROWS, schema)


def newest(versioned: DataFrame, keys: list[str]) -> DataFrame:
    """The newest version of every key, without the version column.

    A key stands once in a version, so every column comes from the same row. With columns of
    fixed width this is a hash aggregate: no task sorts its rows first.
    """
    rest = [c for c in versioned.columns if c not in (*keys, VERSION)]
    return versioned.groupBy(*keys).agg(*[F.max_by(c, VERSION).alias(c) for c in rest])
