"""The landing folder as a data source: one document per file, under the names that readers expect.

Spark's own JSON writer chooses file names and puts many documents in a file. Here each task writes
its documents itself, through Arrow's file systems (local and shared folders, HDFS, S3, GCS). A file's
name follows from its document, and it is written beside and then moved, so a task that runs again
only writes the same files once more, and readers never see half of one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceStreamWriter,
    DataSourceWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

FORMAT = "landing"
DOCUMENT = "name string, document string"


class LandingSource(DataSource):
    """Writes rows (name, document), in batch and from streams; option ``path`` names the folder."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("a landing folder is only added to")
        return LandingWriter(self.options["path"])

    def streamWriter(self, schema: StructType, overwrite: bool) -> DataSourceStreamWriter:
        return LandingStreamWriter(self.options["path"])


def _land(path: str, rows: Iterator[Row]) -> WriterCommitMessage:
    from pyarrow import fs

    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(folder, recursive=True)
    for row in rows:
        beside = f"{folder}/_{uuid.uuid4().hex}"
        with store.open_output_stream(beside) as out:
            out.write(row["document"].encode())
        store.move(beside, f"{folder}/{row['name']}")
    return WriterCommitMessage()


class LandingWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        return _land(self.path, iterator)


class LandingStreamWriter(DataSourceStreamWriter):
    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        return _land(self.path, iterator)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Nothing is left to do: each file appeared whole."""

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        """Files that are there stay; the batch writes them again, the same."""


def documents(envelopes: DataFrame) -> DataFrame:
    """Envelopes as (name, document): ``sensor_{id}_{interval}_{first time}_{digest}.json``.

    Characters that mean something in names or paths become dashes; the document has the id itself.
    """
    document = F.to_json(F.struct(*envelopes.columns))
    plain = F.regexp_replace(F.coalesce("sensor_id", F.lit("none")), "[^A-Za-z0-9.-]", "-")
    time = F.regexp_replace(F.coalesce("date_from", F.lit("")), "[^0-9T]", "")
    digest = F.substring(F.sha2(document, 256), 1, 12)
    name = F.concat(F.lit("sensor_"), F.concat_ws("_", plain, "interval", time, digest), F.lit(".json"))
    return envelopes.select(name.alias("name"), document.alias("document"))


def land(envelopes: DataFrame, path: str) -> None:
    """Add envelopes to a landing folder; ``read_raw`` and ``read_raw_stream`` read it as it is."""
    envelopes.sparkSession.dataSource.register(LandingSource)
    documents(envelopes).write.format(FORMAT).option("path", path).mode("append").save()
