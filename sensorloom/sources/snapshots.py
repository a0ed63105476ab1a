"""Tables of versions behind a manifest.

A table is a list of folders, oldest first. Which folders are live, in all tables of a root, stands
in one small file; a commit writes the next such file and nothing else, so readers see all of a
batch or none of it. Folders are never changed once they are written. Compaction merges folders of
one level into one of the next, as soon as there are ``fan`` of them: a table of n batches has about
``fan`` times log n live folders, and a row is rewritten log n times. What newer manifests no longer
name is deleted some commits later, so that readers can finish.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import filesystem
from sensorloom.sources.tables import child_names, delete_path

MANIFESTS = "_manifests"
#: The column that tells which batch a row's folder goes up to.
VERSION = "batch_id"
_DIGITS = 12


@dataclass(frozen=True)
class Manifest:
    """Live folders of every table after a commit, the newest batch that is in, and what else is kept."""

    sequence: int = 0
    batch: int = -1
    tables: dict[str, tuple[str, ...]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)


def folder_name(batch: int, level: int = 0) -> str:
    """A new name for a folder of the batches of one compaction, the last of which is ``batch``."""
    return f"v={batch:0{_DIGITS}d}.{level}.{uuid.uuid4().hex[:12]}"


def folder_batch(name: str) -> int:
    return int(name[2 : 2 + _DIGITS])


def folder_level(name: str) -> int:
    return int(name.split(".")[1])


class Snapshots:
    """Versioned tables below one root.

    ``fan`` is how many folders of one level make one of the next, ``keep`` how many manifests
    stay readable. Several writers may commit: one that finds its manifest taken tries again on
    top of the other's.
    """

    def __init__(self, spark: SparkSession, root: str, fan: int = 8, keep: int = 3) -> None:
        self.spark, self.root, self.fan, self.keep = spark, root.rstrip("/"), fan, keep

    # --- manifests ---

    def _sequences(self) -> list[int]:
        names = child_names(self.spark, f"{self.root}/{MANIFESTS}")
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] not in "_.")

    def _manifest_path(self, sequence: int) -> str:
        return f"{self.root}/{MANIFESTS}/{sequence:0{_DIGITS}d}.json"

    def _load(self, sequence: int) -> Manifest:
        fs, target = filesystem(self.spark, self._manifest_path(sequence))
        jvm = self.spark.sparkContext._jvm
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(target), "UTF-8"))
        try:
            held = json.loads(reader.readLine())
        finally:
            reader.close()
        tables = {t: tuple(f) for t, f in held["tables"].items()}
        return Manifest(sequence, held["batch"], tables, held["notes"])

    def current(self) -> Manifest:
        """The newest manifest; an empty one if nothing was committed yet."""
        sequences = self._sequences()
        return self._load(sequences[-1]) if sequences else Manifest()

    def update(self, change: Callable[[Manifest], Manifest]) -> Manifest:
        """Commit ``change`` of the newest manifest, again if another writer came first."""
        while True:
            before = self.current()
            after = replace(change(before), sequence=before.sequence + 1)
            if self._publish(after):
                return after

    def _publish(self, manifest: Manifest) -> bool:
        """Write beside, then rename to a name that must be free."""
        text = json.dumps({"batch": manifest.batch, "tables": manifest.tables, "notes": manifest.notes})
        fs, beside = filesystem(self.spark, f"{self.root}/{MANIFESTS}/_{uuid.uuid4().hex}.tmp")
        out = fs.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        jvm, sc = self.spark.sparkContext._jvm, self.spark.sparkContext
        _, target = filesystem(self.spark, self._manifest_path(manifest.sequence))
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
        options = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(beside, target, options)
        except Exception as error:
            fs.delete(beside, False)
            if "FileAlreadyExists" in str(error):
                return False
            raise
        return True

    # --- folders ---

    def write(self, table: str, batch: int, df: DataFrame, partition_by: Iterable[str] = (), level: int = 0) -> str:
        """Write a new folder and return its name; nothing reads it before a commit names it."""
        name, keys = folder_name(batch, level), list(partition_by)
        # Files of about equal size, however rows are spread over the partition values.
        writer = (df.hint("rebalance", *keys) if keys else df).write
        (writer.partitionBy(*keys) if keys else writer).parquet(f"{self.root}/{table}/{name}")
        return name

    def read_folders(self, table: str, folders: Iterable[str], schema: str) -> DataFrame:
        paths = [f"{self.root}/{table}/{name}" for name in folders]
        fields = f"{schema}, v string"
        if not paths:
            rows = self.spark.createDataFrame([], fields)
        else:
            rows = self.spark.read.schema(fields).option("basePath", f"{self.root}/{table}").parquet(*paths)
        version = F.substring("v", 1, _DIGITS).cast("long")
        return rows.withColumn(VERSION, version).drop("v")

    def read(self, table: str, schema: str, manifest: Manifest | None = None) -> DataFrame:
        """Rows of all live folders, with the newest batch of their folder as ``batch_id``.

        ``schema`` names the partition columns too; filters on these choose folders.
        """
        manifest = manifest or self.current()
        return self.read_folders(table, manifest.tables.get(table, ()), schema)

    def commit(
        self, batch: int, added: dict[str, str], replaced: dict[str, str] | None = None, notes: dict | None = None
    ) -> Manifest:
        """Make one folder for each table live, beside those before it or (``replaced``) instead."""

        def change(before: Manifest) -> Manifest:
            tables = dict(before.tables)
            for table, name in added.items():
                tables[table] = (*tables.get(table, ()), name)
            for table, name in (replaced or {}).items():
                tables[table] = (name,)
            kept = {**before.notes, **(notes or {})}
            return replace(before, batch=max(before.batch, batch), tables=tables, notes=kept)

        return self.update(change)

    # --- upkeep ---

    def due(self, table: str) -> list[str]:
        """Neighbouring folders of one level that are to be merged; the lowest level first."""
        run: list[str] = []
        for name in reversed(self.current().tables.get(table, ())):
            if run and folder_level(name) != folder_level(run[-1]):
                if len(run) >= self.fan:
                    break
                run = []
            run.append(name)
        return run[::-1] if len(run) >= self.fan else []

    def compact(
        self, table: str, schema: str, merge: Callable[[DataFrame], DataFrame], partition_by: Iterable[str] = ()
    ) -> int:
        """Merge what is due, level by level; returns how many folders went.

        ``merge`` makes of the rows of neighbouring folders the rows that stand for them, without
        ``batch_id``. Readers see the old folders or the new one.
        """
        gone = 0
        while some := self.due(table):
            merged = merge(self.read_folders(table, some, schema))
            fresh = self.write(table, folder_batch(some[-1]), merged, partition_by, folder_level(some[-1]) + 1)

            def change(before: Manifest, some: list[str] = some, fresh: str = fresh) -> Manifest:
                live = list(before.tables.get(table, ()))
                if not set(some) <= set(live):
                    raise RuntimeError(f"{table}: another writer merged {some}")
                at = live.index(some[0])
                kept = [n for n in live if n not in some]
                return replace(before, tables={**before.tables, table: (*kept[:at], fresh, *kept[at:])})

            self.update(change)
            gone += len(some)
        return gone

    def vacuum(self, keep: int | None = None) -> int:
        """Delete manifests but the newest ``keep``, and the folders that only those named."""
        sequences = self._sequences()
        cut = max(0, len(sequences) - (self.keep if keep is None else keep))
        if not cut:
            return 0
        held = {(t, f) for s in sequences[cut:] for t, fs in self._load(s).tables.items() for f in fs}
        old = {(t, f) for s in sequences[:cut] for t, fs in self._load(s).tables.items() for f in fs}
        for table, name in old - held:
            delete_path(self.spark, f"{self.root}/{table}/{name}")
        for sequence in sequences[:cut]:
            delete_path(self.spark, self._manifest_path(sequence))
        return len(old - held)
