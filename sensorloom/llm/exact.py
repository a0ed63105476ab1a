"""Exact de-duplication over a cuckoo-filter index of live digests.

The index is cut into shards by digest. Each shard has a cuckoo filter (2 bytes a key, in memory)
and its stored digests (a log of insertions and deletions, a folder for each shard). Rows probe the
filters; only hits are verified against the stored digests of their shards and against each other.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.common import SPACE_CHARS, content, parallelism, without, written
from sensorloom.llm.cuckoo import CuckooFilter, Full
from sensorloom.sources.snapshots import VERSION, Snapshots

FILTERS = "shard int, buckets long, held long, filter binary"
LOG = "digest binary, change long, shard int"
#: What a row of the shard stream is; a shard's rows come in this order.
STATE, STORED, DELETE, FORCE, ADD = range(5)


class DigestIndex:
    """Live digests below one shared folder; every change commits new filters and its part of the log.

    A digest is live when its changes in the log sum to more than zero. Filters and log become
    visible together, by one manifest, so lost executors and failed jobs leave the state before
    them in force, and an index opened anew, also by another application, is the same. The number
    of shards is chosen when an index begins. Log folders are merged as they become many. One
    writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, shards: int | None = None, fan: int = 8) -> None:
        self.spark, self.tables = spark, Snapshots(spark, path, fan)
        self.shards = self.tables.current().notes.get("shards") or shards or parallelism(spark)

    def shard(self, digest: Column) -> Column:
        return F.pmod(F.xxhash64(digest), F.lit(self.shards)).cast("int")

    def filters(self, folders: Iterable[str] | None = None) -> DataFrame:
        """The filter of every shard that has one."""
        folders = self.tables.current().tables.get("filters", ()) if folders is None else folders
        return self.tables.read_folders("filters", folders, FILTERS).drop(VERSION)

    def live(self, log: Iterable[str] | None = None, shards: list[int] | None = None) -> DataFrame:
        """The stored digests, by shard; only the folders of some shards, if given, are read."""
        log = self.tables.current().tables.get("log", ()) if log is None else log
        rows = self.tables.read_folders("log", log, LOG)
        if shards is not None:
            rows = rows.where(F.col("shard").isin(shards))
        return _summed(rows).where("change > 0").drop("change")

    def _change(self, rows: DataFrame, op: int, filters: list[str], log: list[str]) -> DataFrame:
        """Run one change over the shards: the rows with ``hit``; ``filters`` then names the new ones.

        A shard whose filter would overflow gets its stored digests into the stream and is built
        anew at twice the size or more; so is one that overflows unforeseen, in a second run.
        """
        rows = rows.withColumn("shard", self.shard(F.col("digest"))).withColumn("op", F.lit(op))
        state = self.filters(filters)
        grown = rows.groupBy("shard").agg(F.count("*").alias("more"))
        room = F.coalesce("buckets", F.lit(0)) * 4 * 0.9
        wanted = F.coalesce("held", F.lit(0)) + F.col("more")
        full = {} if op == DELETE else {
            r["shard"]: r["keys"]  # one row for each shard at most
            for r in grown.join(state, "shard", "left")
            .where(wanted > room)
            .select("shard", wanted.alias("keys"))
            .collect()
        }
        while True:
            sizes = self.spark.createDataFrame(list(full.items()), "shard int, want long")
            states = state.join(F.broadcast(sizes), "shard", "full").select(
                "shard", F.lit(STATE).alias("op"), "buckets", "held", "filter", "want"
            )
            stored = self.live(log, list(full))
            stream = (
                rows.unionByName(states, allowMissingColumns=True)
                .unionByName(stored.withColumn("op", F.lit(STORED)), allowMissingColumns=True)
                .repartition(self.shards, "shard")
                .sortWithinPartitions("shard", "op")
            )
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
            made = written(stream.mapInArrow(_shards, f"{fields}, hit boolean"), "probed")
            failed = made.where((F.col("op") == STATE) & F.col("filter").isNull())
            failed = {r["shard"]: 2 * r["held"] for r in failed.select("shard", "held").collect()}
            if not failed:
                fresh = made.where(F.col("op") == STATE).select("shard", "buckets", "held", "filter")
                filters[:] = [self.tables.write("filters", self._batch(), fresh)]
                return made.where(F.col("op") == op).drop("op", "buckets", "held", "filter", "want")
            full |= failed

    def _batch(self) -> int:
        return self.tables.current().batch + 1

    def _logged(self, digests: DataFrame, change: int) -> str:
        """A new folder of the log, by shard; it counts once it is committed."""
        rows = digests.select("digest", F.lit(change).cast("long").alias("change"), self.shard(F.col("digest")).alias("shard"))
        return self.tables.write("log", self._batch(), rows, ["shard"])

    def _commit(self, filters: list[str], fresh: list[str]) -> None:
        """Put a change in force: its filters and its folders of the log; merge what is due."""
        batch, notes = self._batch(), {"shards": self.shards}

        def change(before):
            log = (*before.tables.get("log", ()), *fresh)
            return replace(before, batch=batch, tables={"filters": tuple(filters), "log": log}, notes=notes)

        self.tables.update(change)
        self.tables.compact("log", LOG, lambda rows: _summed(rows).where("change <> 0"), ["shard"])
        self.tables.vacuum()

    def add(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Insert the digests of ``rows`` that aren't live.

        Returns the rows with ``hit`` (false: the only row of a digest new to the index), and the
        digests of hits with ``known``: whether they were live before. A repeated digest may be
        given in any number of rows. Filters that took a false positive for a known digest get
        that digest now, since each live digest needs an entry of its own to be deletable.
        """
        now = self.tables.current().tables
        filters, log = list(now.get("filters", ())), list(now.get("log", ()))
        probed = self._change(rows, ADD, filters, log)
        hits = written(probed.where("hit").select("digest").distinct(), "hit-digests")
        shards = [r[0] for r in hits.select(self.shard(F.col("digest"))).distinct().collect()]
        stored = self.live(log, shards).select("digest", F.lit(True).alias("known"))
        known = hits.join(stored, "digest", "left")
        known = written(known.select("digest", F.coalesce("known", F.lit(False)).alias("known")), "hits")
        new = probed.where(~F.col("hit")).select("digest").distinct()
        fresh = [self._logged(new, 1)]  # the next change may build filters from the log
        missed = written(known.where(~F.col("known")).join(new, "digest", "left_anti"), "missed")
        if not missed.isEmpty():
            self._change(missed.select("digest"), FORCE, filters, log + fresh)
            fresh.append(self._logged(missed, 1))
        self._commit(filters, fresh)
        return probed, known

    def remove(self, digests: DataFrame) -> None:
        """Delete digests; those that aren't live are left alone, repeats count once."""
        now = self.tables.current().tables
        filters, log = list(now.get("filters", ())), list(now.get("log", ()))
        wanted = written(digests.select("digest").distinct(), "to-remove")
        shards = [r[0] for r in wanted.select(self.shard(F.col("digest"))).distinct().collect()]
        live = written(wanted.join(self.live(log, shards).select("digest"), "digest"), "removed")
        if not live.isEmpty():
            self._change(live, DELETE, filters, log)
            self._commit(filters, [self._logged(live, -1)])

    def contains(self, digests: DataFrame) -> DataFrame:
        """The given digests (distinct) that are live: filter hits, verified."""
        state = self.filters()
        rows = digests.select("digest").distinct()
        rows = rows.withColumn("shard", self.shard(F.col("digest"))).withColumn("op", F.lit(ADD + 1))
        states = state.withColumn("op", F.lit(STATE)).withColumn("want", F.lit(None).cast("long"))
        stream = rows.unionByName(states, allowMissingColumns=True)
        stream = stream.repartition(self.shards, "shard").sortWithinPartitions("shard", "op")
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stream.schema)
        probed = stream.mapInArrow(_shards, f"{fields}, hit boolean").where("hit").select("digest")
        return probed.join(self.live().select("digest"), "digest", "left_semi")


def _summed(log: DataFrame) -> DataFrame:
    return log.groupBy("shard", "digest").agg(F.sum("change").alias("change"))


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Run the stream of some shards, in order, through their filters.

    Memory: one shard's filter and 8 bytes for each key inserted in this run.
    """
    shard, names, fields = None, [], None
    held, own, table, lost = 0, [], None, False

    def end() -> Iterator[pa.RecordBatch]:
        if shard is not None and table is not None:
            row = {n: None for n in names} | {"shard": shard, "op": STATE, "held": held, "hit": None}
            row |= {"buckets": len(table.table), "filter": None if lost else table.table.tobytes()}
            yield pa.RecordBatch.from_pylist([row], schema=fields)

    def grow(keys: np.ndarray, least: int) -> CuckooFilter:
        """A larger filter of the keys of this shard, from the keys."""
        size = CuckooFilter.buckets_for(least)
        while True:
            larger = CuckooFilter(size)
            try:
                larger.insert(keys)
                return larger
            except Full:
                size *= 2

    def insert(keys: np.ndarray) -> None:
        nonlocal table, held, lost
        held += len(keys)
        own.append(keys)
        if whole:
            if held > len(table.table) * 4 * 0.9:
                table = grow(np.concatenate(own), 2 * held)
                return
            try:
                table.insert(keys)
            except Full:
                table = grow(np.concatenate(own), 2 * held)
        elif not lost:
            try:
                table.insert(keys)
            except Full:
                lost = True

    whole = True  # all keys of the shard came by in this run
    for batch in batches:
        names = [*batch.schema.names, "hit"]
        fields = pa.schema([*((f.name, f.type) for f in batch.schema), ("hit", pa.bool_())])
        order = batch.column("shard").to_numpy()
        ops = batch.column("op").to_numpy()
        marks = order.astype(np.int64) * 8 + ops
        cuts = np.flatnonzero(np.diff(marks)) + 1
        for start, stop in zip([0, *cuts], [*cuts, len(marks)], strict=True):
            part = batch.slice(start, stop - start)
            op = int(ops[start])
            if order[start] != shard:
                yield from end()
                shard, held, own, lost, whole = int(order[start]), 0, [], False, True
                table = CuckooFilter(CuckooFilter.buckets_for(64))
            if op == STATE:
                row = part.to_pylist()[0]
                if row["want"] is not None:
                    table = CuckooFilter(CuckooFilter.buckets_for(row["want"]))
                elif row["filter"] is not None:
                    table, held, whole = CuckooFilter(row["buckets"], row["filter"]), row["held"], False
                continue
            keys = _keys(part.column("digest"))
            hit = None
            if op in (STORED, FORCE):
                insert(keys)
            elif op == DELETE:
                table.delete(keys)
                held -= len(keys)
            else:
                _, first = np.unique(keys, return_index=True)
                hit = np.ones(len(keys), bool)
                hit[first] = table.contains(keys[first])
                if op == ADD:
                    insert(keys[~hit])
                else:
                    hit = table.contains(keys)
            if op >= DELETE:
                flags = pa.array(hit) if hit is not None else pa.nulls(len(keys), pa.bool_())
                yield pa.RecordBatch.from_arrays([*part.columns, flags], schema=fields)
    yield from end()


def _keys(digests: pa.Array) -> np.ndarray:
    """The first 64 bits of fixed-length digests."""
    rows = len(digests)
    ends = np.frombuffer(digests.buffers()[1], np.int32)[digests.offset : digests.offset + rows + 1]
    flat = np.frombuffer(digests.buffers()[2], np.uint8)[ends[0] : ends[-1]]
    return flat.reshape(rows, -1)[:, :8].copy().view(np.uint64).ravel()


def normalised(text: str = "text") -> Column:
    """The text without white space; null counts as empty."""
    return without(content(text), SPACE_CHARS)


def dedup(
    docs: DataFrame, index: DigestIndex, *, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: key, keep_id, group_size, kept, known, text_sha256, text_hash.

    Texts are equal when they are without white space. Of equal ones, the row with the most code
    points, then the smallest key stays; a null key counts as larger than any. With several rows of
    one key and text each counts, and each of the rows that stays is kept. ``known`` marks texts
    that the index held before; then no row is kept. ``text_hash`` is of the row's whole text, white
    space included: it tells rows of one key apart. Texts are read whole, however long; other
    columns are not read. Empty tables give no rows.

    Copies are counted in each map task and in as many parts as the shuffle has before they meet: a
    third of all rows may be one text.
    """
    salts = max(32, parallelism(docs.sparkSession))
    digest = F.unhex(F.sha2(normalised(text), 256))
    keyed = docs.select(
        F.col(key).alias("key"),
        digest.alias("digest"),
        F.char_length(content(text)).cast("long").alias("points"),
        F.pmod(F.xxhash64(key), F.lit(salts)).cast("int").alias("salt"),
        F.xxhash64(content(text)).alias("text_hash"),
    )
    keyed = written(keyed, "keyed")
    rows = keyed.groupBy("digest", "salt", "points").agg(
        F.count("*").alias("n"), F.min("key").alias("key")
    )
    probed, known = index.add(rows)
    # Verification: rows of hit digests meet by the whole digest; the others are alone.
    alone = probed.join(known, "digest", "left_anti").select(
        "digest",
        F.col("n").alias("group_size"),
        F.col("key").alias("keep"),
        F.col("points").alias("most"),
        F.lit(False).alias("known"),
    )
    groups = (
        probed.join(known, "digest")
        .groupBy("digest", "points")
        .agg(F.sum("n").alias("n"), F.min("key").alias("key"), F.max("known").alias("known"))
        .groupBy("digest")
        .agg(
            F.sum("n").alias("group_size"),
            F.max_by("key", "points").alias("keep"),
            F.max("points").alias("most"),
            F.max("known").alias("known"),
        )
    )
    parts = probed.select("digest", "salt").distinct().join(groups.unionByName(alone), "digest")
    stays = (F.col("key").eqNullSafe(F.col("keep"))) & (F.col("points") == F.col("most"))
    return keyed.join(parts, ["digest", "salt"]).select(
        F.col("key").alias(key),
        F.col("keep").alias("keep_id"),
        "group_size",
        (stays & ~F.col("known")).alias("kept"),
        "known",
        F.lower(F.hex("digest")).alias("text_sha256"),
        "text_hash",
    )
