"""Centroid clustering with heap-ordered bounds.

Every vector has a gap: how much nearer its centroid is than the next one. Each cluster keeps a
heap of its vectors by gap, offset by the drift that had accumulated when they came in. A round
moves the centroids and raises the drift; only vectors whose gap the drift has reached are popped
and scanned against all centroids, exactly. All others keep their cluster, which is proved by the
triangle inequality.

Vectors lie in blocks of a table bucketed by block. A round joins the blocks to their heaps without
shuffling vectors, and sends on the sums of those vectors alone that changed their cluster.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import parallelism, written
from sensorloom.sources.tables import bucketed_table, delete_path

BLOCK = 4096
#: Components must fit so that a squared distance fits a long.
LARGEST = 1 << 27
#: Distances are at most 2 ** 31, so rounding moves a gap and the drift by far less than this.
SLACK = 1e-3
STATE = "block long, cluster binary, gaps binary, heap binary, moved array<long>, scanned long"


@dataclass
class Centroids:
    """Centroids of a round, the vectors they are the means of, and how far each has drifted."""

    points: np.ndarray
    sums: np.ndarray
    counts: np.ndarray
    drift: np.ndarray

    def updated(self, moved: np.ndarray) -> Centroids:
        """After a round in which sums and counts changed by ``moved`` (a row for each centroid)."""
        sums, counts = self.sums + moved[:, :-1], self.counts + moved[:, -1]
        some = counts > 0
        points = self.points.copy()
        points[some] = sums[some] // counts[some, None]
        step = np.sqrt(squared(points, self.points).astype(float))
        # A vector may have lost its own centroid's step and the longest of all others'.
        others = np.array([np.delete(step, i).max(initial=0) for i in range(len(step))])
        return Centroids(points, sums, counts, self.drift + step + others)


def squared(points: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Exact squared distances, row by row."""
    apart = points.astype(np.int64) - to
    return np.einsum("ij,ij->i", apart, apart)


def packed(vectors: DataFrame, scale: int) -> DataFrame:
    """Blocks of vectors (key, vector): ``block, keys, points``; components times ``scale``, floored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                points = np.floor(part.column("vector").flatten().to_numpy() * float(scale))
                if np.abs(points).max(initial=0) > LARGEST:
                    raise ValueError(f"a component times {scale} is beyond {LARGEST}: distances would not fit a long")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("key")),
                        pa.array([points.astype(np.int32).tobytes()]),
                    ],
                    names=["keys", "points"],
                )

    kind = vectors.schema["key"].dataType.simpleString()
    blocks = vectors.mapInArrow(run, f"keys array<{kind}>, points binary")
    return blocks.select(F.monotonically_increasing_id().alias("block"), "*")


def whole_vectors(vectors: DataFrame, size: int, *, key: str, vector: str) -> DataFrame:
    """Rows (key, vector) with ``size`` components, all of them finite numbers."""
    values = F.col(vector).cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where((F.size(vector) == size) & ~odd).select(F.col(key).alias("key"), values.alias("vector"))


def start(vectors: DataFrame, count: int, seed: str, scale: int) -> np.ndarray:
    """The vectors with the smallest hashes of ``seed:key``; of equal hashes, the smaller vector."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))), 256)
    rows = vectors.orderBy(order, "vector").limit(count).select("vector").collect()
    return np.floor(np.array([r["vector"] for r in rows]) * float(scale)).astype(np.int64)


def rescanned(points: np.ndarray, cluster: np.ndarray, gaps: np.ndarray, heap: np.ndarray, now: Centroids):
    """One round over a block: clusters, gaps and heap afterwards, what moved, and what was scanned.

    ``heap`` holds rows by cluster, ``gaps`` their gaps, rising inside a cluster: a sorted run is a
    heap whose expired entries are its first ones, so one search pops them all. Cluster -1 is new.
    """
    k = len(now.points)
    sizes = np.bincount(cluster[cluster >= 0], minlength=k)
    cuts = np.concatenate([[0], np.cumsum(sizes)])
    kept = np.zeros(len(heap), bool)
    for c, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        kept[a + np.searchsorted(gaps[a:b], now.drift[c] + SLACK, side="right") : b] = True
    popped = np.concatenate([heap[~kept], np.flatnonzero(cluster < 0)]).astype(np.int64)
    far = np.stack([squared(points[popped], c) for c in now.points], axis=1)
    found = far.argmin(axis=1)
    nearest = np.sqrt(far.min(axis=1).astype(float))
    np.put_along_axis(far, found[:, None], np.iinfo(np.int64).max, axis=1)
    second = np.sqrt(far.min(axis=1).astype(float)) if k > 1 else np.full(len(popped), np.inf)

    moved = np.zeros((k, points.shape[1] + 1), np.int64)
    for c in range(k):
        came, went = popped[(found == c) & (cluster[popped] != c)], popped[(found != c) & (cluster[popped] == c)]
        moved[c, :-1] = points[came].sum(axis=0, dtype=np.int64) - points[went].sum(axis=0, dtype=np.int64)
        moved[c, -1] = len(came) - len(went)
    cluster = cluster.copy()
    cluster[popped] = found
    heap = np.concatenate([heap[kept], popped]).astype(np.int32)
    gaps = np.concatenate([gaps[kept], second - nearest + now.drift[found]])
    order = np.lexsort((gaps, cluster[heap]))
    return cluster, gaps[order], heap[order], moved, len(popped)


def _round(blocks: DataFrame, state: DataFrame | None, now: Centroids, dimension: int) -> DataFrame:
    """State of every block after a round; without a state, of a first one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points, (cluster, gaps, heap) = _opened(batch, i, dimension)
                cluster, gaps, heap, moved, scanned = rescanned(points, cluster, gaps, heap, now)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("block").slice(i, 1),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (cluster, gaps, heap)),
                        pa.array([moved.ravel().tolist()], pa.list_(pa.int64())),
                        pa.array([scanned]),
                    ],
                    names=["block", "cluster", "gaps", "heap", "moved", "scanned"],
                )

    return _joined(blocks, state).select("block", "points", "cluster", "gaps", "heap").mapInArrow(run, STATE)


def _joined(blocks: DataFrame, state: DataFrame | None) -> DataFrame:
    if state is None:
        return blocks.select("*", *(F.lit(None).cast("binary").alias(c) for c in ("cluster", "gaps", "heap")))
    return blocks.join(state.drop("moved", "scanned"), "block")


def _opened(batch: pa.RecordBatch, i: int, dimension: int):
    points = np.frombuffer(batch.column("points")[i].as_buffer(), np.int32).reshape(-1, dimension)
    if batch.column("cluster")[i].as_py() is None:
        return points, (np.full(len(points), -1, np.int16), np.zeros(0), np.zeros(0, np.int32))
    kinds = {"cluster": np.int16, "gaps": np.float64, "heap": np.int32}
    return points, [np.frombuffer(batch.column(c)[i].as_buffer(), kind) for c, kind in kinds.items()]


def _placed(blocks: DataFrame, state: DataFrame, now: Centroids, dimension: int) -> DataFrame:
    """(key, cluster, distance) of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                points, (cluster, gaps, heap) = _opened(batch, i, dimension)
                cluster, *_ = rescanned(points, cluster, gaps, heap, now)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("keys").slice(i, 1).flatten(),
                        pa.array(cluster.astype(np.int32)),
                        pa.array(squared(points, now.points[cluster])),
                    ],
                    names=["key", "cluster", "distance"],
                )

    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    return _joined(blocks, state).mapInArrow(run, f"key {kind}, cluster int, distance long")


def fit(vectors: DataFrame, *, count: int, rounds: int, dimension: int, scale: int, seed: str):
    """Rounds over (key, vector): (key, cluster, distance) written, centroids, vectors scanned by round.

    The driver holds the centroids and, each round, their sums: ``count * (dimension + 1)`` numbers.
    """
    spark = vectors.sparkSession
    points = start(vectors, count, seed, scale)
    k = len(points)
    if not k:
        return None, points, []
    blocks, drop_blocks = bucketed_table(packed(vectors, scale), "block", parallelism(spark), "vectors")
    now = Centroids(points, np.zeros_like(points), np.zeros(k, np.int64), np.zeros(k))
    state, scans = None, []
    for _ in range(rounds):
        before, state = state, written(_round(blocks, state, now, dimension), "heaps")
        if before is not None:
            _forget(before)  # the next round reads its own state only
        moved = np.zeros(k * (dimension + 1), np.int64)
        for row in state.select(F.posexplode("moved")).groupBy("pos").agg(F.sum("col").alias("by")).collect():
            moved[row["pos"]] = row["by"]
        scans.append(state.agg(F.sum("scanned")).first()[0])
        now = now.updated(moved.reshape(k, -1))
    made = written(_placed(blocks, state, now, dimension), "clusters")
    _forget(state)
    drop_blocks()
    return made, now.points, scans


def _forget(table: DataFrame) -> None:
    files = table.inputFiles()
    if files:
        delete_path(table.sparkSession, files[0].rsplit("/", 1)[0])


def cluster(
    vectors: DataFrame,
    *,
    count: int = 8,
    rounds: int = 10,
    dimension: int = 64,
    scale: int = 1024,
    seed: str = "3",
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Cluster of every whole vector: key, cluster, distance, both inertias, hash of its centroid.

    Vectors that are null, of another size or hold a null, NaN or infinite component are left out.
    Components are integers (times ``scale``, floored), so all sums and distances are exact and the
    result doesn't depend on partitions; one beyond ``LARGEST`` is an error. Ties go to the smaller
    cluster. Null keys read as the empty text in the choice of the first centroids, and among equal
    keys the smaller vector comes first; repeated rows count again. Fewer vectors than ``count``
    make fewer clusters, an empty table gives no rows. Other columns are not read.
    """
    spark = vectors.sparkSession
    kind = vectors.schema[key].dataType.simpleString()
    rows = whole_vectors(vectors, dimension, key=key, vector=vector)
    made, points, _ = fit(rows, count=count, rounds=rounds, dimension=dimension, scale=scale, seed=seed)
    schema = f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if made is None:
        return spark.createDataFrame([], schema)
    sums = {r["cluster"]: r["s"] for r in made.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, p)).encode()).hexdigest() for p in points.tolist()]
    at = F.col("cluster") + 1
    return made.select(
        F.col("key").alias(key),
        "cluster",
        "distance",
        F.element_at(F.array(*(F.lit(sums.get(c, 0)).cast("long") for c in range(len(names)))), at).alias("cluster_inertia"),
        F.lit(sum(sums.values())).cast("long").alias("inertia"),
        F.element_at(F.array(*map(F.lit, names)), at).alias("centroid_sha256"),
    )
