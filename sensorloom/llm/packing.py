"""Best-fit decreasing packing of documents into token sequences.

Best-fit decreasing looks only at lengths, and there are at most ``capacity`` different ones. So the
plan is made on the histogram of lengths (a segment tree over remaining capacities finds the
tightest open bin), and documents take the places planned for their length by their rank in it.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import content, map_batches, parallelism, written
from sensorloom.llm.tokens import encoder

PIECES = "piece int, start long, length long, ids binary"


def cut(
    docs: DataFrame,
    tokenizer: str,
    *,
    capacity: int = 2048,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Pieces of the documents: key, piece, start, length and the ids (little-endian uint32).

    A document is the ids of its whole text (null: empty) and one ``end_id``. One that is longer
    than ``capacity`` is cut into pieces of that length; the first piece takes the remainder.
    Null and repeated keys stay as they are; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("content").to_pylist()
        rows, numbers, starts, lengths, ids = [], [], [], [], []
        for row, made in enumerate(encoder(tokenizer).encode(texts)):
            whole = np.append(made, np.uint32(end_id)).astype("<u4")
            first = len(whole) % capacity or capacity
            edges = [0, *range(first, len(whole) + 1, capacity)]
            for number, (start, end) in enumerate(zip(edges, edges[1:], strict=False)):
                rows.append(row)
                numbers.append(number)
                starts.append(start)
                lengths.append(end - start)
                ids.append(whole[start:end].tobytes())
        return pa.RecordBatch.from_arrays(
            [
                batch.column("key").take(pa.array(rows, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            names=["key", "piece", "start", "length", "ids"],
        )

    rows = docs.select(F.col(key).alias("key"), content(text).alias("content"))
    return map_batches(rows, run, f"key {kind}, {PIECES}").withColumnRenamed("key", key)


class CapacityTree:
    """Segment tree over remaining capacities: which of them have an open bin."""

    def __init__(self, capacity: int) -> None:
        self.size = 1
        while self.size <= capacity:
            self.size *= 2
        self.open = [False] * (2 * self.size)

    def mark(self, capacity: int, is_open: bool) -> None:
        node = self.size + capacity
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest capacity of at least ``least`` that has an open bin."""
        node = self.size + least
        while not self.open[node]:
            while node & 1:  # a right child: nothing larger below its parent
                node //= 2
            if not node:
                return None
            node += 1
        while node < self.size:
            node = 2 * node if self.open[2 * node] else 2 * node + 1
        return node - self.size


def plan(histogram: dict[int, int], capacity: int) -> np.ndarray:
    """Best-fit decreasing over lengths: rows (length, first rank, bin, items a bin, offset).

    Items of one length are interchangeable, and so are bins of one remaining capacity: the
    tightest bin takes items of a length until the next doesn't fit, then the next such bin does.
    So runs of bins are planned at once. A run has at most one partly filled bin for each length,
    and a bin holds at most 63 different lengths of up to 2048; the plan is bounded by the capacity
    (some 400,000 rows at 2048), not by the number of documents.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # remaining capacity: bins [a, b)
    steps, bins = [], 0

    def put(left: int, first: int, last: int) -> None:
        if left and first < last:
            runs[left].append((first, last))
            tree.mark(left, True)

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while count:
            left = tree.tightest(length)
            if left is None:
                left = capacity
                fits = capacity // length
                first, last = bins, bins + -(-count // fits)
                bins = last
            else:
                fits = left // length
                first, last = runs[left].pop()
                if not runs[left]:
                    tree.mark(left, False)
            whole = min(last - first, count // fits)
            if whole:
                steps.append((length, rank, first, fits, capacity - left))
                put(left - fits * length, first, first + whole)
                rank, count, first = rank + whole * fits, count - whole * fits, first + whole
            if count and first < last:
                steps.append((length, rank, first, fits, capacity - left))
                put(left - count * length, first, first + 1)
                count, first = 0, first + 1
            put(left, first, last)
    return np.array(steps, np.int64).reshape(-1, 5)


def place(pieces: DataFrame, *, capacity: int = 2048, order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """The rows of ``pieces`` with sequence_id and offset: as few sequences as best fit finds.

    ``pieces`` has a ``length`` from 1 to ``capacity``; its other columns stay. It is read twice,
    so it should be a written table. Ranks in a length are counted in hash buckets of ``order`` and
    then summed over the buckets: no task ever holds a whole length. Rows that are equal in
    ``order`` are interchangeable, null is a value like others, no rows give no rows.
    """
    spark = pieces.sparkSession
    buckets = parallelism(spark)
    # A plain number of its own columns: the same for a row whenever it is computed again.
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counted = written(bucketed.groupBy("length", "_bucket").agg(F.count("*").alias("_n")), "lengths")
    totals = counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # capacity rows at most
    steps = plan({r["length"]: r["n"] for r in totals}, capacity)
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select(
        "length", "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    inside = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = (
        bucketed.withColumn("_rank", F.row_number().over(inside) - 1)
        .join(before.hint("merge"), ["length", "_bucket"])  # both are dealt out by these already
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
        .drop("_bucket", "_before")
    )
    steps = steps[np.lexsort((steps[:, 1], steps[:, 0]))]
    shared = spark.sparkContext.broadcast(steps)  # bounded by the capacity, see plan()

    def seat(batch: pa.RecordBatch) -> pa.RecordBatch:
        steps = shared.value
        length = batch.column("length").to_numpy()
        rank = batch.column("_rank").to_numpy()
        low = np.searchsorted(steps[:, 0], length, side="left")
        high = np.searchsorted(steps[:, 0], length, side="right")
        while (open_ := high - low > 1).any():  # the last step of the length that starts by the rank
            middle = np.where(open_, (low + high) // 2, low)
            after = steps[middle, 1] > rank
            high = np.where(open_ & after, middle, high)
            low = np.where(open_ & ~after, middle, low)
        _, first_rank, bin_, fits, offset = steps[low].T
        number, place_ = np.divmod(rank - first_rank, fits)
        kept = [c for c in batch.schema.names if c != "_rank"]
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept]
            + [pa.array(bin_ + number), pa.array(offset + place_ * length)],
            names=[*kept, "sequence_id", "offset"],
        )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema if f.name != "_rank")
    return map_batches(ranked, seat, f"{fields}, sequence_id long, offset long").select(
        *pieces.columns, "sequence_id", "offset"
    )


def pack(
    docs: DataFrame, tokenizer: str, *, capacity: int = 2048, end_id: int = 0, key: str = "doc_id"
) -> DataFrame:
    """Pieces of ``docs`` with their ids and their places: what a trainer's reader needs."""
    pieces = written(cut(docs, tokenizer, capacity=capacity, end_id=end_id, key=key), "pieces")
    return place(pieces, capacity=capacity, order=(key, "piece"))
