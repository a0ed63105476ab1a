"""Helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.session import scratch_dir

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
#: The white space that separates words, as a character class and as the characters themselves.
SPACES = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Text bytes that one vectorised step of a Python task works on.
STEP_BYTES = 4 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table; only the columns that a query uses are read."""
    return spark.read.schema(DOCUMENTS).parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared scratch folder and read again: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    """Partitions for keyed work, as the cluster sets them."""
    return max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))


def content(text: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def join_spread(rows: DataFrame, few: DataFrame, keys: list[str], spread: Column) -> DataFrame:
    """Join written ``rows`` to the one row of ``few`` for their keys, however many share a key.

    The rows of a key are dealt out over as many parts as the shuffle has; ``few`` is joined once
    for each part that is there (distinct collapses them in the map tasks), so no task gets all
    rows of a hot key.
    """
    parts = max(32, parallelism(rows.sparkSession))
    dealt = rows.withColumn("_part", F.pmod(spread, F.lit(parts)).cast("int"))
    there = dealt.select(*keys, "_part").distinct().join(few, keys)
    return dealt.join(there, [*keys, "_part"]).drop("_part")


def labelled(
    docs: DataFrame, labels: DataFrame, column: str, *, held_out: Column, key: str, text: Column, limit: int
) -> DataFrame:
    """A bounded sample of labelled texts: (label, content), at most ``limit`` of each label, 0 and 1.

    Keys with the smallest hashes are chosen, of their texts again those with the smallest hashes: a
    key that very many rows share brings no more than ``limit`` texts. Copies under one key count once.
    """
    known = labels.where(F.col(column).isin(0, 1) & ~held_out)
    known = known.select(F.col(key).alias("key"), F.col(column).cast("long").alias("label")).distinct()

    def least(rows: DataFrame, *by: str) -> DataFrame:
        order = F.md5(F.concat_ws("|", *(F.col(c).cast("string") for c in by)))
        some = [rows.where(F.col("label") == label).orderBy(order, *by).limit(limit) for label in (0, 1)]
        return F.broadcast(some[0].unionByName(some[1]))

    texts = docs.select(F.col(key).alias("key"), text.alias("content")).join(least(known, "key"), "key")
    texts = texts.withColumn("_mark", F.md5("content"))
    picked = written(texts.select("key", "label", "_mark").distinct(), "picked")
    rows = texts.join(least(picked, "key", "_mark"), ["key", "label", "_mark"])
    return written(rows.select("key", "label", "content").distinct().select("label", "content"), "labelled")


def without(column: Column, characters: str) -> Column:
    """The text without some characters, each a plain byte search."""
    for character in characters:
        column = F.replace(column, F.lit(character), F.lit(""))
    return column


def hashed_share(column: Column, modulus: int) -> Column:
    """crc32 of a value written as text, modulo; null counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % modulus


def map_batches(
    df: DataFrame,
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
    limit: int = STEP_BYTES,
) -> DataFrame:
    """Apply a function from Arrow batch to Arrow batch, about ``limit`` bytes of rows at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, limit):
                made = work(piece)
                if made is not None and made.num_rows:
                    yield made

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about ``limit`` bytes, one row at least."""
    rows = batch.num_rows
    if not rows:
        return
    sizes = np.zeros(rows, np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
            ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + rows + 1]
            sizes += np.diff(ends)
    part = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for start, end in zip([0, *cuts], [*cuts, rows], strict=True):
        yield batch.slice(start, end - start)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column (null: empty) and the offsets of its rows."""
    rows = len(column)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + rows + 1]
    data = column.buffers()[2]
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(rows + 1, np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]
    return flat, (ends - ends[0]).astype(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (an avalanche step; one value in, one value out)."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


_TABLE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0, 1, ... modulo 2 ** 64."""
    kept = _powers.get(base)
    if kept is None or len(kept) < count:
        kept = np.full(max(count, 1 << 16), base, np.uint64)
        kept[0] = 1
        kept = _powers[base] = np.cumprod(kept, dtype=np.uint64)
    return kept[:count]


class Hashes:
    """64-bit hashes of any substrings of a byte array, each from two prefix sums."""

    def __init__(self, flat: np.ndarray) -> None:
        self.sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum(_TABLE[flat] * powers(_BASE, len(flat)), dtype=np.uint64, out=self.sums[1:])
        self.back = powers(_BASE_INVERSE, len(flat) + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hash of the bytes [start, end); equal bytes give equal hashes at any place."""
        return (self.sums[ends] - self.sums[starts]) * self.back[starts]

    def grams(self, length: int) -> np.ndarray:
        """Hash of every substring of that length, by its start."""
        count = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:count]) * self.back[:count]


#: Bytes of words: all but white space; and of letter runs: ASCII letters, digits, all of others.
IN_WORD = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
IN_LETTERS = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def word_spans(
    flat: np.ndarray, offsets: np.ndarray, solid_bytes: np.ndarray = IN_WORD
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word in the bytes, and the row that holds it.

    Words never cross rows: the end of a row also ends its last word.
    """
    solid = solid_bytes[flat]
    before = np.empty(len(flat), bool)
    before[:1] = False
    before[1:] = solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(flat))]
    before[inner] = False
    starts = np.flatnonzero(solid & ~before)
    after = np.empty(len(flat), bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(solid & ~after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


def pieces(
    flat: np.ndarray, offsets: np.ndarray, limit: int, solid_bytes: np.ndarray = IN_WORD
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and offsets of some rows, and the first of them: all at once, or a long text in pieces.

    A text is cut where no word goes on. Rows of up to two limits together are one piece.
    """
    if len(flat) <= 2 * limit:
        yield flat, offsets, 0
        return
    for row, (start, end) in enumerate(zip(offsets, offsets[1:], strict=False)):
        while start < end:
            cut = min(start + limit, end)
            while cut < end:
                seen = min(cut + (1 << 16), end)
                free = np.flatnonzero(~solid_bytes[flat[cut:seen]])
                cut = cut + free[0] if len(free) else seen
                if len(free):
                    break
            yield flat[start:cut], np.array([0, cut - start]), row
            start = cut


def whole_groups(
    batches: Iterator[pa.RecordBatch], columns: list[str]
) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Cut a stream that is sorted by some integer columns into parts that hold whole groups.

    Yields each part with the starts of its groups and its length at the end. Memory: a batch and
    the largest group.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        change = _changes(batch, columns)
        if held:
            last = held[-1].slice(held[-1].num_rows - 1)
            if not all(last.column(c)[0].equals(batch.column(c)[0]) for c in columns):
                yield _with_starts(held, columns)
                held = []
        if len(change):
            held.append(batch.slice(0, change[-1]))
            yield _with_starts(held, columns)
            held = [batch.slice(change[-1])]
        else:
            held.append(batch)
    if held:
        yield _with_starts(held, columns)


def _changes(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Rows that differ in a column from the row before."""
    moved = np.zeros(max(0, batch.num_rows - 1), bool)
    for column in columns:
        moved |= np.diff(batch.column(column).to_numpy()) != 0
    return np.flatnonzero(moved) + 1


def _with_starts(held: list[pa.RecordBatch], columns: list[str]) -> tuple[pa.RecordBatch, np.ndarray]:
    part = held[0] if len(held) == 1 else pa.concat_batches(held)
    return part, np.concatenate([[0], _changes(part, columns), [part.num_rows]])


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b) of long node numbers: (node, root), root the smallest.

    Alternates large-star and small-star steps until the edges are stars: a logarithmic number of
    rounds, each written to the shared folder. Only nodes with an edge are returned.
    """
    edges = written(edges.where("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = join_spread(both.where("b > a"), least, ["a"], F.xxhash64("b"))
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = join_spread(large, least, ["a"], F.xxhash64("b"))
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b"))
        )
        edges = written(small.where("a <> b").distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
