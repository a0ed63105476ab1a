"""N-gram Jaccard join by MinHash banding.

Texts are compared as sets of word n-grams. Band and row counts follow from the target recall at
the threshold; the shuffle is on band hashes; candidate pairs are verified on whole n-gram sets.
Pairs live inside tasks only: what leaves them is a count of links and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import (
    Hashes,
    components,
    content,
    join_spread,
    map_batches,
    mixed,
    parallelism,
    utf8,
    whole_groups,
    word_spans,
    written,
)

#: Texts of one bucket that meet in a task; a larger bucket is cut, and each two parts meet.
BLOCK = 256


def choose_bands(threshold: float, recall: float, hashes: int = 128) -> tuple[int, int]:
    """Bands and rows a band: the most rows (fewest chance candidates) that reach the recall.

    A pair at the threshold s shares a band of r rows with probability s ** r, and one of b bands
    with 1 - (1 - s ** r) ** b. At most ``hashes`` hashes in all.
    """
    best = None
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows)))
        if bands * rows <= hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("the recall needs more hashes")
    return best


def gram_hashes(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word n-grams of every row, and the offsets of the rows.

    A text of fewer words, one at least, is one gram of all its words. Repeats stay.
    """
    flat, offsets = utf8(column)
    starts, ends, rows = word_spans(flat, offsets)
    texts = len(offsets) - 1
    counts = np.bincount(rows, minlength=texts)
    words = mixed(Hashes(flat).of(starts, ends) + (ends - starts).astype(np.uint64))
    sums = np.zeros(len(words), np.uint64)
    first = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(len(words)) - first[rows]
    width = np.minimum(counts[rows], n)
    for k in range(n):
        inside = k < width
        ahead = np.zeros(len(words), np.uint64)
        ahead[: len(words) - k] = words[k:]
        sums += np.where(inside, mixed(ahead + np.uint64(k + 1)), np.uint64(0))
    whole = place + width <= counts[rows]
    grams = mixed(sums[whole])
    return grams, np.concatenate([[0], np.cumsum(np.bincount(rows[whole], minlength=texts))])


def gram_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As ``gram_hashes``, each row's distinct grams in order."""
    grams, offsets = gram_hashes(column, n)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    counts = np.bincount(rows[new], minlength=len(offsets) - 1)
    return grams[new], np.concatenate([[0], np.cumsum(counts)])


def band_hashes(grams: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """The band hashes of every row that has grams: (rows with grams, bands)."""
    starts = offsets[:-1][np.diff(offsets) > 0]
    made = np.zeros((len(starts), bands), np.uint64)
    if not len(starts):
        return made
    seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64)).reshape(-1, 2)
    seeds[:, 1] |= np.uint64(1)
    buffer = np.empty_like(grams)
    for band in range(bands):
        total = np.full(len(starts), band + 1, np.uint64)
        for add, factor in seeds[band * rows : (band + 1) * rows]:
            np.bitwise_xor(grams, add, out=buffer)
            np.multiply(buffer, factor, out=buffer)
            total = mixed(total + np.minimum.reduceat(buffer, starts))
        made[:, band] = total
    return made


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """``docs`` (key, content) with two hashes of the text and the bands (null without a word)."""
    kind = docs.schema["key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, offsets = gram_hashes(batch.column("content"), n)
        made = band_hashes(grams, offsets, bands, rows).astype("<u8")
        found = iter(made)
        cells = [next(found).tobytes() if some else None for some in np.diff(offsets) > 0]
        columns = [batch.column(c) for c in ("key", "one", "two")] + [pa.array(cells, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, names=["key", "one", "two", "bands"])

    hashed = docs.select("key", *_digest(F.col("content")), "content")
    return map_batches(hashed, run, f"key {kind}, one long, two long, bands binary")


def _digest(text) -> list:
    """128 bits that stand for a text."""
    return [F.xxhash64(text).alias("one"), F.xxhash64(F.lit("2"), text).alias("two")]


def _blocked(members: DataFrame, key: str) -> DataFrame:
    """Members of buckets of two or more, once for each pair of parts of the bucket they're in."""
    counts = members.groupBy(key).agg(F.count("*").alias("m")).where("m > 1")
    parts = F.ceil(F.col("m") / BLOCK).cast("int")
    rows = members.join(counts, key).withColumn("parts", parts)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("parts") - 1),
        lambda i: F.least(i, F.col("part")) * F.col("parts") + F.greatest(i, F.col("part")),
    )
    rows = rows.withColumn("block", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(pairs)))
    return rows.withColumn("cross", F.pmod("block", F.col("parts")) != F.floor(F.col("block") / F.col("parts")))


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows of one block in one task, together."""
    spread = rows.repartition(parallelism(rows.sparkSession), key, "block")
    return spread.sortWithinPartitions(key, "block", "node")


def _wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of a bucket that have a partner whose first common band is the bucket's."""
    for part, starts in whole_groups(batches, ["bucket", "block"]):
        bands = _matrix(part.column("bands"))
        band, share = part.column("band").to_numpy(), part.column("part").to_numpy()
        cross = part.column("cross").to_numpy(zero_copy_only=False)
        wanted = np.zeros(part.num_rows, bool)
        group = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
        largest = int(np.diff(starts).max())
        for lag in range(1, largest):
            one = np.flatnonzero(group[lag:] == group[:-lag])
            if not len(one):
                break
            two = one + lag
            one = one[~cross[one] | (share[one] != share[two])]
            two = one + lag
            first = (bands[one] == bands[two]).argmax(axis=1) == band[one]
            wanted[one[first]] = wanted[two[first]] = True
        if wanted.any():
            kept = part.filter(pa.array(wanted))
            yield pa.RecordBatch.from_arrays(
                [kept.column("bucket"), kept.column("node"), kept.column("band")],
                names=["bucket", "node", "band"],
            )


def _matrix(column: pa.Array) -> np.ndarray:
    """Equally long binary cells as rows of 64-bit numbers."""
    flat, offsets = utf8(column)
    return np.frombuffer(flat.tobytes(), "<u8").reshape(len(offsets) - 1, -1)


def _verifier(threshold: float, n: int):
    """Links of a bucket's texts, on their whole sets: counts, and a forest that joins them."""
    limit = Fraction(threshold).limit_denominator(1000)
    # common / (a + b - common) >= p / q, in whole numbers
    left, right = limit.numerator + limit.denominator, limit.numerator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, starts in whole_groups(batches, ["bucket", "block"]):
            node = part.column("node").to_numpy()
            bands = _matrix(part.column("bands"))
            band, share = part.column("band").to_numpy(), part.column("part").to_numpy()
            cross = part.column("cross").to_numpy(zero_copy_only=False)
            copies = part.column("copies").to_numpy()
            grams, offsets = _cells(part.column("grams"))
            made = []
            for start, end in zip(starts, starts[1:], strict=False):
                rows = start + np.unique(node[start:end], return_index=True)[1]  # repeated rows
                sets = [grams[offsets[r] : offsets[r + 1]] for r in rows]
                sizes = np.array([len(s) for s in sets])
                common = shared_counts(sets)
                linked = left * common >= right * (sizes[:, None] + sizes[None, :])
                first = np.empty_like(linked)
                for i, r in enumerate(rows):
                    first[i] = (bands[rows] == bands[r]).argmax(axis=1) == band[r]
                linked &= first
                if cross[start]:
                    linked &= share[rows][:, None] != share[rows][None, :]
                np.fill_diagonal(linked, False)
                if not linked.any():
                    continue
                roots = forest(linked)
                some = linked.any(axis=1)
                made.append(
                    np.stack(
                        [
                            node[rows][some],
                            linked[some].sum(axis=1),
                            (linked[some] * copies[rows]).sum(axis=1),
                            node[rows][roots[some]],
                        ]
                    )
                )
            if made:
                columns = np.concatenate(made, axis=1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], names=["node", "texts", "links", "root"]
                )

    return run


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    flat, offsets = utf8(column)
    return np.frombuffer(flat.tobytes(), "<u8"), offsets // 8


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two of some sets (at most a block's) share."""
    values = np.concatenate(sets)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, counts = np.unique(values, return_inverse=True, return_counts=True)
    several = counts[place] > 1
    _, place = np.unique(place[several], return_inverse=True)
    rows = rows[several]
    common = np.zeros((len(sets), len(sets)), np.float32)
    width = 4096
    order = np.argsort(place, kind="stable")
    place, rows = place[order], rows[order]
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, [low, low + width])
        held = np.zeros((len(sets), width), np.float32)
        held[rows[a:b], place[a:b] - low] = 1
        common += held @ held.T
    return common.astype(np.int64)


def forest(linked: np.ndarray) -> np.ndarray:
    """The first row of each row's component."""
    roots = np.full(len(linked), -1)
    for row in range(len(linked)):
        if roots[row] < 0:
            front = np.zeros(len(linked), bool)
            front[row] = True
            reached = front.copy()
            while front.any():
                front = linked[front].any(axis=0) & ~reached
                reached |= front
            roots[reached] = row
    return roots


def join(
    docs: DataFrame,
    *,
    n: int = 5,
    threshold: float = 0.8,
    recall: float = 0.9999,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: key, class_id, n_links, n_texts, class_size, stays, text_hash.

    Two documents are linked when the Jaccard similarity of their sets of word ``n``-grams is at
    least ``threshold``; words are separated by white space and compared as they are. A text of
    fewer than ``n`` words is one gram of all of them; one without a word (or null) links to
    nothing. ``n_links`` counts linked documents, copies of the text included, ``n_texts`` linked
    texts other than its own. ``class_id`` is the smallest key of the documents that links connect
    (its own if none); ``stays`` holds for one row of each class, and for texts without a word;
    ``text_hash`` is Spark's xxhash64 of the text. Null and repeated keys are rows like others, other columns are not read,
    empty tables give no rows. A very long text is compared whole; the task that hashes its n-grams
    holds some forty times its bytes.

    Copies of a text collapse first; only one of each is compared. Each pair of texts that shares
    a band is verified once, in the bucket of its first common band, whatever the bucket's size:
    a bucket of more than ``BLOCK`` texts is cut into parts, and each two parts meet in a task.
    """
    bands, rows = choose_bands(threshold, recall)
    texts = docs.select(F.col(key).alias("key"), content(text).alias("content"))
    signed = signatures(texts, n, bands, rows).withColumn("row", F.monotonically_increasing_id())
    signed = written(signed, "signatures")  # from here on the row numbers are fixed
    classes = signed.groupBy("one", "two").agg(
        F.min("row").alias("node"), F.count("*").alias("copies"), F.min("key").alias("least")
    )
    classes = written(classes, "classes")
    single = written(
        signed.where("bands IS NOT NULL")
        .select(F.col("row").alias("node"), "key", "bands")
        .join(classes, "node"),
        "texts",
    )
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda i: F.struct(i.alias("band"), F.xxhash64(F.substring("bands", i * 8 + 1, F.lit(8))).alias("bucket")),
    )
    banded = single.select("node", F.inline(cells))
    members = _blocked(banded, "bucket").join(single.select("node", "bands"), "node")
    wanted = _dealt(members, "bucket").mapInArrow(_wanted, "bucket long, node long, band int")
    wanted = written(wanted.distinct(), "wanted")
    whole = single.join(wanted.select("node").distinct(), "node", "left_semi")
    whole = texts.select("key", *_digest(F.col("content")), "content").join(
        whole.select("node", F.col("key").alias("k"), F.col("one").alias("o"), F.col("two").alias("t"), "copies", "bands"),
        F.col("key").eqNullSafe(F.col("k")) & (F.col("one") == F.col("o")) & (F.col("two") == F.col("t")),
    ).select("node", "copies", "bands", "content")

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        grams, offsets = gram_sets(batch.column("content"), n)
        grams = grams.astype("<u8")
        cells = [grams[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)]
        kept = ["node", "copies", "bands"]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(cells, pa.binary())], names=[*kept, "grams"]
        )

    sized = map_batches(whole, sets, "node long, copies long, bands binary, grams binary")
    meeting = _blocked(wanted, "bucket").join(sized, "node")
    found = _dealt(meeting, "bucket").mapInArrow(
        _verifier(threshold, n), "node long, texts long, links long, root long"
    )
    found = written(found, "links")
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degrees = found.groupBy("node").agg(F.sum("texts").alias("texts"), F.sum("links").alias("links"))
    joined = classes.join(degrees, "node", "left").join(roots, "node", "left")
    joined = written(joined.withColumn("root", F.coalesce("root", "node")), "roots")
    groups = joined.groupBy("root").agg(
        F.min("least").alias("class_least"),
        F.sum("copies").alias("class_docs"),
        F.min_by("node", "least").alias("first"),
    )
    joined = join_spread(joined, groups, ["root"], F.col("node")).select(
        "one", "two", "copies", "texts", "links", "class_least", "class_docs", F.coalesce("first", "root").alias("first")
    )
    has_words = F.col("bands").isNotNull()
    return join_spread(signed, joined, ["one", "two"], F.col("row")).select(
        F.col("key").alias(key),
        F.when(has_words, F.col("class_least")).otherwise(F.col("key")).alias("class_id"),
        F.when(has_words, F.coalesce("links", F.lit(0)) + F.col("copies") - 1).otherwise(0).alias("n_links"),
        F.coalesce("texts", F.lit(0)).alias("n_texts"),
        F.when(has_words, F.col("class_docs")).otherwise(1).alias("class_size"),
        (~has_words | (F.col("row") == F.col("first"))).alias("stays"),
        F.col("one").alias("text_hash"),
    )
