"""Removal of repeated passages by bucket-pointer refinement.

The suffixes of all texts are put into buckets by their first bytes, and buckets are refined by the
bucket numbers of later offsets, until suffixes in one bucket agree on ``length`` bytes. Two things
keep this from needing a row for each byte:

* Initial buckets are made at anchors only: of the q-grams in a window of ``length`` bytes, the one
  with the least hash. Equal windows have equal anchors, so a window can only repeat inside the
  bucket of its anchor. Neighbouring windows share anchors: about one byte in 35 is one.
* The windows of one anchor are a run of bytes. Runs that are equal as a whole are one class: all
  but the first are repeats. Only where a bucket holds different runs (where repeats begin or end)
  are its windows refined one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import Hashes, content, mixed, parallelism, slices, utf8, whole_groups, written

#: Bytes of the q-grams of the initial buckets.
GRAM = 32
#: Text bytes that are hashed at a time; a longer text is read in parts that overlap.
PART = 1 << 20
#: Bytes of runs that one bucket of the shuffle is to hold, and runs held at once in a task.
BUCKET_BYTES = 16 << 20
HELD_RUNS = 4_000_000
#: Different runs of one q-gram that are refined in one task: each of their bytes takes some 80.
REFINE_RUNS = 20_000
#: A run as it is shuffled: q-gram hash, hash of its bytes, key and tag of its document, place.
RUN = np.dtype([("gram", "<u8"), ("whole", "<u8"), ("doc", "<i8"), ("tag", "<i8"), ("place", "<i8")])
GONE, REFINE, BY_CONTENT = range(3)
FOUND = "kind int, key long, doc long, tag long, start long, stop long"
LAST_KEY = (1 << 63) - 1
#: place = start, and further windows of the run (12 bits).
START_AT = 12


def _parts(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return place >> START_AT, place & ((1 << START_AT) - 1)


def runs(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """The runs of windows with one anchor: q-gram hash, hash of the bytes, row, start, last."""
    none = tuple(np.zeros(0, np.int64) for _ in range(5))
    if len(flat) < length:
        return none
    hashes = Hashes(flat)
    grams = mixed(hashes.grams(GRAM))
    mask = np.uint64((1 << 24) - 1)
    least = grams & ~mask  # ties go to the leftmost place
    least |= np.arange(len(grams), dtype=np.uint64) & mask
    width, have = length - GRAM + 1, 1
    while have < width:  # least of ``have`` grams, doubled up to the width of a window
        step = min(have, width - have)
        np.minimum(least[:-step], least[step:], out=least[:-step])
        least, have = least[:-step], have + step
    starts = np.arange(len(least))
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    inside = starts + length <= offsets[rows + 1]
    anchor = starts + ((least & mask).astype(np.int64) - starts) % (1 << 24)
    starts, anchor, rows = starts[inside], anchor[inside], rows[inside]
    if not len(starts):
        return none
    new = np.ones(len(starts), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (np.diff(starts) != 1)
    first = np.flatnonzero(new)
    last = starts[np.append(first[1:], len(starts)) - 1]
    begin, at = starts[first], anchor[first]
    whole = mixed(hashes.of(begin, last + length) + mixed(((at - begin) << 20 | (last - begin)).astype(np.uint64)))
    return grams[at], whole, rows[first], begin - offsets[rows[first]], last - begin


def _segments(batch: pa.RecordBatch, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """Bytes, offsets and rows of a batch in parts of about ``PART``; and the first start of a part."""
    row = 0
    for piece in slices(batch, PART):
        flat, offsets = utf8(piece.column("content"))
        rows = np.arange(row, row + piece.num_rows)
        row += piece.num_rows
        if len(flat) <= 2 * PART:
            yield flat, offsets, rows, 0
            continue
        for place, number in enumerate(rows):  # a very long text is among them
            text = flat[offsets[place] : offsets[place + 1]]
            for start in range(0, len(text), PART):
                part = text[start : start + PART + length - 1]
                yield part, np.array([0, len(part)]), rows[place : place + 1], start


def _merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[np.ndarray]:
    """Intervals of documents, in order, with those that touch made one."""
    order = np.lexsort((start, tag, doc))
    doc, tag, start, stop = doc[order], tag[order], start[order], stop[order]
    if not len(doc):
        return [doc, tag, start, stop]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # The furthest stop so far in a document: stops are raised by a step for each document.
    group = np.cumsum(other) - 1
    span = int(stop.max()) + 1
    furthest = np.maximum.accumulate(stop + group * span) - group * span
    new = other.copy()
    new[1:] |= start[1:] > furthest[:-1]
    first = np.flatnonzero(new)
    return [doc[first], tag[first], start[first], furthest[np.append(first[1:], len(doc)) - 1]]


def _firsts(found: np.ndarray, length: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of runs with equal bytes the first; and what the others cover, which are repeats."""
    found = found[np.lexsort((found["place"], found["tag"], found["doc"], found["whole"], found["gram"]))]
    same = np.zeros(len(found), bool)
    same[1:] = (found["gram"][1:] == found["gram"][:-1]) & (found["whole"][1:] == found["whole"][:-1])
    # Rows of one key and text are one document: equal places are the same run, not repeats of it.
    group = np.maximum.accumulate(np.where(same, 0, np.arange(len(found))))
    twin = np.ones(len(found), bool)
    for field in ("doc", "tag", "place"):
        twin &= found[field] == found[field][group]
    again = found[same & ~twin]
    start, more = _parts(again["place"])
    return found[~same], [again["doc"], again["tag"], start, start + more + length]


def _rows(kind: int, key: np.ndarray | None, doc, tag, start, stop) -> pa.RecordBatch:
    count = len(doc)
    key = np.zeros(count, np.int64) if key is None else key.view(np.int64)
    columns = [np.full(count, kind, np.int32), key, doc, tag, start, stop]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[x.split()[0] for x in FOUND.split(", ")])


def _scatter(buckets: int, length: int):
    """From texts to runs by bucket of their q-gram; repeats inside a batch are settled here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag = batch.column("doc").to_numpy(), batch.column("tag").to_numpy()
            made = []
            for flat, offsets, rows, begin in _segments(batch, length):
                gram, whole, row, start, more = runs(flat, offsets, length)
                part = np.zeros(len(gram), RUN)
                row = rows[row]
                part["gram"], part["whole"], part["doc"], part["tag"] = gram, whole, doc[row], tag[row]
                part["place"] = (start + begin) << START_AT | more
                made.append(part)
            if not made:
                continue
            # A passage of many documents leaves a batch once.
            first, again = _firsts(np.concatenate(made), length)
            bucket = (first["gram"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            first, bucket = first[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets))
            cells = [first[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)]
            gone = np.stack(_merged(*again))
            numbers = [*bucket[cuts[:-1]], *([int(gone[0, 0]) % buckets] if gone.size else [])]
            empty = [None] * len(cells)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.array(numbers, np.int32)),
                    pa.array([*cells, *([None] if gone.size else [])], pa.binary()),
                    pa.array([*empty, *([gone.astype("<i8").tobytes()] if gone.size else [])], pa.binary()),
                ],
                names=["bucket", "runs", "gone"],
            )

    return run


def _settle(length: int):
    """Buckets of runs, in order: repeats of whole runs, and runs whose windows must be refined.

    At most about ``HELD_RUNS`` runs are held. A q-gram with more than ``REFINE_RUNS`` different
    runs (a passage of very many documents, each going on differently) is split by content.
    """

    def settled(held: list[np.ndarray], last: bool, crowded: set[int]) -> Iterator[pa.RecordBatch | np.ndarray]:
        first, again = _firsts(np.concatenate(held), length)
        if len(again[0]):
            yield _rows(GONE, None, *_merged(*again))
        gram, place, counts = np.unique(first["gram"], return_index=True, return_counts=True)
        crowded.update(gram[counts > min(HELD_RUNS // 64, REFINE_RUNS)].tolist())
        over = np.isin(first["gram"], np.array(sorted(crowded), np.uint64))
        yield from asked(BY_CONTENT, first[over])
        if not last:
            yield first[~over]
        else:
            yield from asked(REFINE, first[np.repeat(counts > 1, counts) & ~over])

    def asked(kind: int, some: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(some):
            start, more = _parts(some["place"])
            yield _rows(kind, some["gram"], some["doc"], some["tag"], start, start + more + length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held, crowded, most = None, [], set(), HELD_RUNS
        for batch in batches:
            for number, cell, gone in zip(*(batch.column(c) for c in ("bucket", "runs", "gone")), strict=True):
                if number.as_py() != bucket:
                    if held:
                        yield from settled(held, True, crowded)
                    bucket, held, crowded, most = number.as_py(), [], set(), HELD_RUNS
                if gone.is_valid:
                    yield _rows(GONE, None, *np.frombuffer(gone.as_buffer(), "<i8").reshape(4, -1))
                if not cell.is_valid:
                    continue
                some = np.frombuffer(cell.as_buffer(), RUN)
                if crowded:
                    over = np.isin(some["gram"], np.array(sorted(crowded), np.uint64))
                    yield from asked(BY_CONTENT, some[over])
                    some = some[~over]
                held.append(some)
                if sum(map(len, held)) > most:
                    *made, rest = settled(held, False, crowded)
                    yield from made
                    held, most = [rest], max(HELD_RUNS, 2 * len(rest))
        if held:
            yield from settled(held, True, crowded)

    return run


def _cut(length: int):
    """The bytes of the runs that a text was asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                keys, docs, tags, starts, cells = [], [], [], [], []
                for row in batch.to_pylist():
                    text = row["content"].encode()
                    for ask in row["asked"]:
                        a, b = ask["start"], ask["stop"]
                        some = [(a, b)] if ask["kind"] == REFINE else [(x, x + length) for x in range(a, b - length + 1)]
                        for x, y in some:
                            cells.append(text[x:y])
                            starts.append(x)
                        keys += [ask["key"]] * len(some)
                        if ask["kind"] == BY_CONTENT:  # one bucket for each content, not for all
                            flat = np.frombuffer(b"".join(cells[-len(some) :]), np.uint8)
                            at = np.arange(len(some)) * length
                            keys[-len(some) :] = mixed(Hashes(flat).of(at, at + length)).view(np.int64).tolist()
                        docs += [row["doc"]] * len(some)
                        tags += [row["tag"]] * len(some)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys, pa.int64()),
                        pa.array(docs, pa.int64()),
                        pa.array(tags, pa.int64()),
                        pa.array(starts, pa.int64()),
                        pa.array(cells, pa.binary()),
                    ],
                    names=["key", "doc", "tag", "start", "cell"],
                )

    return run


def refine(flat: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the bytes that begin a window of ``length`` inside a row, and their bucket.

    Initial buckets are the 8-byte grams. A refinement sorts the places of a bucket by the bucket
    numbers at a later offset, which doubles the bytes that a bucket agrees on; the new numbers are
    what the next refinement looks up. Places alone in their bucket are settled and sorted no more.
    Places in one bucket at the end have equal windows.
    """
    ends = np.repeat(offsets[1:], np.diff(offsets))
    places = np.arange(len(flat))
    padded = np.concatenate([flat, np.zeros(8, np.uint8)]).astype(np.uint64)
    number = np.zeros(len(flat), np.uint64)
    for k in range(8):
        number = number << np.uint64(8) | padded[k : len(flat) + k]
    agreed = 8
    live = places[places + agreed <= ends]
    bucket = np.zeros(len(flat), np.int64)
    bucket[live] = _ranks(number[live])[0]
    while agreed < length:
        step = min(agreed, length - agreed)
        live = live[live + agreed + step <= ends[live]]
        size = int(bucket.max()) + 1
        ranks, counts = _ranks(bucket[live].astype(np.uint64) * np.uint64(size) + bucket[live + step].astype(np.uint64))
        refined = bucket + size  # settled places keep numbers of their own
        refined[live] = ranks
        several = counts[ranks] > 1
        settled = live[~several]
        refined[settled] = 2 * size + np.arange(len(settled)) + len(live)
        bucket, agreed = refined, agreed + step
        live = live[several]
        if not len(live):
            break
    return live, bucket[live]


def _ranks(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, ranks, counts = np.unique(values, return_inverse=True, return_counts=True)
    return ranks, counts


def _again(part: pa.RecordBatch, length: int) -> tuple[np.ndarray, list[np.ndarray] | None]:
    """Rows of the windows that repeat in a part, and what those windows cover, if any."""
    flat, offsets = utf8(part.column("cell"))
    place, bucket = refine(flat, offsets, length)
    row = np.searchsorted(offsets, place, side="right") - 1
    doc, tag = part.column("doc").to_numpy()[row], part.column("tag").to_numpy()[row]
    start = part.column("start").to_numpy()[row] + place - offsets[row]
    order = np.lexsort((start, tag, doc, bucket))
    row, doc, tag, start, bucket = row[order], doc[order], tag[order], start[order], bucket[order]
    first = np.ones(len(doc), bool)
    first[1:] = bucket[1:] != bucket[:-1]
    head = np.maximum.accumulate(np.where(first, np.arange(len(doc)), 0))
    later = (doc != doc[head]) | (tag != tag[head]) | (start != start[head])
    if not later.any():
        return row[later], None
    return row[later], _merged(doc[later], tag[later], start[later], start[later] + length)


def _thinned(batches: Iterator[pa.RecordBatch], length: int, gone: list) -> Iterator[pa.RecordBatch]:
    """Where one key fills a batch of single windows, repeats go at once, so that no group is held whole.

    What they cover is added to ``gone``; the first of equal windows in the batch stays.
    """
    for batch in batches:
        rows = batch.num_rows
        if rows > 1 and batch.column("key")[0].equals(batch.column("key")[rows - 1]):
            flat, offsets = utf8(batch.column("cell"))
            if (np.diff(offsets) == length).all():
                later, covered = _again(batch, length)
                if covered:
                    gone.append(covered)
                    stays = np.ones(rows, bool)
                    stays[later] = False
                    batch = batch.filter(pa.array(stays))
        yield batch


def _refine(length: int):
    """Repeated windows among the runs of a bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone: list[list[np.ndarray]] = []
        for part, _ in whole_groups(_thinned(batches, length, gone), ["key"]):
            covered = _again(part, length)[1]
            for some in [*gone, *([covered] if covered else [])]:
                yield _rows(GONE, None, *some)
            gone.clear()

    return run


def remove(docs: DataFrame, *, length: int = 100, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: key, n_bytes, ``spans`` (removed byte ranges), ``kept``.

    A byte goes when a string of ``length`` bytes covers it that also starts earlier: in a document
    with a smaller key, or earlier in the same document. Strings are judged on the input, overlaps
    count, and strings never cross documents. ``kept`` are the other bytes (binary: cuts may split a
    character), ``spans`` the maximal removed ranges, in order. The key is a whole number; null is
    larger than any. Rows with one key and text count as one document; rows of one key with other
    texts, however many, are documents of their own, ordered by a hash of the text. Null and empty
    texts keep nothing and lose nothing. A very long text is hashed in parts that overlap and cut
    whole. Other columns are not read; empty tables give no rows.
    """
    if not 2 * GRAM <= length < 1 << START_AT:
        raise ValueError(f"strings must have {2 * GRAM} to {(1 << START_AT) - 1} bytes")
    spark = docs.sparkSession
    rows, size = _documents(docs, key, text)
    expected = size * 2 // (length - GRAM + 2) * RUN.itemsize
    buckets = max(parallelism(spark), expected // BUCKET_BYTES)
    scattered = rows.select("doc", "tag", "content").mapInArrow(
        _scatter(buckets, length), "bucket int, runs binary, gone binary"
    )
    found = scattered.repartition(parallelism(spark), "bucket").sortWithinPartitions("bucket")
    found = written(found.mapInArrow(_settle(length), FOUND), "runs")
    asks = found.where(F.col("kind") != GONE).groupBy("doc", "tag")
    asks = asks.agg(F.collect_list(F.struct("kind", "key", "start", "stop")).alias("asked"))
    texts = rows.select("doc", "tag", "content").join(asks, ["doc", "tag"])
    cells = texts.mapInArrow(_cut(length), "key long, doc long, tag long, start long, cell binary")
    cells = cells.repartition(parallelism(spark), "key").sortWithinPartitions("key")
    refined = written(cells.mapInArrow(_refine(length), FOUND), "refined")
    gone = found.where(F.col("kind") == GONE).unionByName(refined).groupBy("doc", "tag")
    gone = gone.agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("gone"))
    return _removed(rows.join(gone, ["doc", "tag"], "left"), key)


def _documents(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, int]:
    """Rows (doc, tag, key, content), where no two texts share doc and tag; and their bytes in all.

    The tag is a 64-bit hash of the text. Texts of one key whose tags are equal would be taken for
    one document, so a second hash looks for such; if there are any, another hash makes the tags.
    """
    seed = 0
    while True:
        rows = docs.select(
            F.coalesce(F.col(key).cast("long"), F.lit(LAST_KEY)).alias("doc"),
            F.xxhash64(F.lit(seed), content(text)).alias("tag"),
            F.col(key).alias("key"),
            content(text).alias("content"),
        )
        other = F.xxhash64(F.lit(-1 - seed), F.col("content"))
        each = rows.groupBy("doc", "tag").agg(
            F.min(other).alias("a"), F.max(other).alias("b"), F.sum(F.octet_length("content").cast("long")).alias("size")
        )
        size, clash = each.agg(F.sum("size"), F.max(F.col("a") != F.col("b"))).first()
        if not clash:
            return rows, size or 0
        seed += 1


def _removed(rows: DataFrame, key: str) -> DataFrame:
    """Cut the ranges out of the texts."""
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                sizes, spans, kept = [], [], []
                for text, gone in zip(batch.column("content"), batch.column("gone").to_pylist(), strict=True):
                    text = text.as_buffer().to_pybytes()
                    made, at, left = [], 0, []
                    for part in gone or ():
                        if made and part["start"] <= made[-1]["stop"]:
                            made[-1]["stop"] = max(made[-1]["stop"], part["stop"])
                        else:
                            made.append(part)
                    for part in made:
                        left.append(text[at : part["start"]])
                        at = part["stop"]
                    left.append(text[at:])
                    sizes.append(len(text))
                    spans.append(made)
                    kept.append(b"".join(left))
                ranges = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, ranges), pa.array(kept, pa.binary())],
                    names=["key", "n_bytes", "spans", "kept"],
                )

    fields = f"key {kind}, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary"
    return rows.select("key", "content", "gone").mapInArrow(run, fields).withColumnRenamed("key", key)
