"""Quality scores by nearest-neighbour voting among labelled latent-semantic vectors.

A text is a vector of weighted terms: hashed byte n-grams and the levels of a few shape measures.
How many documents hold a term is counted over all of them. The directions that labelled texts
spread most in make the latent space. Labelled vectors are broadcast; every document's cosines
with all of them are computed block by block, exactly, and its nearest neighbours vote, weighted
by their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import IN_WORD, Hashes, content, labelled, map_batches, mixed, slices, utf8, word_spans

#: n-grams of two and three bytes share this many buckets, a power of two.
BUCKETS = 2048
#: Levels of each shape measure, and the weight of all of them beside the n-grams.
LEVELS, SHAPE_WEIGHT = 12, 0.7
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>!"))
UPPER = np.isin(np.arange(256), list(range(0x41, 0x5B)))
MEASURES = ("words", "distinct", "symbols", "upper", "length")
WIDTH = BUCKETS + LEVELS * len(MEASURES)
DIMENSIONS, NEIGHBOURS, SHARPNESS = 48, 15, 8
#: Bound of the labelled sample, for each label; it bounds what is broadcast.
SAMPLE_ROWS = 3000
#: Vectors are rounded to this fraction of their length: sums of products are then exact.
GRID = 1 << 16
#: Text bytes and rows of one vectorised step.
STEP, BLOCK = 1 << 20, 512


@dataclass
class Space:
    """Weights of terms, directions of the latent space, labelled vectors there and their labels."""

    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray


def terms(batch: pa.Array) -> np.ndarray:
    """Counts of n-grams and the levels of shape measures, a row for each text (null: empty).

    A text longer than a step is read in pieces that overlap by an n-gram.
    """
    flat, offsets = utf8(batch)
    rows = len(offsets) - 1
    grams = np.zeros((rows, BUCKETS))
    sums = np.zeros((4, rows))  # words, bytes in words, symbols, capitals
    distinct = np.zeros(rows)
    if len(flat) <= 2 * STEP:
        _add(grams, sums, distinct, flat, offsets)
    else:
        for row, (start, end) in enumerate(zip(offsets, offsets[1:], strict=False)):
            seen = []
            while start < end:
                cut = _cut(flat, start, end)
                part, two = flat[start:cut], np.array([0, cut - start])
                hashes = _add(grams[row : row + 1], sums[:, row : row + 1], distinct[row : row + 1], part, two)
                seen = [np.unique(np.concatenate([*seen, hashes]))]
                # The n-grams across the cut.
                across = flat[max(start, cut - 2) : min(end, cut + 2)] if cut < end else part[:0]
                for size in (2, 3):
                    for at in range(len(across) - size + 1):
                        if at < 2 < at + size:
                            grams[row] += np.bincount(_buckets(across[at : at + size], size), minlength=BUCKETS)
                start = cut
            distinct[row] = len(seen[0]) if seen else 0
    words, solid, symbols, capitals = sums
    some, inside = np.maximum(words, 1), np.maximum(solid, 1)
    levels = np.stack(
        [
            np.log2(words + 1),
            np.where(words > 0, 1 + 10 * distinct / some, 0),
            np.ceil(np.minimum(np.log2(1 + 1000 * symbols / inside), 11)),
            np.ceil(11 * capitals / inside),
            np.minimum(np.sqrt(solid / some) * 2, 11),
        ],
        axis=1,
    )
    levels = np.minimum(levels, LEVELS - 1).astype(np.int64)
    shape = np.zeros((rows, len(MEASURES), LEVELS))
    np.put_along_axis(shape, levels[:, :, None], 1.0, axis=2)
    return np.concatenate([grams, shape.reshape(rows, -1)], axis=1)


def _cut(flat: np.ndarray, start: int, end: int) -> int:
    """Where to end a piece: behind white space if there is any, so that no word is cut."""
    cut = min(start + STEP, end)
    if cut < end:
        gaps = np.flatnonzero(~IN_WORD[flat[start:cut]])
        if len(gaps):
            cut = start + gaps[-1] + 1
    return cut


def _buckets(flat: np.ndarray, size: int) -> np.ndarray:
    made = np.full(max(0, len(flat) - size + 1), size, np.uint32)
    for at in range(size):
        made = made << np.uint32(8) | flat[at : len(flat) - size + 1 + at]
    return (made * np.uint32(2654435761) >> np.uint32(32 - 11)).astype(np.int64) % BUCKETS


def _add(grams: np.ndarray, sums: np.ndarray, distinct: np.ndarray, flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Add what some bytes hold; distinct words are counted by their hashes, which are returned."""
    rows = len(offsets) - 1
    row_of = np.repeat(np.arange(rows), np.diff(offsets))
    for size in (2, 3):
        count = max(0, len(flat) - size + 1)
        own = row_of[:count] == row_of[len(flat) - count :]
        cells = row_of[:count][own] * BUCKETS + _buckets(flat, size)[own]
        grams += np.bincount(cells, minlength=rows * BUCKETS).reshape(rows, BUCKETS)
    starts, ends, word_row = word_spans(flat, offsets)
    sums[0] += np.bincount(word_row, minlength=rows)
    sums[1] += np.bincount(word_row, ends - starts, minlength=rows)
    sums[2] += np.bincount(row_of, SYMBOLS[flat], minlength=rows)
    sums[3] += np.bincount(row_of, UPPER[flat], minlength=rows)
    hashes = Hashes(flat).of(starts, ends)
    order = np.lexsort((hashes, word_row))
    hashes, word_row = hashes[order], word_row[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (word_row[1:] != word_row[:-1])
    distinct += np.bincount(word_row[fresh], minlength=rows)
    return hashes[fresh]


def held_by(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """How many documents hold each term, and how many there are: ``WIDTH`` numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(WIDTH, np.int64), 0
        for batch in batches:
            for part in _blocks(batch):
                found += (terms(part.column("content")) > 0).sum(axis=0)
                rows += part.num_rows
        term = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(term, -1)), pa.array(np.append(found[term], rows))], names=["term", "n"]
        )

    counted = docs.select(content(text).alias("content")).mapInArrow(run, "term long, n long")
    counted = counted.groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    by_term = dict(zip(counted["term"], counted["n"], strict=True))
    made = np.zeros(WIDTH)
    for term, n in by_term.items():
        if term >= 0:
            made[term] = n
    return made, by_term.get(-1, 0)


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, STEP):
        for start in range(0, part.num_rows, BLOCK):
            yield part.slice(start, BLOCK)


def weighted(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rows of weighted terms: n-grams by log count, shape by presence, each part of fixed length."""
    made = np.log1p(counts) * weights
    for part, length in ((made[:, :BUCKETS], 1.0), (made[:, BUCKETS:], SHAPE_WEIGHT)):
        part *= length / np.maximum(np.sqrt((part**2).sum(axis=1, keepdims=True)), 1e-12)
    return made


def latent(rows: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """Unit vectors in the latent space, on a grid on which sums of products are exact."""
    made = rows @ directions
    made /= np.maximum(np.sqrt((made**2).sum(axis=1, keepdims=True)), 1e-12)
    return np.rint(made * GRID)


def spread(rows: np.ndarray, dimensions: int, rounds: int = 6) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    width = rows.shape[1]
    made = np.sin(np.arange(1, width + 1)[:, None] * np.arange(1, dimensions + 9)[None, :])
    for _ in range(rounds):
        made, _ = np.linalg.qr(rows.T @ (rows @ made))
    inner = rows @ made
    _, turn = np.linalg.eigh(inner.T @ inner)
    return made @ turn[:, ::-1][:, :dimensions]


def learn(sample: DataFrame, weights: np.ndarray) -> Space:
    """Latent space and labelled vectors of ``sample`` (label, content), which is bounded."""

    def counted(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [terms(batch.column("content").slice(i, BLOCK)) for i in range(0, batch.num_rows, BLOCK)]
        found = np.concatenate(found).astype(np.float32)
        cells = [pa.scalar(row.tobytes(), pa.binary()) for row in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(cells, pa.binary())], names=["label", "terms"]
        )

    rows = map_batches(sample, counted, "label long, terms binary", STEP).toArrow()
    # The order of rows must not depend on partitions.
    rows = sorted(zip(rows["label"].to_pylist(), rows["terms"].to_pylist(), strict=True))
    labels = np.array([label for label, _ in rows], float)
    if len(set(labels)) < 2:
        return Space(weights, np.zeros((WIDTH, 1)), np.zeros((0, 1)), labels)
    counts = np.frombuffer(b"".join(t for _, t in rows), np.float32).reshape(len(rows), WIDTH)
    made = weighted(counts.astype(float), weights)
    directions = spread(made, min(DIMENSIONS, len(rows)))
    return Space(weights, directions, latent(made, directions), labels)


def voted(space: Space, counts: np.ndarray) -> np.ndarray:
    """Score of each row of term counts: the labels of its nearest neighbours, weighed by similarity.

    All neighbours as near as the last one vote, so ties don't depend on their order.
    """
    if not len(space.vectors):
        return np.full(len(counts), space.labels.mean() if len(space.labels) else 0.5)
    near = latent(weighted(counts, space.weights), space.directions) @ space.vectors.T / GRID**2
    last = min(NEIGHBOURS, near.shape[1])
    bound = np.partition(near, -last, axis=1)[:, -last, None]
    votes = np.where(near >= bound, np.clip(near, 1e-6, 1) ** SHARPNESS, 0)
    return np.clip(votes @ space.labels / votes.sum(axis=1), 0, 1)


def score(docs: DataFrame, space: Space, *, key: Column, text: str = "text", **more: Column) -> DataFrame:
    """One row for each row of ``docs``: key, ``more`` columns and score; null text reads as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(space)
    rows = docs.select(key.alias("key"), *(c.alias(n) for n, c in more.items()), content(text).alias("content"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    kept = ["key", *more]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("content")
        made = [voted(shared.value, terms(texts.slice(i, BLOCK))) for i in range(0, batch.num_rows, BLOCK)]
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(np.concatenate(made))], names=[*kept, "score"]
        )

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return map_batches(rows, run, f"{fields}, score double", STEP)


def rate(docs: DataFrame, labels: DataFrame, *, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from labelled rows that aren't held out, then score all rows of ``docs``.

    ``labels`` has the key and ``quality`` (0 or 1; others and null are left out). At most
    ``SAMPLE_ROWS`` texts of each label are learned from; term counts are of all documents. Scores
    see the text alone: equal texts have equal scores. Null text reads as empty, an empty text is
    scored by its shape like others; a very long one is read in pieces. Null and repeated keys are
    rows like others, though a null key has no label; other columns are not read; with fewer than
    two labels all scores are alike; empty tables give no rows.
    """
    sample = labelled(docs, labels, "quality", held_out=held_out, key=key, text=content(text), limit=SAMPLE_ROWS)
    held, rows = held_by(docs, text)
    space = learn(sample, np.log((1 + rows) / (1 + held)) + 0.1)
    made = score(docs, space, key=F.col(key), text=text, held_out=F.coalesce(held_out, F.lit(True)))
    return made.withColumnRenamed("key", key)
