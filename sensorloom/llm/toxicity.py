"""Toxicity scores from a counterfactual-regularised classifier.

Logistic regression on hashed word beginnings and words. Labelled texts that name a group are also
read with the group's term swapped for others of its kind; the fit penalises the differences
between their scores, so that naming a group doesn't move the score by itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import (
    IN_LETTERS,
    STEP_BYTES,
    Hashes,
    content,
    labelled,
    map_batches,
    mixed,
    pieces,
    slices,
    utf8,
    word_spans,
)

#: Terms that name groups, by language; a term is swapped for others of its line.
IDENTITY_TERMS: tuple[tuple[str, ...], ...] = (
    ("women", "men"),
    ("woman", "man"),
    ("girls", "boys"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("immigrants", "refugees", "citizens", "foreigners"),
    ("disabled", "blind", "deaf"),
    ("old", "young"),
    ("frauen", "männer"),
    ("frau", "mann"),
    ("mädchen", "jungen"),
    ("christen", "muslime", "juden", "buddhisten", "atheisten"),
    ("christlich", "muslimisch", "jüdisch", "hinduistisch", "buddhistisch"),
    ("schwarze", "weiße", "asiaten"),
    ("schwule", "lesben", "heterosexuelle", "bisexuelle"),
    ("einwanderer", "flüchtlinge", "bürger", "ausländer"),
    ("behinderte", "blinde", "gehörlose"),
    ("femmes", "hommes"),
    ("femme", "homme"),
    ("filles", "garçons"),
    ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
    ("noirs", "blancs", "asiatiques"),
    ("homosexuels", "lesbiennes", "hétérosexuels", "bisexuels"),
    ("immigrés", "réfugiés", "citoyens", "étrangers"),
    ("handicapés", "aveugles", "sourds"),
    ("mujeres", "hombres"),
    ("mujer", "hombre"),
    ("chicas", "chicos"),
    ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
    ("cristiano", "musulmán", "judío", "budista", "ateo"),
    ("negros", "asiáticos", "latinos"),
    ("homosexuales", "lesbianas", "heterosexuales", "bisexuales"),
    ("inmigrantes", "refugiados", "ciudadanos", "extranjeros"),
    ("discapacitados", "ciegos", "sordos"),
)
#: Of each text with identity terms, so many versions with other terms at most.
SWAPS = 2
PREFIXES = (3, 4, 5, 6)
BUCKET_BITS = 18
#: Bound of the labelled sample, for each label (``common.labelled``).
SAMPLE_ROWS = 10_000
FEATURES = 1024
STEPS, RATE, RIDGE, FAIRNESS = 300, 0.1, 1e-4, 1.0


@dataclass
class Classifier:
    """Weight of every feature bucket, and the bias."""

    weights: np.ndarray
    bias: float


def features(flat: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (row, bucket) pairs of words and word beginnings; only ``wanted`` buckets if given.

    A very long text is read in pieces.
    """
    found = [_features(part, cuts, wanted) + (first << BUCKET_BITS) for part, cuts, first in pieces(flat, offsets, STEP_BYTES, IN_LETTERS)]
    pairs = found[0] if len(found) == 1 else np.unique(np.concatenate([np.zeros(0, np.int64), *found]))
    return pairs >> BUCKET_BITS, pairs & ((1 << BUCKET_BITS) - 1)


def _features(flat: np.ndarray, offsets: np.ndarray, wanted: np.ndarray | None) -> np.ndarray:
    starts, ends, rows = word_spans(flat, offsets, IN_LETTERS)
    hashes, found = Hashes(flat), []
    for length in (0, *PREFIXES):
        if length:
            long = ends - starts >= length
            at, to, row = starts[long], starts[long] + length, rows[long]
        else:
            at, to, row = starts, ends, rows
        buckets = (mixed(hashes.of(at, to) + np.uint64(length)) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        if wanted is not None:
            some = wanted[buckets]
            buckets, row = buckets[some], row[some]
        found.append(row.astype(np.int64) << BUCKET_BITS | buckets)
    return np.unique(np.concatenate(found))


def swapped(text: str, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS, step: int = 1) -> str | None:
    """The text with every identity term swapped for the one ``step`` further in its line.

    None where there are none, or where all would be themselves.
    """
    following = {t: line[(i + step) % len(line)] for line in terms for i, t in enumerate(line) if step % len(line)}
    if not following:
        return None
    made, count = re.subn(
        r"\b(?:" + "|".join(map(re.escape, sorted(following))) + r")\b", lambda m: following[m[0]], text
    )
    return made if count else None


def train(rows: DataFrame, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> Classifier:
    """Fit ``rows`` (label, content), a bounded sample.

    Features are counted by label in Spark; the ``FEATURES`` that tell labels apart best stay. The
    driver gets those counts, and then for each sampled text at most ``FEATURES`` numbers.
    """
    width = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((2, width), np.int64)
        for batch in batches:
            for part in slices(batch):
                labels = part.column("label").to_numpy()
                row, bucket = features(*utf8(part.column("content")))
                totals += np.bincount(labels[row] * width + bucket, minlength=2 * width).reshape(2, -1)
        label, bucket = np.nonzero(totals)
        if len(label):
            yield pa.RecordBatch.from_arrays(
                [pa.array(label), pa.array(bucket), pa.array(totals[label, bucket])],
                names=["label", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "label long, bucket long, n long")
    counted = counted.groupBy("label", "bucket").agg(F.sum("n").alias("n")).toArrow()
    totals = np.zeros((2, width))
    totals[counted["label"].to_numpy(), counted["bucket"].to_numpy()] = counted["n"].to_numpy()
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    telling = _telling(totals, np.array([sizes.get(0, 0), sizes.get(1, 0)], float))
    chosen = np.argsort(-telling, kind="stable")[:FEATURES]
    chosen = chosen[telling[chosen] > 0]
    wanted = np.zeros(width, bool)
    wanted[chosen] = True
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def held(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("content").to_pylist()
        versions = [[swapped(x, terms, step + 1) for x in texts] for step in range(SWAPS)]
        kind, columns = pa.list_(pa.int32()), [batch.column("label"), _cells(texts, shared.value)]
        for some in versions:
            cells = _cells([x or "" for x in some], shared.value)
            lost = pa.array([x is None for x in some])
            columns.append(pc.if_else(lost, pa.nulls(len(texts), kind), cells))
        return pa.RecordBatch.from_arrays(columns, names=["label", "own", *(f"swap_{i}" for i in range(SWAPS))])

    fields = ", ".join(f"swap_{i} array<int>" for i in range(SWAPS))
    made = map_batches(rows, held, f"label long, own array<int>, {fields}").toArrow()
    return _fit(made, sizes, width)


def _cells(texts: list[str], wanted: np.ndarray) -> pa.ListArray:
    """The wanted buckets of every text."""
    row, bucket = features(*utf8(pa.array(texts, pa.string())), wanted)
    cuts = np.searchsorted(row, np.arange(len(texts) + 1))
    return pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(bucket, pa.int32()))


def _telling(totals: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How much each feature tells about the label: the G statistic of presence by label."""
    if not sizes.all():
        return np.zeros(totals.shape[1])
    found, gain = totals.sum(axis=0), 0
    for cells, margin in ((totals, found), (sizes[:, None] - totals, sizes.sum() - found)):
        expected = sizes[:, None] * margin / sizes.sum()
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gain + np.where(cells > 0, cells * np.log(cells / expected), 0).sum(axis=0)
    return np.where(found >= 2, gain, 0)


def _fit(rows: pa.Table, sizes: dict[int, int], width: int) -> Classifier:
    """Adam on the mean log loss, labels weighed alike, plus ridge and counterfactual penalties."""
    if not sizes.get(0) or not sizes.get(1):
        return Classifier(np.zeros(width, np.float32), -4.0)
    label = rows["label"].to_numpy().astype(float)
    own_row, own_bucket = _flat(rows["own"])
    swaps = [rows[f"swap_{i}"] for i in range(SWAPS)]
    others = [_flat(s) for s in swaps]
    used, place = np.unique(np.concatenate([own_bucket, *(b for _, b in others)]), return_inverse=True)
    own, *at = np.split(place, np.cumsum([len(own_row), *(len(r) for r, _ in others)])[:-1])
    others = [(r, p, s.is_valid().to_numpy()) for (r, _), p, s in zip(others, at, swaps, strict=True)]
    weigh = np.where(label > 0, 0.5 / sizes[1], 0.5 / sizes[0])
    pairs = max(1, sum(there.sum() for *_, there in others))
    weights, bias = np.zeros(len(used)), 0.0
    first, second = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for step in range(1, STEPS + 1):
        score = _sigmoid(np.bincount(own_row, weights[own], minlength=len(label)) + bias)
        push = weigh * (score - label)
        slope, lean = RIDGE * weights, 0.0
        for row, swap, there in others:
            other = _sigmoid(np.bincount(row, weights[swap], minlength=len(label)) + bias)
            gap = np.where(there, score - other, 0) * (2 * FAIRNESS / pairs)
            push = push + gap * score * (1 - score)
            pull = -gap * other * (1 - other)
            slope = slope + np.bincount(swap, pull[row], minlength=len(used))
            lean += pull.sum()
        slope = np.append(slope + np.bincount(own, push[own_row], minlength=len(used)), push.sum() + lean)
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    table = np.zeros(width, np.float32)
    table[used] = weights
    return Classifier(table, float(bias))


def _flat(cells: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element of a list column."""
    cells = cells.combine_chunks()
    sizes = cells.value_lengths().fill_null(0).to_numpy()
    return np.repeat(np.arange(len(cells)), sizes), cells.flatten().to_numpy()


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(docs: DataFrame, model: Classifier, *, key: Column, text: str = "text", **more: Column) -> DataFrame:
    """One row for each row of ``docs``: key, ``more`` columns and score; null text reads as empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(
        key.alias("key"), *(c.alias(n) for n, c in more.items()), F.lower(content(text)).alias("content")
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    kept = ["key", *more]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        row, bucket = features(*utf8(batch.column("content")), model.weights != 0)
        sums = np.bincount(row, model.weights[bucket], minlength=batch.num_rows) + model.bias
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(_sigmoid(sums))], names=[*kept, "score"]
        )

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return map_batches(rows, run, f"{fields}, score double")


def classify(docs: DataFrame, labels: DataFrame, *, held_out: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Learn from labelled rows that aren't held out, then score all rows of ``docs``.

    ``labels`` has the key and ``toxic`` (0 or 1; others and null are left out); a null key has no
    label. At most ``SAMPLE_ROWS`` texts of each label are learned from, however many rows share a
    key. Scores see the text alone. Without both labels all scores are alike, low. Null and repeated
    keys are rows like others; a very long text is read in pieces, whole; other columns are not
    read; empty tables give no rows.
    """
    sample = labelled(
        docs, labels, "toxic", held_out=held_out, key=key, text=F.lower(content(text)), limit=SAMPLE_ROWS
    )
    model = train(sample)
    made = score(docs, model, key=F.col(key), text=text, held_out=F.coalesce(held_out, F.lit(True)))
    return made.withColumnRenamed("key", key)
