"""Language identification by multilingual mixture inference.

Each language has a model of hashed byte n-grams. A document is a mixture of languages: its words
get a likelihood under each, expectation-maximisation estimates the proportions, and the set of
languages is the one with the best penalised likelihood.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm.common import IN_LETTERS, Hashes, content, map_batches, mixed, pieces, slices, utf8, word_spans

ORDERS = (1, 2, 3, 4)
BUCKET_BITS = 16
#: The model is broadcast: this many languages times 2 ** BUCKET_BITS numbers at most.
MOST_LANGUAGES = 200
SMOOTHING = 0.5
#: n-grams of a word overlap, so their evidence is counted in part; how often a byte still counts.
EVIDENCE = 0.5
OVERLAP = EVIDENCE * len(ORDERS)
#: Larger sets that are tried after one that was no better.
PATIENCE = 2
UNKNOWN = "und"
#: Text bytes in one vectorised step: several numbers are held for each byte and language.
STEP = 1 << 20


@dataclass
class Model:
    """Log likelihood of every n-gram bucket (rows) under every language (columns)."""

    languages: list[str]
    logs: np.ndarray


def gram_buckets(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every order: buckets of the n-grams in letter runs, and the number of their run.

    A run is read with a space before and behind it.
    """
    starts, ends, _ = word_spans(flat, offsets, IN_LETTERS)
    size = ends - starts
    run = np.repeat(np.arange(len(starts)), size + 2)
    first = np.concatenate([[0], np.cumsum(size + 2)])
    spaced = np.full(first[-1], 0x20, np.uint8)
    place = np.arange(len(spaced)) - first[:-1][run] if len(run) else np.zeros(0, np.int64)
    inner = (place > 0) & (place <= size[run]) if len(run) else np.zeros(0, bool)
    spaced[inner] = flat[starts[run[inner]] + place[inner] - 1]
    hashes = Hashes(spaced)
    for order in ORDERS:
        grams = hashes.grams(order)
        inside = run[: len(grams)] == run[len(spaced) - len(grams) :]
        buckets = mixed(grams[inside] + np.uint64(order)) >> np.uint64(64 - BUCKET_BITS)
        yield buckets.astype(np.int64), run[: len(grams)][inside]


def learn(rows: DataFrame) -> Model:
    """Model of ``rows`` (content, lang): n-gram counts of all of them, added up in Spark.

    Only the counts, one for each bucket and language, reach the driver.
    """
    found = rows.select("lang").distinct().limit(MOST_LANGUAGES + 1).collect()
    languages = sorted(r["lang"] for r in found)
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    number = {language: i for i, language in enumerate(languages)}
    width = 1 << BUCKET_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((len(languages), width), np.int64)
        for batch in batches:
            for part in slices(batch, STEP):
                flat, offsets = utf8(part.column("content"))
                texts = np.searchsorted(offsets, word_spans(flat, offsets, IN_LETTERS)[0], side="right") - 1
                spoken = np.array([number[x] for x in part.column("lang").to_pylist()])[texts]
                for buckets, runs in gram_buckets(flat, offsets):
                    cells = spoken[runs] * width + buckets
                    totals += np.bincount(cells, minlength=totals.size).reshape(totals.shape)
        language, bucket = np.nonzero(totals)
        if len(language):
            yield pa.RecordBatch.from_arrays(
                [pa.array(language), pa.array(bucket), pa.array(totals[language, bucket])],
                names=["language", "bucket", "n"],
            )

    counted = rows.mapInArrow(count, "language long, bucket long, n long")
    counted = counted.groupBy("language", "bucket").agg(F.sum("n").alias("n")).toArrow()
    totals = np.full((width, len(languages)), SMOOTHING)
    totals[counted["bucket"].to_numpy(), counted["language"].to_numpy()] += counted["n"].to_numpy()
    logs = np.log(totals / totals.sum(axis=0)) if languages else totals
    return Model(languages, logs.astype(np.float32))


@dataclass
class Words:
    """Distinct words of some texts: text, how often, and likelihood under every language.

    The likelihoods of a word are relative to its most likely language, whose logarithm is ``top``.
    """

    rows: np.ndarray
    counts: np.ndarray
    likelihood: np.ndarray
    top: np.ndarray

    def some(self, texts: np.ndarray) -> Words:
        """Words of the marked texts, numbered anew."""
        kept = texts[self.rows]
        return Words((np.cumsum(texts) - 1)[self.rows[kept]], self.counts[kept], self.likelihood[kept], self.top[kept])


def _distinct(model: Model, flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and number of every row's distinct words, and the log likelihoods of each.

    A word is scored once, however many rows hold it.
    """
    starts, ends, rows = word_spans(flat, offsets, IN_LETTERS)
    hashes, first, word = np.unique(Hashes(flat).of(starts, ends), return_index=True, return_inverse=True)
    starts, sizes = starts[first], ends[first] - starts[first]
    cuts = np.concatenate([[0], np.cumsum(sizes + 1)])  # a space behind each keeps them apart
    texts = np.full(cuts[-1], 0x20, np.uint8)
    place = np.arange(len(texts)) - np.repeat(cuts[:-1], sizes + 1)
    inner = place < np.repeat(sizes, sizes + 1)
    texts[inner] = flat[(np.repeat(starts, sizes + 1) + place)[inner]]
    logs = np.zeros((len(hashes), len(model.languages)), np.float32)
    for buckets, runs in gram_buckets(texts, np.array([0, len(texts)])):
        for k in range(len(model.languages)):
            logs[:, k] += np.bincount(runs, model.logs[buckets, k], minlength=len(hashes))
    pairs, counts = np.unique(rows * max(1, len(hashes)) + word, return_counts=True)
    of = pairs % max(1, len(hashes))
    return pairs // max(1, len(hashes)), hashes[of], counts, logs[of]


def words(model: Model, flat: np.ndarray, offsets: np.ndarray) -> Words:
    """Distinct words of every row; a long text is read in pieces, whose words are then added up."""
    found: list[tuple[np.ndarray, ...]] = []
    for part, cuts, first in pieces(flat, offsets, STEP, IN_LETTERS):
        rows, hashes, counts, logs = _distinct(model, part, cuts)
        if found and len(rows) and found[-1][0][-1:] == [first]:  # the same text goes on
            before = found.pop()
            hashes = np.concatenate([before[1], hashes])
            hashes, at, word = np.unique(hashes, return_index=True, return_inverse=True)
            counts = np.bincount(word, np.concatenate([before[2], counts])).astype(np.int64)
            logs, rows = np.concatenate([before[3], logs])[at], np.full(len(hashes), first)
        else:
            rows = rows + first
        if len(rows):
            found.append((rows, hashes, counts, logs))
    if not found:
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros((0, len(model.languages)), np.float32), np.zeros(0, np.float32))
    rows, _, counts, logs = (np.concatenate(x) if len(found) > 1 else x[0] for x in zip(*found, strict=True))
    logs *= EVIDENCE
    top = logs.max(axis=1)
    return Words(rows, counts, np.exp(logs - top[:, None]), top)


def _fitted(held: Words, shares: np.ndarray, sizes: np.ndarray, steps: int, members: np.ndarray | None = None) -> np.ndarray:
    """EM steps from some shares; ``members`` are the languages of each text's set, if not all."""
    likelihood = held.likelihood if members is None else np.take_along_axis(held.likelihood, members[held.rows], axis=1)
    begin = np.flatnonzero(np.diff(held.rows, prepend=-1))
    there = held.rows[begin]
    for _ in range(steps):
        taken = likelihood * shares[held.rows]
        taken *= (held.counts / np.maximum(taken.sum(axis=1), 1e-30))[:, None]
        if len(begin):
            shares = shares.copy()
            shares[there] = np.add.reduceat(taken, begin, axis=0) / sizes[there, None]
    return shares


def proportions(
    model: Model, flat: np.ndarray, offsets: np.ndarray, steps: int = 8
) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of every row, and how many languages were selected.

    EM over all languages first. Then the sets of the 1, 2, ... most likely languages are refitted,
    over their own columns alone, until ``PATIENCE`` larger ones were no better. The set stays whose
    log likelihood, less a penalty for each language, is largest: half a log of the number of words
    (BIC) and a log of the number of languages that were to be had, both times ``OVERLAP``, since
    that is how many times the overlapping n-grams count each byte.
    """
    held = words(model, flat, offsets)
    texts, languages = len(offsets) - 1, len(model.languages)
    counts = np.bincount(held.rows, held.counts, minlength=texts)
    some = np.maximum(counts, 1)
    shares = np.full((texts, languages), 1 / max(1, languages), np.float32)
    shares = _fitted(held, shares, some, steps).astype(np.float32)
    order = np.argsort(-shares, axis=1, kind="stable")
    best, chosen = np.full(texts, -np.inf), shares.copy()
    number, failed = np.zeros(texts, np.int64), np.zeros(texts, np.int64)
    penalty = OVERLAP * (np.log(some) / 2 + np.log(max(1, languages)))
    live = np.arange(texts)  # texts that a larger set may suit better
    for size in range(1, languages + 1):
        members = order[live, :size]
        fit = np.maximum(np.take_along_axis(shares[live], members, axis=1), 1e-6)
        fit /= fit.sum(axis=1, keepdims=True)
        fit = _fitted(held, fit, some[live], steps // 2 if size > 1 else 0, members)
        likelihood = np.take_along_axis(held.likelihood, members[held.rows], axis=1)
        each = np.log(np.maximum((likelihood * fit[held.rows]).sum(axis=1), 1e-30)) * held.counts
        fitness = np.bincount(held.rows, each, minlength=len(live)) - size * penalty[live]
        better = fitness > best[live]
        at = live[better]
        chosen[at] = 0
        chosen[at[:, None], members[better]] = fit[better]
        best[at], number[at] = fitness[better], size
        failed[live] = np.where(better, 0, failed[live] + 1)
        # No word is likelier than 1, so no larger set beats its penalty alone.
        left = (failed[live] < PATIENCE) & (best[live] < -(size + 1) * penalty[live])
        if not left.all():
            live, held = live[left], held.some(left)
        if not len(live):
            break
    return chosen, number


def predict(docs: DataFrame, model: Model, *, key: Column, text: str = "text", **more: Column) -> DataFrame:
    """One row for each row of ``docs``: key, lang_pred, score, n_languages and ``more`` columns.

    ``score`` is the proportion of the predicted language. ``und`` with score 0 where the text is
    null or has no letter, or nothing was learned. Ties go to the language first in the alphabet.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    letters = content(text).rlike(r"\p{L}")
    rows = docs.select(
        key.alias("key"),
        *(c.alias(n) for n, c in more.items()),
        F.when(letters, F.lower(content(text))).otherwise("").alias("content"),
        letters.alias("letters"),
    )
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    kept = ["key", *more]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        sure = batch.column("letters").to_numpy(zero_copy_only=False)
        if model.languages:
            shares, number = proportions(model, *utf8(batch.column("content")))
            found = shares.argmax(axis=1)
            score = shares.max(axis=1)
            names = [model.languages[i] if ok else UNKNOWN for i, ok in zip(found, sure, strict=True)]
        else:
            number = score = np.zeros(len(sure))
            names = [UNKNOWN] * len(sure)
        return pa.RecordBatch.from_arrays(
            [batch.column(c) for c in kept]
            + [
                pa.array(names, pa.string()),
                pa.array(np.clip(np.where(sure, score, 0), 0, 1).astype(np.float64)),
                pa.array(np.where(sure, number, 0).astype(np.int32)),
            ],
            names=[*kept, "lang_pred", "score", "n_languages"],
        )

    fields = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return map_batches(rows, run, f"{fields}, lang_pred string, score double, n_languages int", STEP)


def identify(docs: DataFrame, *, held_out: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Learn from the rows of ``docs`` that aren't held out, then predict all of them.

    Learns from text and non-null ``lang`` alone; predictions see the text alone. Null and repeated
    keys are rows like others, a null ``held_out`` counts as held out, other columns are not read,
    empty tables give no rows. A very long text is read in pieces, of which its distinct words are
    kept: 16 bytes for each, and 4 for each language.
    """
    seen = docs.where(~held_out & F.col(lang).isNotNull() & F.col(text).isNotNull())
    model = learn(seen.select(F.lower(F.col(text)).alias("content"), F.col(lang).alias("lang")))
    made = predict(docs, model, key=F.col(key), text=text, held_out=F.coalesce(held_out, F.lit(True)))
    return made.withColumnRenamed("key", key)
