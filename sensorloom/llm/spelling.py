"""Spelling variants of the words of a corpus, found by permuterm rotations.

Words are marked with a terminator and rotated. A word that lacks, has or replaces one character
of another shares with it the rotation that ends before that character: the rotation as a prefix,
the edited character skipped. Sorted by that prefix, neighbours lie in one group, which a single
scan counts. A group holds at most one word for each letter and the word without the letter, so
groups are bounded by the alphabet, and no pairs are made.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.llm.common import STEP_BYTES, content, join_spread, slices, utf8, word_spans, written

#: Code points that a word has at least, and how often it occurs at least.
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: A run whose crc32 this divides loses a character.
DAMAGE = 31
#: A form occurs at least so many times as often as its variant.
FORM_FACTOR = 10
TERMINATOR = "$"
#: Rotations of longer words are told by numbers: written out they would take the length squared.
LONGEST_WRITTEN = 64
#: Primes below 2 ** 31 and the base of those numbers.
PRIMES, BASE = (2147483647, 2147483629, 2147483587), 1_000_003


def crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    return table


_CRC = crc_table()


def in_runs(flat: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``; the latter have two bytes, the first of them 0xC3."""
    lower = flat | np.uint8(0x20)
    made = (lower >= 0x61) & (lower <= 0x7A)
    lead = flat == 0xC3
    made |= lead
    made[1:] |= lead[:-1]
    return made


def pieces(flat: np.ndarray, offsets: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and offsets of some rows, and the first row: one piece, or several of a long text.

    A text is cut only where no run stands.
    """
    if len(flat) <= limit:
        yield flat, offsets, 0
        return
    for row, (start, end) in enumerate(zip(offsets, offsets[1:], strict=False)):
        while start < end:
            cut = min(start + limit, end)
            while cut < end:
                seen = min(cut + (1 << 16), end)
                free = np.flatnonzero(~in_runs(flat[cut - 1 : seen])[1:])
                cut = cut + free[0] if len(free) else seen
                if len(free):
                    break
            yield flat[start:cut], np.array([0, cut - start]), row
            start = cut


def crcs(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each span of bytes, carried on from the crc32 ``before`` it."""
    state = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    order = np.argsort(-size, kind="stable")
    sorted_size = -size[order]
    for at in range(min(int(size.max(initial=0)), 64)):
        some = order[: np.searchsorted(sorted_size, -at, side="left")]
        state[some] = _CRC[(state[some] ^ flat[starts[some] + at]) & np.uint32(0xFF)] ^ (state[some] >> np.uint32(8))
    made = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(size > 64):
        made[i] = zlib.crc32(flat[starts[i] + 64 : ends[i]].tobytes(), int(made[i]))
    return made


def _counted(keys: list, flat: np.ndarray, offsets: np.ndarray) -> pa.RecordBatch | None:
    """Distinct words of some rows and how often they occur."""
    flat = np.where((flat >= 0x41) & (flat <= 0x5A), flat | np.uint8(0x20), flat)
    starts, ends, rows = word_spans(in_runs(flat).view(np.uint8), offsets, np.array([False, True]))
    points = np.zeros(len(flat) + 1, np.int64)
    np.cumsum((flat & 0xC0) != 0x80, out=points[1:])
    size = points[ends] - points[starts]
    long = size >= LEAST_LENGTH
    starts, ends, rows, size = starts[long], ends[long], rows[long], size[long]
    heads = np.array([zlib.crc32(f"{'' if k is None else k}:".encode()) for k in keys], np.uint32)
    sums = crcs(flat, starts, ends, heads[rows])
    damaged = sums % DAMAGE == 0
    whole = ~damaged | (size > LEAST_LENGTH)  # one that loses a character may become too short
    damaged &= whole
    starts, ends = starts[whole], ends[whole]
    if not len(starts):
        return None
    gone = points[starts[damaged[whole]]] + sums[damaged].astype(np.int64) % size[damaged]
    gone = np.searchsorted(points[1:], gone + 1)
    keep = np.zeros(len(flat) + 1, np.int8)
    keep[starts] += 1
    keep[ends] -= 1
    keep = np.cumsum(keep[:-1], dtype=np.int8).astype(bool)
    keep[gone] = False
    keep[gone[flat[gone] == 0xC3] + 1] = False
    place = np.zeros(len(flat) + 1, np.int32)
    np.cumsum(keep, out=place[1:])
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(place[starts], place[-1])), pa.py_buffer(flat[keep])
    )
    found = pc.value_counts(words)
    return pa.RecordBatch.from_arrays([found.field(0), found.field(1)], names=["word", "n"])


def words(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words (word, n) of all texts: runs of letters, each counted after its damage, if any.

    Distinct words are counted in the tasks, so a very common word is few rows of the shuffle. A
    very long text is read in pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                keys = part.column("key").to_pylist()
                for flat, offsets, first in pieces(*utf8(part.column("content")), STEP_BYTES):
                    made = _counted(keys[first:], flat, offsets)
                    if made is not None:
                        yield made

    rows = docs.select(F.col(key).cast("string").alias("key"), content(text).alias("content"))
    found = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return found.where(F.col("n") >= LEAST_COUNT)


def rotations(words: DataFrame) -> DataFrame:
    """Rotations of words: ``key``, the ``letter`` skipped before it, ``n`` of the word.

    Every rotation that stands whole has no letter; one that skips a letter is the key of the word
    without it. ``first`` marks a letter that does not repeat the one before it: of equal letters
    in a row it makes no difference which one is left out.
    """
    word, place, size = F.col("word"), F.col("i"), F.length("word")
    head = F.substring(word, F.lit(1), place)
    turned = words.where(size < LONGEST_WRITTEN).select("word", "n", F.explode(F.sequence(F.lit(0), size)).alias("i"))
    whole = turned.select(
        F.concat(F.substring(word, place + 1, size), F.lit(TERMINATOR), head).alias("key"),
        F.lit(None).cast("int").alias("letter"),
        F.lit(False).alias("first"),
        "n",
    )
    turned = words.where(size <= LONGEST_WRITTEN).select("word", "n", F.explode(F.sequence(F.lit(0), size - 1)).alias("i"))
    letter = F.substring(word, place + 1, F.lit(1))
    cut = turned.select(
        F.concat(F.substring(word, place + 2, size), F.lit(TERMINATOR), head).alias("key"),
        F.ascii(letter).alias("letter"),
        ((place == 0) | (F.substring(word, place, F.lit(1)) != letter)).alias("first"),
        "n",
    )
    return whole.unionByName(cut)


def _powers(base: int, count: int, prime: int) -> np.ndarray:
    made = np.ones(1, np.uint64)
    while len(made) < count:
        made = np.concatenate([made, made * np.uint64(pow(base, len(made), prime)) % np.uint64(prime)])
    return made[:count]


def numbered_rotations(words: DataFrame) -> DataFrame:
    """Rotations of long words, each told by three numbers that any equal rotation has too.

    A word of m code points makes 2 m rows of fixed size; ``name`` stands for the word.
    """

    def sums(points: np.ndarray, prime: int) -> tuple[np.ndarray, np.ndarray]:
        """The rotation at every place: whole, and without the letter before it is turned."""
        q, size = np.uint64(prime), len(points)
        power, back = _powers(BASE, size + 2, prime), _powers(pow(BASE, -1, prime), size + 2, prime)
        head = np.concatenate([[0], np.cumsum(points * power[:size] % q)]).astype(np.uint64) % q
        place = np.arange(size + 1)

        def turned(at: np.ndarray, tail_from: np.ndarray) -> np.ndarray:
            tail, left = (head[-1] + q - head[tail_from]) % q * back[tail_from] % q, size - tail_from
            return (tail + power[left] * np.uint64(ord(TERMINATOR)) + head[at] * power[left + 1] % q) % q

        return turned(place, place), turned(place[:-1], place[:-1] + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                points = np.frombuffer(row["word"].encode("utf-32-le"), np.uint32).astype(np.uint64)
                size, made = len(points), [sums(points, prime) for prime in PRIMES]
                for whole in (True, False):
                    # A whole rotation of m is met by one of m + 1 without a letter.
                    if not whole and size <= LONGEST_WRITTEN:
                        continue
                    count = size + whole
                    changed = np.concatenate([[True], points[1:] != points[:-1]])
                    for start in range(0, count, 1 << 16):
                        some = np.arange(start, min(start + (1 << 16), count))
                        letter = pa.nulls(len(some), pa.int32()) if whole else pa.array(points[some].astype(np.int32))
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array([row["name"]] * len(some)),
                                pa.array(np.full(len(some), size - (not whole))),
                                *(pa.array(m[0 if whole else 1][some].astype(np.int64)) for m in made),
                                letter,
                                pa.array(np.zeros(len(some), bool) if whole else changed[some]),
                                pa.array(np.full(len(some), row["n"])),
                                pa.array(some),
                            ],
                            names=NUMBERED.replace(",", "").split()[::2],
                        )

    rows = words.where(F.length("word") >= LONGEST_WRITTEN).select("word", "n", F.md5("word").alias("name"))
    return rows.mapInArrow(run, NUMBERED)


NUMBERED = "name string, size long, k0 long, k1 long, k2 long, letter int, first boolean, n long, i long"


def neighbours(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of rotations that have neighbours: how many, and the most frequent that may be a form.

    ``n_near`` counts the words of the group that lie one edit away by this rotation. ``swap`` is
    the letter of the commonest word with another letter here, and ``swap_n`` its number, null if
    it occurs too seldom for a form; ``cut_n`` is the number of the word without the letter, where
    it occurs often enough. A word is never its own form, as it would have to occur more often.
    """
    group, kept = Window.partitionBy(*keys), rows.columns
    letter, n, first = F.col("letter"), F.col("n"), F.col("first")
    rank = n * 256 + (255 - letter)  # null for whole rotations; ties go to the smaller letter
    rows = rows.select(
        "*",
        F.count("letter").over(group).alias("_cuts"),
        F.count(F.when(first, 1)).over(group).alias("_firsts"),
        F.max(rank).over(group).alias("_top"),
        F.max(F.when(first, rank)).over(group).alias("_top_first"),
        F.max(F.when(letter.isNull(), n)).over(group).alias("_whole"),
    )
    whole = letter.isNull()
    near = F.when(whole, F.col("_firsts")).otherwise(
        F.col("_cuts") - 1 + F.when(first & F.col("_whole").isNotNull(), 1).otherwise(0)
    )
    top = F.when(whole, F.col("_top_first")).otherwise(F.col("_top"))
    enough = F.shiftright(top, 8) >= n * FORM_FACTOR
    return rows.select(
        *kept,
        near.alias("n_near"),
        F.when(enough, F.shiftright(top, 8)).alias("swap_n"),
        F.when(enough, F.chr(255 - top % 256)).alias("swap"),
        F.when(~whole & first & (F.col("_whole") >= n * FORM_FACTOR), F.col("_whole")).alias("cut_n"),
    ).where("n_near > 0")


def _best(head, tail):
    """The candidate of largest number, of these the first in code-point order: (-n, form)."""
    swap = F.when(F.col("swap_n").isNotNull(), F.struct((-F.col("swap_n")).alias("n"), F.concat(head, "swap", tail).alias("form")))
    cut = F.when(F.col("cut_n").isNotNull(), F.struct((-F.col("cut_n")).alias("n"), F.concat(head, tail).alias("form")))
    return F.least(swap, cut)


def links(words: DataFrame) -> DataFrame:
    """Words that have neighbours: word, n_near and ``best`` (minus n, form), null without a form."""
    found = neighbours(rotations(words), ["key"])
    head, tail = F.substring_index("key", TERMINATOR, -1), F.substring_index("key", TERMINATOR, 1)
    letter = F.when(F.col("letter").isNull(), "").otherwise(F.chr("letter"))
    short = found.select(F.concat(head, letter, tail).alias("word"), "n_near", _best(head, tail).alias("best"))

    found = neighbours(numbered_rotations(words), ["k0", "k1", "k2", "size"])
    # Strings are only made of the candidates that no other beats by number.
    most = F.greatest("swap_n", "cut_n")
    found = found.withColumn("_most", F.max(most).over(Window.partitionBy("name")))
    kept = F.when(most == F.col("_most"), F.col("i"))
    found = found.groupBy("name", kept.alias("i"), "swap", "swap_n", "cut_n", F.col("letter").isNull().alias("whole")).agg(
        F.sum("n_near").alias("n_near")
    )
    named = words.where(F.length("word") >= LONGEST_WRITTEN).select("word", F.md5("word").alias("name"))
    found = found.join(named, "name")
    place, size = F.col("i").cast("int"), F.length("word")
    head = F.substring(F.col("word"), F.lit(1), place)
    tail = F.substring(F.col("word"), place + F.when(F.col("whole"), 1).otherwise(2), size)
    long = found.select("word", "n_near", _best(head, tail).alias("best"))
    return short.unionByName(long).groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of written ``forms`` (word, form): the last word that forms lead to.

    A form occurs at least ten times as often as its variant, so chains are short and end.
    """
    following = forms.select(F.col("word").alias("root"), F.col("form").alias("next"))
    live, level = forms.select("word", F.col("form").alias("root")), 0
    levels = live.withColumn("level", F.lit(level))
    while not live.isEmpty():
        moved = join_spread(live, following, ["root"], F.xxhash64("word"))
        live, level = written(moved.select("word", F.col("next").alias("root")), "roots"), level + 1
        levels = levels.unionByName(live.withColumn("level", F.lit(level)))
    return levels.groupBy("word").agg(F.max_by("root", "level").alias("root"))


def variants(docs: DataFrame, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of ``docs`` with the commoner spelling that each is taken for, and where that leads.

    One row per word (at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences): word,
    form, root, n, n_near, form_n. Ties go to the form that is first in code-point order. Null and
    empty texts have no words; a null key reads as the empty text in the damage of its runs; a
    repeated row counts again; a very long text is read in pieces and a very long word by numbers
    for its rotations, both whole; other columns are not read; empty tables give no rows.
    """
    found = written(words(docs, key=key, text=text), "words")
    near = written(links(found), "near-words")
    forms = near.where("best IS NOT NULL").select("word", F.col("best.form").alias("form"), (-F.col("best.n")).alias("form_n"))
    forms = written(forms, "forms")
    made = found.join(near.select("word", "n_near"), "word", "left").join(forms, "word", "left")
    return made.join(roots(forms), "word", "left").select(
        "word",
        "form",
        F.coalesce("root", "word").alias("root"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        "form_n",
    )
