"""A table with every oddity that the corpus operators must take."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, key string, content string, "
    "node long, label string, bands string, start long, length long, n_words long, _rank long, "
    "sequence_id string, digest string, toxic string, weight double, doc long, tag string"
)
EXTRA = len(SCHEMA.split(",")) - 5


def words(seed: int, count: int) -> str:
    pick = random.Random(seed)
    return " ".join("".join(pick.choices("abcdefgh", k=pick.randint(2, 8))) for _ in range(count))


LONG = words(1, 60_000)
BASE = words(2, 200)
ROWS = [
    (1, BASE, "en", "a"),
    (2, BASE, "en", "a"),
    (3, BASE.replace(" ", "\n", 3), "en", None),
    (4, BASE.rsplit(" ", 2)[0] + " other end", None, "b"),
    (5, None, None, None),
    (6, "", "en", "b"),
    (7, " \t\n ", "de", "b"),
    (8, LONG, "en", "a"),
    (9, "one two", "de", "a"),
    (10, "one two", "de", "a"),
    (11, "éß中\U0001f600 " * 80, "fr", "c"),
    (12, "x" * 30_000, "fr", "c"),
    (12, "same key, another text", "en", "c"),
    (13, "a repeated row", "en", "c"),
    (13, "a repeated row", "en", "c"),
    (None, "no key", "en", "a"),
    (None, None, None, "a"),
    (14, "<|endoftext|> in a text", "en", "a"),
    (15, "Released under the MIT License.", "en", "a"),
    (16, words(3, 400), "en", "a"),
    (17, words(4, 400), "de", "a"),
]


def odd(spark):
    extra = ("x", "y", 1, "z", "b", 2, 3, 4, 5, "s", "d", "t", 0.5, 6, "g")
    rows = [(i, t, lang, source, len(t or ""), *extra) for i, t, lang, source in ROWS]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
