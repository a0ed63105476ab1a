"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

import odd_rows
from sensorloom.llm import queries, spelling
from sensorloom.llm.common import documents, utf8


def counts(rows):
    found = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    n = counts(rows)
    by_size = defaultdict(list)
    for word in n:
        by_size[len(word)].append(word)
    others = {w: [v for d in (-1, 0, 1) for v in by_size[len(w) + d] if near(w, v)] for w in n}
    form = {}
    for word, found in others.items():
        best = min(found, key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 10 * n[word]:
            form[word] = best
    made = {}
    for word in n:
        root = word
        while root in form:
            root = form[root]
        made[word] = (form.get(word), root, n[word], len(others[word]), n.get(form.get(word)))
    return made


def found(docs):
    rows = spelling.variants(docs).collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def test_query_equals_brute_force(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = queries.op13_spelling(spark, sf_dir)
    assert dict(rows.dtypes) == {
        "word": "string", "form": "string", "root": "string", "n": "bigint", "n_near": "bigint", "form_n": "bigint",
    }
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows.collect()}
    assert got == brute([(r.doc_id, r.text) for r in documents(spark, sf_dir).collect()])


def edited(pick, word):
    i, letter = pick.randrange(len(word)), pick.choice("abé")
    return pick.choice([word[:i] + word[i + 1 :], word[:i] + letter + word[i:], word[:i] + letter + word[i + 1 :]])


def test_words_around_the_longest_that_is_written_out(spark):
    """Repeated letters, accents, chains of forms, long words on both sides of the limit."""
    pick = random.Random(1)
    base = ["a" * 64, "a" * 65, "ab" * 32, "é" * 70, "ab" * 33, "abcdefgé", "abcdefgh", "aaaaaaa", "aaaaaaab"]
    rows = []
    for i in range(250):
        word = pick.choice(base)
        for _ in range(pick.choice([0, 1, 1, 2])):
            word = edited(pick, word)
        rows += [(pick.choice([None, 1, 2, i]), word)] * pick.choice([1, 2, 3])
    for word, n in (("zyxwvuts", 1100), ("zyxwvut", 90), ("zyxwvu", 9), ("zyxwvua", 7), ("zyxwvuaa", 2), ("zyxwvuts", 1)):
        rows.append((1, f"{word} " * n))
    for word, n in (("m" * 66, 300), ("m" * 65, 25), ("m" * 64, 2), ("n" + "m" * 66, 30), ("m" * 30 + "n" + "m" * 35, 4)):
        rows.append((2, f"{word}, " * n))
    got, want = found(spark.createDataFrame(rows, "doc_id long, text string")), brute(rows)
    assert got == want
    assert any(root != form for form, root, *_ in want.values() if form)
    assert Counter(len(w) > 64 for w in want if want[w][3])[True] > 10


def test_hot_word_and_hot_root(spark):
    rows = [(i, "commonest word") for i in range(3000)]
    rows += [(i, f"commonest{c} {c}ommonest") for i in range(4) for c in "abdefghijk"]
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_rows(spark, odd, none):
    assert found(odd) == brute([(i, t) for i, t, *_ in odd_rows.ROWS])
    assert found(none) == {} and found(odd.where("text IS NULL")) == {}
    key = spark.createDataFrame([("k1", "abcdefgh abcdefgh"), (None, "abcdefgh")], "id string, body string")
    rows = spelling.variants(key, key="id", text="body").collect()
    assert {r.word: r.n for r in rows} == {w: v[2] for w, v in brute([("k1", "abcdefgh abcdefgh"), (None, "abcdefgh")]).items()}


def test_very_long_text_and_word(spark):
    word = "x" * 30_000
    rows = [(1, f"{odd_rows.words(5, 400_000)} longestword "), (2, f"{word} {word}"), (3, f"y{word} y{word}"), (4, "longestword")]
    rows += [(5, f"{word[1:]} " * 30)]
    n, got = counts(rows), found(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {w: v[2] for w, v in got.items()} == n
    assert got[word][3] == (word[1:] in n) + ("y" + word in n)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="aZÀ×ÿĀ \U0001f600\n", max_size=40), max_size=4), st.integers(1, 30))
def test_pieces_cut_no_run(texts, limit):
    flat, offsets = utf8(pa.array(texts, pa.string()))
    joined = [b""] * len(texts)
    for part, places, first in spelling.pieces(flat, offsets, limit):
        for i, (a, b) in enumerate(zip(places, places[1:], strict=False)):
            if len(flat) > limit and joined[first + i]:
                ends = np.concatenate([np.frombuffer(joined[first + i][-1:], np.uint8), part[a : a + 1]])
                whole = np.frombuffer(joined[first + i] + part[a:b].tobytes(), np.uint8)
                at = len(joined[first + i])
                assert not (spelling.in_runs(whole)[at - 1] and spelling.in_runs(whole)[at]), ends
            joined[first + i] += part[a:b].tobytes()
    assert joined == [t.encode() for t in texts]


@given(st.lists(st.text(max_size=90), min_size=1, max_size=5), st.integers(0, 2**32 - 1))
def test_crcs(texts, before):
    flat, offsets = utf8(pa.array(texts, pa.string()))
    made = spelling.crcs(flat, offsets[:-1], offsets[1:], np.full(len(texts), before, np.uint32))
    assert made.tolist() == [zlib.crc32(t.encode(), before) for t in texts]
