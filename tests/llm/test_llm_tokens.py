"""Token counts, packing: against the tokenizers library and a packer that looks at every bin."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import odd_rows
from sensorloom.llm import packing, queries, tokens
from sensorloom.llm.common import documents
from sensorloom.session import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
LIBRARY = Tokenizer.from_file(queries.TOKENIZER)


def ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_fast_encoder_gives_the_ids_of_the_library():
    texts = [t or "" for _, t, *_ in odd_rows.ROWS] + ["  a\n\n b c", "'s 'LL 12ab!!", " " * 300]
    encoder = tokens.Encoder(queries.TOKENIZER)
    assert encoder.fast is not None
    for text, made in zip(texts, encoder.encode(texts), strict=True):
        assert made.tolist() == ids(text)


@pytest.mark.parametrize("text", ["a" + " " * 2_000_000 + "b", "\n" * 1_000_000 + "end", "x \u3000\t" * 400_000])
def test_long_white_space_gives_the_ids_of_the_library(text, monkeypatch):
    want = ids(text)
    assert tokens.encoder(queries.TOKENIZER).encode([text])[0].tolist() == want
    # Also where only the error of the fast library tells.
    monkeypatch.setattr(tokens, "LONG_SPACES", 1 << 40)
    assert tokens.Encoder(queries.TOKENIZER).encode([text])[0].tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_fast_encoder_on_any_text(text):
    assert tokens.encoder(queries.TOKENIZER).encode([text])[0].tolist() == ids(text)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_files_go_to_their_library(name):
    path = public_tokenizers.path(name)
    made = tokens.Encoder(path).encode(["Hello world", ""])
    assert len(made[0]) > 0 and len(made[1]) == 0


def test_query_counts_tokens_like_the_library(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF_DIR).collect()}
    rows = queries.op8_tokens(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(ids(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_cache_encodes_only_what_it_lacks(spark, odd, none):
    cache = scratch_dir(spark, "cache")
    first = Counter(tuple(r) for r in tokens.count_tokens(odd, queries.TOKENIZER, cache).select("doc_id", "n_bytes", "n_tokens").collect())
    want = Counter((i, len((t or "").encode()), len(ids(t))) for i, t, *_ in odd_rows.ROWS)
    assert first == want
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for _, t, *_ in odd_rows.ROWS})
    # Counts come from the cache: a changed count shows.
    changed = scratch_dir(spark, "cache")
    stored.selectExpr("tokenizer", "digest", "n_tokens + 1000 AS n_tokens").write.parquet(changed)
    again = tokens.count_tokens(odd, queries.TOKENIZER, changed)
    assert {r.n_tokens - 1000 for r in again.collect()} == {n for *_, n in want}
    assert spark.read.parquet(changed).count() == stored.count()
    assert tokens.count_tokens(none, queries.TOKENIZER, changed).count() == 0


def test_cache_keeps_tokenizers_apart(spark, odd):
    cache = scratch_dir(spark, "cache")
    some = odd.where("doc_id = 9")
    one = tokens.count_tokens(some, queries.TOKENIZER, cache).first().n_tokens
    two = tokens.count_tokens(some, public_tokenizers.path("word_bpe_49k.json"), cache).first().n_tokens
    assert (one, two) == (2, 2) and spark.read.parquet(cache).count() == 2


def every_bin(lengths, capacity):
    """Best fit decreasing, each time looking at all bins."""
    bins = []
    for length in sorted(lengths, reverse=True):
        fits = [b for b in range(len(bins)) if bins[b] >= length]
        if fits:
            bins[min(fits, key=lambda b: (bins[b], b))] -= length
        else:
            bins.append(capacity - length)
    return sorted(bins)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120), st.integers(40, 64))
def test_plan_is_best_fit_decreasing(lengths, capacity):
    histogram = Counter(lengths)
    steps = packing.plan(histogram, capacity)
    bins, seated = defaultdict(list), Counter()
    order = {}
    for length, rank, first, fits, offset in steps.tolist():
        order.setdefault(length, []).append((rank, first, fits, offset))
    for length, count in histogram.items():
        runs = sorted(order[length])
        assert runs[0][0] == 0
        for (rank, first, fits, offset), following in zip(runs, [*(r[0] for r in runs[1:]), count]):
            for item in range(following - rank):
                bins[first + item // fits].append((offset + item % fits * length, length))
                seated[length] += 1
    assert seated == histogram
    left = []
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
        left.append(capacity - end)
    assert sorted(left) == every_bin(lengths, capacity)


def test_plan_of_very_many_documents_is_small():
    pick = random.Random(5)
    histogram = {n: pick.randint(1, 10**9) for n in range(1, 2049)}
    steps = packing.plan(histogram, 2048)
    assert len(steps) < 100_000
    tokens_, bins = sum(n * c for n, c in histogram.items()), int((steps[:, 2]).max()) + 1
    assert bins < 1.01 * tokens_ / 2048


def check_packed(rows, texts, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        whole = np.array([*ids(texts[doc]), 0], "<u4")
        first = len(whole) % capacity or capacity
        edges = [0, *range(first, len(whole) + 1, capacity)]
        assert [(r.piece, r.start, r.length) for r in sorted(pieces, key=lambda r: r.piece)] == [
            (n, a, b - a) for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        ]
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(whole[r.start : r.start + r.length].tobytes())
    left = []
    for items in by_sequence.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= capacity
        left.append(capacity - end)
    assert sorted(left) == every_bin([r.length for r in rows], capacity)


def test_query_packs_every_token_once(spark):
    texts = {r.doc_id: r.text for r in documents(spark, SF_DIR).collect()}
    check_packed(queries.op1_packing(spark, SF_DIR).collect(), texts, 2048)


def test_odd_rows_are_packed(spark, odd, none):
    packed = packing.pack(odd, queries.TOKENIZER, capacity=512)
    rows = packed.collect()
    assert sum(r.length for r in rows) == sum(len(ids(t)) + 1 for _, t, *_ in odd_rows.ROWS)
    assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)
    assert all(len(r.ids) == 4 * r.length and 0 < r.length <= 512 for r in rows)
    # A reader puts the text together again.
    long = sorted((r for r in rows if r.doc_id == 8), key=lambda r: r.piece)
    whole = np.frombuffer(b"".join(bytes(r.ids) for r in long), "<u4")
    assert whole[-1] == 0 and LIBRARY.decode(whole[:-1].tolist()) == odd_rows.LONG
    assert packing.pack(none, queries.TOKENIZER).count() == 0
