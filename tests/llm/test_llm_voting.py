"""Nearest-neighbour voting: brute force over all neighbours, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import odd_rows
from sensorloom.llm import queries, voting
from sensorloom.llm.common import documents, hashed_share


def crc(i, modulus):
    return zlib.crc32(("" if i is None else str(i)).encode()) % modulus


def held():
    return hashed_share(F.col("doc_id"), 4) == 2


def test_quality_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op11_quality(spark, sf_dir).collect()
    assert len(rows) == documents(spark, sf_dir).count()
    assert all(r.held_out == (crc(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.7) for r in rows)
    seen = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = (np.array([s for s, y in seen if y == k]) for k in (1, 0))
    assert np.mean(good[:, None] > bad[None, :]) + np.mean(good[:, None] == bad[None, :]) / 2 > 0.97
    assert np.mean(good >= 0.7) > 0.98 and np.mean(bad < 0.7) > 0.85


def test_votes_equal_brute_force():
    """Cosines and votes one document at a time, with all neighbours sorted."""
    texts = [odd_rows.words(i, 5 + i % 60) for i in range(160)] + ["X!! $$$ Y##"] * 3 + ["", "é"]
    counts = voting.terms(pa.array(texts))
    labels = np.array([float(i % 3 > 0) for i in range(100)])
    weights = np.log((1 + len(texts)) / (1 + (counts > 0).sum(axis=0))) + 0.1
    rows = voting.weighted(counts, weights)
    directions = voting.spread(rows[:100], voting.DIMENSIONS)
    space = voting.Space(weights, directions, voting.latent(rows[:100], directions), labels)
    got = voting.voted(space, counts)
    for i, row in enumerate(rows):
        own = voting.latent(row[None], directions)[0].astype(int).tolist()
        near = [sum(a * b for a, b in zip(own, v, strict=True)) / voting.GRID**2 for v in space.vectors.astype(int).tolist()]
        last = sorted(near, reverse=True)[voting.NEIGHBOURS - 1]
        votes = [(max(min(s, 1), 1e-6) ** voting.SHARPNESS, y) for s, y in zip(near, labels, strict=True) if s >= last]
        assert got[i] == pytest.approx(sum(w * y for w, y in votes) / sum(w for w, _ in votes), abs=1e-9)
    # A row alone, or in other company, gets the same score.
    assert [voting.voted(space, counts[i : i + 1])[0] for i in (0, 7, 161)] == [got[i] for i in (0, 7, 161)]


def test_directions_are_the_leading_singular_vectors():
    rows = np.random.default_rng(1).normal(size=(60, 30)) * (0.7 ** np.arange(30))
    made = voting.spread(rows, 5)
    _, _, want = np.linalg.svd(rows, full_matrices=False)
    assert np.allclose(np.abs(np.sum(made * want[:5].T, axis=0)), 1, atol=1e-4)


def test_terms_of_a_long_text_equal_those_of_its_pieces(monkeypatch):
    texts = ["aB c$ é\n" * 30, odd_rows.words(4, 300), "x" * 500, "", "one two"]
    whole = voting.terms(pa.array(texts))
    monkeypatch.setattr(voting, "STEP", 64)
    assert np.array_equal(whole[:2], voting.terms(pa.array(texts))[:2])
    cut = voting.terms(pa.array(texts))
    assert np.array_equal(whole[:, : voting.BUCKETS], cut[:, : voting.BUCKETS])
    plain = Counter(texts[0].encode()[i : i + 3] for i in range(len(texts[0].encode()) - 2))
    assert whole[0, : voting.BUCKETS].sum() == 2 * sum(plain.values()) + 1


def test_labels_of_held_out_rows_change_nothing(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    one = voting.rate(docs, labels, held_out=held()).toPandas().sort_values("doc_id").reset_index(drop=True)
    other = labels.withColumn("quality", F.when(held(), 1 - F.col("quality")).otherwise(F.col("quality")))
    two = voting.rate(docs.repartition(7), other, held_out=held()).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert one.equals(two)


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 17)] + [(None, 1), (2, None), (3, 5)], "doc_id long, quality int")
    rows = voting.rate(odd, labels, held_out=held()).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in odd_rows.ROWS)
    assert all(0 <= r.score <= 1 for r in rows)
    alike = {(r.doc_id): r.score for r in rows}
    assert alike[5] == alike[6] and alike[9] == alike[10] and alike[1] == alike[2]
    assert voting.rate(none, labels, held_out=held()).count() == 0
    alone = voting.rate(odd, labels.where("quality = 1"), held_out=held()).collect()
    assert {r.score for r in alone} == {1.0}
    assert {r.score for r in voting.rate(odd, labels.limit(0), held_out=held()).collect()} == {0.5}


def test_a_hot_labelled_key_brings_a_bounded_sample(spark, monkeypatch):
    from sensorloom.llm import common

    docs = spark.range(5000).selectExpr("1L AS doc_id", "concat('text ', id % 2000) AS text")
    docs = docs.unionByName(spark.range(5).selectExpr("id + 2 AS doc_id", "concat('other ', id) AS text"))
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    args = {"held_out": F.lit(False), "key": "doc_id", "text": F.col("text")}
    rows = common.labelled(docs, labels, "quality", limit=50, **args).collect()
    assert Counter(r.label for r in rows) == {1: 50, 0: 2} and len({r.content for r in rows}) == 52
    again = common.labelled(docs.repartition(9), labels, "quality", limit=50, **args).collect()
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}
