"""The pipeline, stage by stage, against brute force; odd rows and empty tables."""

from __future__ import annotations

import re
from collections import defaultdict

import pytest

import corpus_pipeline as pipeline
import odd_rows
from sensorloom.llm import rules
from sensorloom.llm.common import documents, written
from test_llm_native import measures
from test_llm_texts import brute_links
from test_llm_tokens import check_packed

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage got and made, as rows by document."""
    docs, made = documents(spark, SF_DIR), {}
    for name, stage in pipeline.STAGES:
        result = written(stage(spark, docs, SF_DIR), name)
        made[name] = ({r.doc_id: r for r in docs.collect()}, result.collect())
        if name != "pack":
            assert result.columns == documents(spark, SF_DIR).columns
        docs = result
    return made


def test_stages_stand_in_order():
    assert [n for n, _ in pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "mix", "pack"]


def test_rows_stay_as_they_are(steps):
    for name in ("quality_rules", "exact_dedup", "near_dedup", "mix"):
        before, after = steps[name]
        assert len({r.doc_id for r in after}) == len(after)
        assert all(before[r.doc_id] == r for r in after)


def test_quality(steps):
    before, after = steps["quality_rules"]
    held = {i: dict(zip(rules.MEASURES, measures(r.text), strict=True)) for i, r in before.items()}
    want = {i for i, m in held.items() if not any(eval(f.replace("OR", "or"), {}, m) for _, f in rules.RULES)}
    assert {r.doc_id for r in after} == want


def test_exact(steps):
    before, after = steps["exact_dedup"]
    groups = defaultdict(list)
    for i, r in before.items():
        groups[re.sub("[\x20\x09-\x0d]", "", r.text)].append((-len(r.text), i))
    assert {r.doc_id for r in after} == {min(g)[1] for g in groups.values()}


def test_near(steps):
    before, after = steps["near_dedup"]
    ids = sorted(before)
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in brute_links([before[i].text for i in ids]):
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    assert {r.doc_id for r in after} == {ids[x] for x in range(len(ids)) if find(x) == x}


def test_mix_draws_most(steps):
    before, after = steps["mix"]
    sizes = {i: len(r.text.split()) for i, r in before.items()}
    drawn = sum(sizes[r.doc_id] for r in after) / sum(sizes.values())
    assert abs(drawn - pipeline.BUDGET) < 0.1


def test_packed(steps):
    import zlib

    before, after = steps["pack"]
    rows = [Piece(r, zlib.crc32(bytes(r.ids))) for r in after]
    check_packed(rows, {i: r.text for i, r in before.items()}, 2048)


class Piece:
    def __init__(self, row, crc):
        self.ids_crc32 = crc
        for name in ("doc_id", "piece", "start", "length", "sequence_id", "offset"):
            setattr(self, name, row[name])


def test_odd_rows_go_through(spark, odd, none):
    docs = odd.select(*pipeline.COLUMNS, "key", "content", "n_words")
    for _, stage in pipeline.STAGES[1:4]:  # the rules would drop most of them
        docs = written(stage(spark, docs, SF_DIR), "odd")
        assert docs.columns == pipeline.COLUMNS
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(rows) == len(set(rows)) <= len({t for _, t, *_ in odd_rows.ROWS})
    assert pipeline.pack(spark, docs, SF_DIR).count() >= len(rows)
    for _, stage in pipeline.STAGES:
        assert stage(spark, none, SF_DIR).count() == 0


def test_run_applies_all_stages(spark, steps):
    made = pipeline.run(spark, SF_DIR)
    assert sorted((r.doc_id, r.piece) for r in made.select("doc_id", "piece").collect()) == sorted(
        (r.doc_id, r.piece) for r in steps["pack"][1]
    )


@pytest.mark.parametrize("key", [5, None])
@pytest.mark.parametrize("parts", [1, 3])
def test_exact_stage_keeps_the_longest_of_one_key(spark, key, parts):
    """Texts of one key that differ in white space only: the one with most code points stays."""
    text = odd_rows.words(8, 80)
    texts = [text.replace(" ", ""), text, text.replace(" ", "   "), text.replace(" ", "\n\t"), text.replace(" ", " \t ")]
    rows = [(key, t, "en", "a", len(t)) for t in texts] + [(6, text, "en", "a", len(text))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = pipeline.exact_dedup(spark, docs.repartition(parts), SF_DIR).collect()
    assert [(r.doc_id, r.text) for r in kept] in ([(key, texts[2])], [(key, texts[4])])
    again = pipeline.exact_dedup(spark, docs.repartition(4 - parts), SF_DIR).collect()
    assert again == kept
