"""Quality rules, licence scans and mixing: odd rows, policies, targets, plans without Python."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest

import odd_rows
from licence_samples import SAMPLES
from sensorloom.llm import licenses, mixing, queries, rules

SF_DIR = "/root/testdata/sf0.01"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["op3_mixing", "op5_licenses", "op7_rules"])
def test_native_queries_run_no_python(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", text)


def measures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    again = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    bare = "".join(words)
    upper = sum(1 for c in bare if c.isupper())
    return (len(words), len(bare), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), upper, len(lines))


TEXTS = [
    None, "", " \n\t ", "a b c", "a b c a b c", "a b a b a b a b", "x x x x x", "line\nline\n\nline\n other",
    "A*B #c $$ <é|É> %&", "one two three four one two three", odd_rows.words(5, 300) + " " + odd_rows.words(5, 300),
]


def test_measurements_are_brute_force(spark, odd, none):
    texts = [*TEXTS, *(t for _, t, *_ in odd_rows.ROWS)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in rules.ledger(docs).collect():
        got = tuple(row[m] for m in rules.MEASURES)
        assert got == measures(texts[row.doc_id])
        held = dict(zip(rules.MEASURES, got, strict=True))
        fails = {n for n, rule in rules.RULES if eval(rule.replace("OR", "or"), {}, held)}
        assert row.failures == rules.mask(tuple(fails))
    assert rules.ledger(odd).count() == len(odd_rows.ROWS)
    assert rules.ledger(none).count() == 0


def test_policies_filter_rows_and_keep_their_columns(spark, odd, none):
    ledger = rules.ledger(odd)
    for policy in rules.POLICIES:
        kept = rules.passing(odd, policy)
        assert kept.columns == odd.columns
        want = ledger.where(rules.verdict(ledger.failures, policy))
        assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in want.collect())
    assert {r.n_words for r in rules.passing(odd, "v1").select("n_words").collect()} == {4}
    assert rules.passing(none).count() == 0


def test_ablations_read_the_bits(spark):
    bits = rules.BITS
    failures = [0, bits["few_words"], bits["few_words"], bits["few_words"] | bits["symbols"], bits["shouting"]]
    ledger = spark.createDataFrame([(f,) for f in failures], "failures long")
    got = {r.rule: (r.failed, r.only_this) for r in rules.ablations(ledger, "v2").collect()}
    assert got == {"few_words": (3, 2), "repeated_windows": (0, 0), "symbols": (1, 0), "repeated_lines": (0, 0)}
    assert rules.ablations(ledger.limit(0), "v1").count() == 2


NOTICES = [
    ("Text. Released under the MIT License. More text.", ["MIT"]),
    ("no stop here\nReleased under the MIT License.\nmore", ["MIT"]),
    (licenses.SENTENCES["mit-grant"] + "\n\n" + licenses.SENTENCES["mit-condition"], ["MIT"]),
    (re.sub("(.{60}) ", "\\1\n", licenses.SENTENCES["mit-grant"] + " " + licenses.SENTENCES["mit-condition"]), ["MIT"]),
    (licenses.SENTENCES["mit-condition"] + " " + licenses.SENTENCES["mit-grant"], []),
    (licenses.SENTENCES["mit-grant"], []),
    ("LICENSED UNDER the Apache License,  Version 2.0.", ["Apache-2.0"]),
    ("Licensed under the Apache License, Version 2.0 and more.", []),
    (licenses.SENTENCES["gpl3-free"] + " " + licenses.SENTENCES["gpl3-later"] + " Between. " + licenses.SENTENCES["gpl-hope"] + " End.", ["GPL-3.0-or-later"]),
    ("Licensed under CC BY-NC 4.0. Released under the MIT License. Licensed under the MIT License.", ["MIT", "CC-BY-NC-4.0"]),
    (None, []),
    ("", []),
    ("This licence is not known.", []),
]


def test_licences_need_their_sentences_in_order(spark, odd, none):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(NOTICES)], "doc_id long, text string")
    found = {r.doc_id: r.licences for r in licenses.scan(docs).collect()}
    assert found == {i: want for i, (_, want) in enumerate(NOTICES)}
    rows = licenses.scan(odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in odd_rows.ROWS)
    assert {r.doc_id for r in rows if r.licences} == {15}
    assert licenses.scan(none).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(odd, sentences={"with space": "x"}, rules=())
    with pytest.raises(ValueError):
        licenses.scan(odd, sentences={"two": "One sentence: and another."}, rules=())


APACHE_HEADER = """Copyright 2020 Someone

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0
"""
GPL_HEADER = """Copyright (C) 2020 Someone

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""


def wrapped(*ids):
    """Known sentences as a header, in lines of some 60 characters."""
    text = " ".join(licenses.SENTENCES[i] for i in ids)
    return "Copyright (c) 2020 Someone\n\n" + re.sub("(.{60}) ", "\\1\n", text) + "\n"


@pytest.mark.parametrize("leader", ["", " * ", "# ", "// ", ";; "])
def test_licences_in_comment_headers(spark, leader):
    headers = {
        "MIT": wrapped("mit-grant", "mit-condition"),
        "Apache-2.0": APACHE_HEADER,
        "BSD-3-Clause": wrapped("bsd-grant", "bsd-endorse"),
        "GPL-3.0-or-later": GPL_HEADER,
        # Without an empty line the first sentence is found by line, the next by sentence.
        "Apache-2.0 ": APACHE_HEADER.replace("\n\n", "\n").replace("except in ", "except in\n"),
    }
    texts = [(name, "/*\n" + re.sub("(?m)^", leader, text) + "\n */\n") for name, text in headers.items()]
    docs = spark.createDataFrame(texts, "doc_id string, text string")
    assert {r.doc_id: r.licences for r in licenses.scan(docs).collect()} == {n: [n.strip()] for n, _ in texts}


@pytest.mark.parametrize("leader", ["", " * ", "# "])
def test_usual_licences_are_told_by_their_texts(spark, leader):
    texts = [(f"{i} {want}", re.sub("(?m)^", leader, text)) for i, (want, text) in enumerate(SAMPLES)]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {r.doc_id: ",".join(r.licences) for r in found} == {i: i.split(" ")[1] for i, _ in texts}


def test_every_covered_licence_has_a_notice_or_a_text(spark):
    licences = {licence for licence, _ in licenses.RULES}
    texts = [(licence, f"// SPDX-License-Identifier: {licence}\n") for licence in sorted(licences - {"BSD-4-Clause"})]
    found = licenses.scan(spark.createDataFrame(texts, "doc_id string, text string")).collect()
    assert {r.doc_id: r.licences for r in found} == {licence: [licence] for licence, _ in texts}
    readme = (Path(__file__).resolve().parents[2] / "README.md").read_text()
    assert all(f"`{licence}`" in readme for licence in licences)


def test_every_rule_names_known_sentences():
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def cells(spark):
    rows = [
        (f"s{a}", f"l{b}", f"t{c}", 1000 * (a + 1) * (b + 1) + 300 * c + 77 * (a * b * c % 5))
        for a in range(5) for b in range(3) for c in range(2)
    ]
    return spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")


def test_raking_meets_every_margin(spark):
    table = cells(spark)
    targets = {m: mixing.tempered(table, m, 0.8) for m in mixing.MARGINS}
    fitted = mixing.rake(table, targets, budget=0.4, rounds=12)
    total = 0.4 * table.groupBy().sum("tokens").first()[0]
    for margin, target in targets.items():
        got = {r[0]: r[1] for r in fitted.groupBy(margin).sum("weight").collect()}
        for level, share in target.collect():
            assert got[level] == pytest.approx(share * total, rel=1e-3)
    assert fitted.where("weight > tokens").isEmpty()


def test_a_short_level_is_drawn_whole(spark):
    table = cells(spark)
    targets = {"source": mixing.named(table, "source", {"s0": 0.9}), "lang": mixing.tempered(table, "lang", 1.0)}
    assert sum(r.share for r in targets["source"].collect()) == pytest.approx(1)
    fitted = mixing.rake(table, targets, budget=0.5, rounds=12)
    # Cells that keep one another's topic apart are rows here too.
    assert fitted.where("source = 's0' AND abs(weight - tokens) > 1e-3 * tokens").isEmpty()
    assert fitted.where("weight > tokens").isEmpty()


def test_draws_follow_the_probabilities(spark, odd, none):
    docs = spark.createDataFrame(
        [(i, odd_rows.words(i % 50, 20 + i % 7), ("a", "b")[i % 9 > 0], ("en", "de")[i % 4 > 0]) for i in range(6000)],
        "doc_id long, text string, source string, lang string",
    )
    powers = {"source": 0.3, "lang": 0.5, "topic": 1.0}
    mixed = mixing.mix(docs, powers, budget=0.3)
    assert mixed.where("probability < 0 OR probability > 1").isEmpty()
    for r in mixed.groupBy("source", "lang").agg({"probability": "avg", "kept": "count"}).collect():
        kept = mixed.where(f"kept AND source = '{r.source}' AND lang = '{r.lang}'").count() / r["count(kept)"]
        assert abs(kept - r["avg(probability)"]) < 0.08
    whole = mixing.drawn(docs, powers, budget=0.3)
    assert whole.columns == docs.columns
    assert {r.doc_id for r in whole.collect()} == {r.doc_id for r in mixed.where("kept").collect()}
    rows = mixing.mix(odd, queries.POWERS, budget=0.5).collect()
    assert Counter(r.doc_id for r in rows) == Counter(i for i, *_ in odd_rows.ROWS)
    assert all(r.source is not None and r.lang is not None for r in rows)
    assert mixing.drawn(odd, queries.POWERS, budget=1.0).columns == odd.columns
    assert mixing.mix(none, queries.POWERS, budget=0.5).count() == 0
    assert mixing.drawn(none, queries.POWERS, budget=0.5).count() == 0


CLOTHED = [
    ("This project is licensed under the MIT License - see the LICENSE.md file for details.", ["MIT"]),
    ("This project is licensed under the MIT License - see the [LICENSE.md](LICENSE.md) file for details", ["MIT"]),
    ("Released under the MIT license, see LICENSE for details.", ["MIT"]),
    ("Text before it. Licensed under the Apache License, Version 2.0 (see the LICENSE file).", ["Apache-2.0"]),
    ("SPDX-License-Identifier: GPL-2.0", ["GPL-2.0-only"]),
    ("/* SPDX-License-Identifier: GPL-2.0+ */\nint x;", ["GPL-2.0-or-later"]),
    ("# SPDX-License-Identifier: LGPL-2.1+", ["LGPL-2.1-or-later"]),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0)", ["MIT", "Apache-2.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0\n", ["GPL-2.0-only"]),
    ("SPDX-License-Identifier: (GPL-3.0+ AND MIT) OR BSD-3-Clause", ["MIT", "BSD-3-Clause", "GPL-3.0-or-later"]),
    ("Name: thing\nLicense: MIT\nVersion: 3", ["MIT"]),
    ('  "license": "Apache-2.0",', ["Apache-2.0"]),
    ("License :: OSI Approved :: MIT License", ["MIT"]),
    ("License :: OSI Approved :: GNU General Public License v3 or later (GPLv3+)", ["GPL-3.0-or-later"]),
    ("<p>Released under the MIT License.</p>", ["MIT"]),
    ("<div class='x'>Licensed under <b>the MIT License</b>.</div>", ["MIT"]),
    ("Licence: unknown to all\nSee the licence for details.", []),
    ("See the text or the other text and more, with 2+2 < 3 > 1.", []),
    ("My driving license: I lost it. See licence office.", []),
]


def test_notices_in_all_their_clothes(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CLOTHED)], "doc_id long, text string")
    found = {r.doc_id: sorted(r.licences) for r in licenses.scan(docs).collect()}
    assert found == {i: sorted(licences) for i, (_, licences) in enumerate(CLOTHED)}


def test_a_very_long_text_is_scanned_whole(spark):
    text = odd_rows.words(3, 300_000) + "\n\nReleased under the MIT License.\n\n" + odd_rows.words(4, 10)
    assert licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first().licences == ["MIT"]


def test_no_step_of_a_licence_scan_is_done_twice_or_by_a_slow_class(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    text = plan(licenses.scan(docs))
    assert text.count("lower(") == 1
    # What each step replaces or looks for, from one that comes early to one that comes late.
    for pattern in ("</?[a-z]", "(gpl-[0-9]", "license :: (?:", "(?m)^(", "[ )]+(?:or", "see (?:the", "([.!?;:])"):
        assert text.count(pattern) == 1
    assert "[^a-z0-9" not in text
