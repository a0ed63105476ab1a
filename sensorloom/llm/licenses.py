"""Licence scans by sentence rules. Spark expressions only.

Sentences are normalised and mapped to identifiers of known licence sentences; the sequence of
identifiers in a text is matched against ordered rules.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.llm import licence_texts
from sensorloom.llm.common import SPACES, content

#: Known licence sentences: identifier and text, as the licences and their notices word them.
SENTENCES: dict[str, str] = {
    "mit-notice": "Released under the MIT License.",
    "mit-notice-2": "Licensed under the MIT License.",
    "mit-title": "MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        'software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-condition": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "apache2-notice": "Licensed under the Apache License, Version 2.0.",
    "apache2-header": 'Licensed under the Apache License, Version 2.0 (the "License");',
    "apache2-compliance": "you may not use this file except in compliance with the License.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-free": "This program is free software:",
    "gpl3-later": (
        "you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version."
    ),
    "gpl-hope": (
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;"
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "bsd-endorse": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission."
    ),
    "cc-by-nc4-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by4-notice": "Licensed under CC BY 4.0.",
    "cc-by4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

#: Rules in order: licence and the identifiers that must follow each other, others between allowed.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-grant", "mit-condition")),
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache2-header", "apache2-compliance")),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl3-free", "gpl3-later", "gpl-hope")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-endorse")),
    ("CC-BY-NC-4.0", ("cc-by-nc4-notice",)),
    ("CC-BY-4.0", ("cc-by4-notice",)),
    ("CC-BY-4.0", ("cc-by4-work",)),
)
SENTENCES, RULES = licence_texts.extended(SENTENCES, RULES)
#: Known sentences are a literal of the plan.
MOST_SENTENCES = 2000
_MARK, _GIVES = "\x01", "\x02"
#: What sentences are compared by. Spelt out, as Java looks up a class of characters in a table, while
#: one of several ranges takes it eight times as long.
_KEPT = "abcdefghijklmnopqrstuvwxyz0123456789"


def plain(sentence: str) -> str:
    """A sentence in lower-case letters and digits, single spaces between."""
    return " ".join("".join(c if c in _KEPT else " " for c in sentence.lower()).split())


def _if_there(mark: str, pattern: str, by: str) -> Column:
    """Replace a pattern in the texts that hold ``mark``, which is cheaper to look for."""
    text = F.col("_text")
    return F.when(F.contains(text, F.lit(mark)), F.regexp_replace(text, pattern, by)).otherwise(text)


def in_sentences(docs: DataFrame, key: str, text: Column) -> DataFrame:
    """Key and ``_text``: the text in lower case, with what licence notices wear put plainly.

    Markup tags become spaces. A plus behind a GNU identifier is spelt out, as it is no letter.
    "License: ..." lines and package classifiers are read as SPDX tags, each identifier of an SPDX
    expression as a tag of its own. "See the LICENSE file for details" ends the sentence before it.
    Each step is a projection of its own: it names the text more than once, so nested in one
    expression each would double the work of those before it.
    """
    tag = "spdx-license-identifier:"
    field = r"(?m)^([^\p{L}\p{N}\n]{0,8})licen[sc]e[\"']?[ \t]*[:=][ \t]*(?=[\"'(]?[a-z0-9])"
    fields = F.regexp_replace("_text", field, f"$1{tag} ")
    expression = r"[ )]+(?:or(?! later)|and|with)[ (]+(?<=spdx-license-identifier:[^\n]{0,200})"
    see = r"[\s,;(–—-]+see (?:the )?\S{0,60}licen[sc]e\S{0,60}(?: file)?(?: for (?:more |full |further )?(?:details|information))?"
    rows = docs.select(F.col(key), F.lower(text).alias("_text"))
    for step in (
        _if_there("<", r"</?[a-z][^<>]{0,300}>", " "),
        _if_there("+", r"(gpl-[0-9](?:\.[0-9])?)\+", "$1-or-later"),
        _if_there("license ::", r"license :: (?:osi approved :: )?(?!osi approved)", f"{tag} "),
        F.when(F.col("_text").rlike(r"licen[sc]e[\"']?[ \t]*[:=]"), fields).otherwise(F.col("_text")),
        _if_there(tag, expression, f" {_MARK} "),
        _if_there("see ", see, "."),
    ):
        rows = rows.withColumn("_text", step)
    return rows


def identified(docs: DataFrame, key: str, text: Column, sentences: Mapping[str, str]) -> DataFrame:
    """Key and ``_found``: the parts of a text that hold known sentences, identifiers ``s`` and ``l``.

    ``s`` is that of the whole part (or null), ``l`` those of its lines. Parts end at sentence ends
    and at lines without a letter or digit, so that a sentence may run over lines and a comment's
    empty lines count; lines, so that a notice on its own line counts after one without a full stop.
    """
    empty = r"\n[^\p{L}\p{N}\n]*\n"
    # A ';' that leads a comment line ends no sentence.
    end = rf"([.!?;:])(?<!(?:^|\n)[^\p{{L}}\p{{N}}\n]{{0,8}}){SPACES}+"
    rows = in_sentences(docs, key, text).withColumn("_text", F.regexp_replace("_text", f"{end}|{empty}", f"$1{_MARK}"))

    def bare(kept: str) -> Column:
        return F.regexp_replace("_text", f"[^{_KEPT}{_MARK}{kept}]+", " ")

    rows = rows.select(
        F.col(key),
        # The marks are the same in both, and so are the numbers of parts.
        F.split(F.regexp_replace(bare(""), *map(F.lit, licence_texts.HOLDER)), _MARK).alias("_parts"),
        F.split(bare("\n"), _MARK).alias("_lines"),
    )
    # As SQL text, for the many literals. A map is searched key by key, a set by hash.
    words = {plain(s): i for i, s in sentences.items()}
    known = f"str_to_map('{_MARK.join(f'{w}{_GIVES}{i}' for w, i in words.items())}', '{_MARK}', '{_GIVES}')"
    one = f"CASE WHEN trim({{0}}) IN ({', '.join(map(repr, words))}) THEN element_at({known}, trim({{0}})) END"
    return rows.select(
        key,
        F.expr(
            "filter(zip_with(_parts, _lines, (part, part_lines) -> struct("
            f"{one.format('part')} AS s, "
            f"array_compact(transform(split(part_lines, '\n'), line -> {one.format('line')})) AS l)), "
            "x -> x.s IS NOT NULL OR size(x.l) > 0)"
        ).alias("_found"),
    )


def scan(
    docs: DataFrame,
    *,
    sentences: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row for each row of ``docs``: key, sentence_ids and line_ids (arrays), licences (array).

    A rule holds when its identifiers stand in this order among those of the text, by both cuts in
    one sequence: a part's own before those of its lines. ``WITHOUT`` names licences whose texts
    others begin with.
    Licences come in rule order, each once. Null and empty texts have none; null and repeated keys
    stay; other columns are not read; no rows give no rows. No shuffle: a text is one row's work, read
    whole however long it is.
    """
    if len(sentences) > MOST_SENTENCES:
        raise ValueError("too many known sentences for a plan")
    if any(re.search(r"[.!?;:]\s+\S|\n", s) for s in sentences.values()):
        raise ValueError("a known sentence must be one sentence, as texts are cut")
    if any(re.search(r"[ %_'\\\x01\x02]", i) for i in sentences):
        raise ValueError("identifiers must be free of spaces, quotes, backslashes, % and _")
    rows = identified(docs, key, content(text), sentences)
    in_order = F.transform("_found", lambda x: F.concat(F.array_compact(F.array(x["s"])), x["l"]))
    rows = rows.select(
        key,
        F.array_compact(F.transform("_found", lambda x: x["s"])).alias("sentence_ids"),
        F.flatten(F.transform("_found", lambda x: x["l"])).alias("line_ids"),
        # A space on either side of each identifier, so that whole ones match.
        F.concat(F.lit(" "), F.array_join(F.flatten(in_order), "  "), F.lit(" ")).alias("_ids"),
    )
    names = F.split(F.lit(_MARK.join(licence for licence, _ in rules)), _MARK)
    held = F.array_sort(F.concat(_of_one(rules), _of_several(rules)))
    licences = F.array_distinct(F.transform(held, lambda number: F.element_at(names, number)))
    none = F.array().cast("array<string>")
    licences = F.when(F.col("_ids") == "  ", none).otherwise(licences) if rules else none
    return rows.select(key, "sentence_ids", "line_ids", licences.alias("licences"))


def _of_one(rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Numbers from 1 of the rules of one identifier that hold."""
    numbers: dict[str, list[str]] = {}
    for number, (_, ids) in enumerate(rules, 1):
        if len(ids) == 1:
            numbers.setdefault(ids[0], []).append(str(number))
    pairs = _MARK.join(f"{i}{_GIVES}{','.join(n)}" for i, n in numbers.items())
    known = F.str_to_map(F.lit(pairs), F.lit(_MARK), F.lit(_GIVES))
    ids = F.array_distinct(F.concat("sentence_ids", "line_ids"))
    found = F.array_compact(F.transform(ids, lambda i: F.element_at(known, i)))
    return F.flatten(F.transform(found, lambda x: F.split(x, ","))).cast("array<int>")


def _of_several(rules: Sequence[tuple[str, tuple[str, ...]]]) -> Column:
    """Numbers from 1 of the rules of several identifiers that hold."""
    held = []
    for number, (licence, ids) in enumerate(rules, 1):
        if len(ids) == 1:
            continue
        follows = F.col("_ids").like("% " + " % ".join(ids) + " %")
        others = licence_texts.WITHOUT.get(licence)
        if others:

            # What follows each of the first identifier, up to where it stands again.
            after = F.slice(F.split("_ids", f" {ids[0]} "), 2, 1 << 30)
            pattern, other = "% " + " % ".join(ids[1:]) + " %", f" ({'|'.join(others)}) "
            follows = follows & F.exists(after, lambda x: x.like(pattern) & ~x.rlike(other))
        held.append(F.when(follows, number))
    return F.array_compact(F.array(*held)) if held else F.array().cast("array<int>")
