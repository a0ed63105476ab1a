"""Known licence sentences and the ordered rules that tell licences by them. Data only.

Full texts and headers are told by grants and conditions, which several licences share; notices by
lead-ins ("Released under", "This code is licensed under the terms of", ...) before the names that
a licence goes by; SPDX tags by their identifier.
"""

from __future__ import annotations

import re

#: What stands before a licence's name in a notice.
UNDER = ("released under", "licensed under", "distributed under", "licensed under the terms of", "distributed under the terms of")
SUBJECTS = ("code", "library", "program", "project", "software")
SUBJECTS_CC = ("project", "work")


def leads(licence: str) -> tuple[str, ...]:
    subjects = SUBJECTS_CC if licence.startswith("CC") else SUBJECTS
    return (*UNDER, *(f"This {x} is {verb}" for x in subjects for verb in (*UNDER[:2], UNDER[3])))


_CC = {
    "CC-BY": ("CC BY", "Attribution"),
    "CC-BY-SA": ("CC BY-SA", "Attribution-ShareAlike"),
    "CC-BY-NC": ("CC BY-NC", "Attribution-NonCommercial"),
    "CC-BY-NC-SA": ("CC BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    "CC-BY-ND": ("CC BY-ND", "Attribution-NoDerivatives"),
    "CC-BY-NC-ND": ("CC BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
}
#: Names in notices. Short forms of the GNU licences are left out: "GPLv2+" and "GPLv2" normalise
#: to the same words, and are different licences.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("the MIT License", "MIT License", "MIT"),
    "Apache-2.0": (
        "the Apache License, Version 2.0",
        "the Apache License 2.0",
        "the Apache 2.0 License",
        "Apache License 2.0",
        "Apache 2.0",
    ),
    "BSD-2-Clause": ("the BSD 2-Clause License", "the 2-Clause BSD License", "the Simplified BSD License"),
    "BSD-3-Clause": ("the BSD 3-Clause License", "the 3-Clause BSD License", "the New BSD License"),
    "ISC": ("the ISC License",),
    "MPL-2.0": ("the Mozilla Public License, version 2.0", "the Mozilla Public License 2.0"),
    "GPL-2.0-only": ("the GNU General Public License, version 2",),
    "GPL-2.0-or-later": ("the GNU General Public License, version 2 or later",),
    "GPL-3.0-only": ("the GNU General Public License, version 3",),
    "GPL-3.0-or-later": ("the GNU General Public License, version 3 or later",),
    "LGPL-2.1-only": ("the GNU Lesser General Public License, version 2.1",),
    "LGPL-2.1-or-later": ("the GNU Lesser General Public License, version 2.1 or later",),
    "LGPL-3.0-only": ("the GNU Lesser General Public License, version 3",),
    "LGPL-3.0-or-later": ("the GNU Lesser General Public License, version 3 or later",),
    "AGPL-3.0-only": ("the GNU Affero General Public License, version 3",),
    "AGPL-3.0-or-later": ("the GNU Affero General Public License, version 3 or later",),
    "Unlicense": ("the Unlicense",),
    "Zlib": ("the zlib License",),
    "BSL-1.0": ("the Boost Software License, Version 1.0",),
    "EPL-2.0": ("the Eclipse Public License 2.0", "the Eclipse Public License, version 2.0"),
    "0BSD": ("the Zero-Clause BSD License",),
    "CC0-1.0": ("CC0 1.0", "the CC0 1.0 Universal License"),
    **{
        f"{spdx}-4.0": (f"{short} 4.0", *(f"{a} Creative Commons {long} 4.0 International License" for a in ("a", "the")))
        for spdx, (short, long) in _CC.items()
    },
}

#: The line below the title of a full text, by licence.
_DATES = {"gpl2": "gpl2-date", "gpl3": "gpl3-date", "lgpl21": "lgpl21-date", "lgpl3": "gpl3-date", "agpl3": "agpl3-date"}
_FSF = "as published by the Free Software Foundation"
_SHARE = "you can redistribute it and/or modify it under the terms of the GNU"


def _gnu() -> tuple[dict[str, str], list[tuple[str, tuple[str, ...]]]]:
    """The headers that the GNU licences tell programs to carry, with commas or semicolons."""
    sentences: dict[str, str] = {
        "gnu-library": "This library is free software:",
        "gnu-software": "This software is free software:",
        "gnu-file": "This file is free software:",
    }
    rules: list[tuple[str, tuple[str, ...]]] = []
    families = {"gpl": "General", "lgpl": "Lesser General", "agpl": "Affero General"}
    for family, name in families.items():
        licence = f"{_SHARE} {name} Public License"
        sentences[f"{family}-share"] = f"{licence} {_FSF};"
        for version in {"gpl": ("2", "3"), "lgpl": ("2.1", "3"), "agpl": ("3",)}[family]:
            spdx = f"{family.upper()}-{version if '.' in version else version + '.0'}"
            mark = family + version.replace(".", "")
            sentences |= {
                f"{mark}-either": f"{licence} {_FSF}, either version {version} of the License, or (at your option) any later version.",
                f"{mark}-only": f"{licence} {_FSF}, version {version} of the License.",
                f"{mark}-under": f"{licence} version {version} {_FSF}.",
                f"{mark}-comma": f"{licence}, version {version}, {_FSF}.",
            }
            rules += [
                (f"{spdx}-or-later", (f"{mark}-either",)),
                (f"{spdx}-or-later", (f"{family}-share", f"gnu{version.replace('.', '')}-either")),
                *((f"{spdx}-only", (f"{mark}-{x}",)) for x in ("only", "under", "comma")),
                (f"{spdx}-only", (f"{family}-share", f"gnu{version.replace('.', '')}-only")),
                (f"{spdx}-only", (f"{family}-title", _DATES[mark])),
            ]
        sentences[f"{family}-title"] = f"GNU {name} Public License"
    for version in ("2", "2.1", "3"):
        mark = "gnu" + version.replace(".", "")
        sentences[f"{mark}-either"] = f"either version {version} of the License, or (at your option) any later version."
        sentences[f"{mark}-only"] = f"version {version} of the License."
    return sentences, rules


TEXTS: dict[str, str] = {
    "mit-condition-2": (
        "The above copyright notice and this permission notice (including the next paragraph) shall "
        "be included in all copies or substantial portions of the Software."
    ),
    "apache-title": "Apache License",
    "apache2-date": "Version 2.0, January 2004",
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "bsd-source-and": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions, and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "bsd-nor": (
        "nor the names of its contributors may be used to endorse or promote products derived from "
        "this software without specific prior written permission."
    ),
    "bsd-author": (
        "The name of the author may not be used to endorse or promote products derived from this "
        "software without specific prior written permission."
    ),
    "bsd-advert": (
        "All advertising materials mentioning features or use of this software must display the "
        "following acknowledgement:"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "isc-grant-and": (
        "Permission to use, copy, modify, and distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies."
    ),
    "0bsd-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted."
    ),
    "mpl2-title": "Mozilla Public License, version 2.0",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v.",
    "mpl2-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "mpl2-copy-s": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "zlib-grant": (
        "Permission is granted to anyone to use this software for any purpose, including commercial "
        "applications, and to alter it and redistribute it freely, subject to the following restrictions:"
    ),
    "zlib-notice": "This notice may not be removed or altered from any source distribution.",
    "bsl-title": "Boost Software License - Version 1.0 - August 17th, 2003",
    "epl2-title": "Eclipse Public License - v 2.0",
    "cc0-title": "CC0 1.0 Universal",
    "gpl2-date": "Version 2, June 1991",
    "lgpl21-date": "Version 2.1, February 1999",
    "gpl3-date": "Version 3, 29 June 2007",
    "agpl3-date": "Version 3, 19 November 2007",
    "spdx-tag": "SPDX-License-Identifier:",
}
#: Names in package classifiers, and identifiers that were given up for others.
FIELDS: dict[str, tuple[str, ...]] = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License Version 2.0"),
    "BSD-2-Clause": ("BSD 2-Clause License",),
    "BSD-3-Clause": ("BSD 3-Clause License",),
    "ISC": ("ISC License", "ISC License (ISCL)"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License 2.0 (MPL 2.0)"),
    "GPL-2.0-only": ("GPL-2.0", "GNU General Public License v2 (GPLv2)"),
    "GPL-2.0-or-later": ("GNU General Public License v2 or later (GPLv2+)",),
    "GPL-3.0-only": ("GPL-3.0", "GNU General Public License v3 (GPLv3)"),
    "GPL-3.0-or-later": ("GNU General Public License v3 or later (GPLv3+)",),
    "LGPL-2.1-only": ("LGPL-2.1",),
    "LGPL-3.0-only": ("LGPL-3.0", "GNU Lesser General Public License v3 (LGPLv3)"),
    "LGPL-3.0-or-later": ("GNU Lesser General Public License v3 or later (LGPLv3+)",),
    "AGPL-3.0-only": ("AGPL-3.0", "GNU Affero General Public License v3"),
    "AGPL-3.0-or-later": ("GNU Affero General Public License v3 or later (AGPLv3+)",),
    "Unlicense": ("The Unlicense (Unlicense)",),
    "BSL-1.0": ("Boost Software License 1.0 (BSL-1.0)",),
}
_BSD = [("bsd-grant", source, "bsd-binary") for source in ("bsd-source", "bsd-source-and")]
TEXT_RULES: list[tuple[str, tuple[str, ...]]] = [
    ("MIT", ("mit-grant", "mit-condition-2")),
    ("Apache-2.0", ("apache-title", "apache2-date")),
    *(("BSD-3-Clause", ("bsd-grant", end)) for end in ("bsd-nor", "bsd-author")),
    *(("BSD-4-Clause", (*ids, "bsd-advert")) for ids in _BSD),
    *(("BSD-2-Clause", ids) for ids in _BSD),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-grant-and",)),
    ("0BSD", ("0bsd-grant",)),
    ("MPL-2.0", ("mpl2-title",)),
    ("MPL-2.0", ("mpl-form", "mpl2-copy")),
    ("MPL-2.0", ("mpl-form", "mpl2-copy-s")),
    ("Unlicense", ("unlicense-free",)),
    ("Zlib", ("zlib-grant", "zlib-notice")),
    ("BSL-1.0", ("bsl-title",)),
    ("EPL-2.0", ("epl2-title",)),
    ("CC0-1.0", ("cc0-title",)),
]
#: Texts of these licences are the beginnings of others: what mustn't follow before the rule's
#: first sentence stands again.
WITHOUT: dict[str, tuple[str, ...]] = {
    "BSD-2-Clause": ("bsd-endorse", "bsd-nor", "bsd-author", "bsd-advert"),
    "BSD-3-Clause": ("bsd-advert",),
}
#: Clauses that name a holder are read as if they named the copyright holder.
HOLDER = (
    r"\bneither the names? of [a-z0-9 ]{1,120}? nor the names of (?:its|their|the|any) contributors\b",
    "neither the name of the copyright holder nor the names of its contributors",
)


def extended(
    sentences: dict[str, str], rules: tuple[tuple[str, tuple[str, ...]], ...]
) -> tuple[dict[str, str], tuple[tuple[str, tuple[str, ...]], ...]]:
    """The given sentences and rules, then those above that they lack."""
    gnu, gnu_rules = _gnu()
    more, made = {**TEXTS, **gnu}, [*TEXT_RULES, *gnu_rules]
    for licence, names in NAMES.items():
        mark = licence.lower().replace(".", "-")
        for i, name in enumerate(names):
            for k, lead in enumerate(leads(licence)):
                more[f"{mark}-notice-{i}-{k}"] = f"{lead} {name}."
                made.append((licence, (f"{mark}-notice-{i}-{k}",)))
        more[f"{mark}-tag"] = licence
        made.append((licence, ("spdx-tag", f"{mark}-tag")))
        plain_names = (n.removeprefix("the ") for n in names if n not in ("MIT", licence))
        for i, name in enumerate(dict.fromkeys((*plain_names, *FIELDS.get(licence, ())))):
            more[f"{mark}-field-{i}"] = name
            made.append((licence, ("spdx-tag", f"{mark}-field-{i}")))
    for spdx, (_, long) in _CC.items():
        more[f"{spdx.lower()}4-title"] = f"{long} 4.0 International"
        made.append((f"{spdx}-4.0", (f"{spdx.lower()}4-title",)))

    def words(sentence: str) -> str:
        return " ".join(re.findall("[a-z0-9]+", sentence.lower()))

    known = {words(s): i for i, s in sentences.items()}
    same = {i: known.setdefault(words(s), i) for i, s in more.items()}
    whole = {**sentences, **{i: s for i, s in more.items() if same[i] == i}}
    there = [*rules, *((licence, tuple(same.get(i, i) for i in ids)) for licence, ids in made)]
    return whole, tuple(dict.fromkeys(there))
