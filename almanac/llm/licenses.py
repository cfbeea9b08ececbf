"""License scans by sentence rules.

Texts are cut into fragments at line ends and sentence marks, and fragments are normalised to lower-case words. A
known license sentence begins and ends with a fragment and may run over several, as license texts are wrapped. The
identifiers of the sentences found, in order, are then matched against ordered rules: the first rule whose sequence
of identifiers occurs takes those sentences, the search goes on with what is left, and sentences that no rule takes
are reported as such.

A sentence may have slots: {4} stands for one to four words, such as the name of a work or its holder. The sentences
are kept as a trie over normalised words. Notices are made by rule, from forms ("This {4} is licensed under") and the
names of the licenses, as are SPDX lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import bound_batches, text_of

# License sentences by identifier, as their licenses word them.
TEXTS = {
    "apache2-notice": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\")",
        "This work is licensed under the Apache License, Version 2.0",
        "Released under the Apache License, Version 2.0",
    ],
    "apache2-comply": ["you may not use this file except in compliance with the License"],
    "apache2-copy": ["You may obtain a copy of the License at"],
    "apache2-warranty": [
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"
    ],
    "mit-notice": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This work is licensed under the MIT License",
        "MIT License",
        "The MIT License (MIT)",
    ],
    "mit-grant": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions"
    ],
    "mit-include": [
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software"
    ],
    "mit-warranty": [
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT"
    ],
    "isc-grant": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies"
    ],
    "bsd-redistribute": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ],
    "bsd-source": [
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer"
    ],
    "bsd-binary": [
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution"
    ],
    "bsd-endorse": [
        "Neither the name of {12} nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
        "Neither the name of {12} nor the names of any contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission",
        "The name of {12} may not be used to endorse or promote products derived from this software without specific "
        "prior written permission",
    ],
    "apache-heading": ["Apache License"],
    "apache2-version": ["Version 2.0, January 2004"],
    "apache2-terms": ["TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"],
    "gpl-heading": ["GNU GENERAL PUBLIC LICENSE"],
    "lgpl-heading": ["GNU LESSER GENERAL PUBLIC LICENSE"],
    "agpl-heading": ["GNU AFFERO GENERAL PUBLIC LICENSE"],
    "gpl2-version": ["Version 2, June 1991"],
    "gpl3-version": ["Version 3, 29 June 2007"],
    "lgpl21-version": ["Version 2.1, February 1999"],
    "agpl3-version": ["Version 3, 19 November 2007"],
    "mpl2-heading": ["Mozilla Public License Version 2.0"],
    "ccby4-heading": ["Creative Commons Attribution 4.0 International Public License", "Attribution 4.0 International"],
    "cc0-heading": ["CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal"],
    "gpl3-notice": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 3",
        "Released under the GNU General Public License, version 3",
        "GNU General Public License, version 3",
    ],
    "gpl2-notice": [
        "This work is licensed under the GNU General Public License, version 2",
        "Licensed under the GNU General Public License, version 2",
        "GNU General Public License, version 2",
    ],
    "gpl-free": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version"
    ],
    "gpl3-only": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 3 as published by the Free Software Foundation",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, version 3",
    ],
    "gpl2-free": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
        "option) any later version",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; either version 2, or (at your option) any later "
        "version",
    ],
    "gpl2-only": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License version 2 as published by the Free Software Foundation",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation; version 2 of the License",
    ],
    "lgpl3-free": [
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version",
    ],
    "lgpl21-free": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version",
    ],
    "agpl3-free": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
        "your option) any later version",
    ],
    "gpl-warranty": [
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE",
    ],
    "mpl2-notice": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, version 2.0",
    ],
    "ccbync4-notice": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "ccby4-notice": [
        "Licensed under CC BY 4.0",
        "This work is licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "ccbysa4-notice": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    ],
    "cc0-notice": ["Released under CC0 1.0", "This work is dedicated to the public domain"],
    "unlicense-notice": ["This is free and unencumbered software released into the public domain"],
}

# How notices begin, and the names that they give to each license.
FORMS = (
    "Licensed under", "Released under", "Distributed under", "Published under", "Available under",
    "License", "Licence", "This {4} is licensed under", "This {4} is released under", "This {4} is distributed under",
    "This {4} is available under", "This {4} is made available under", "This {4} is published under",
    "This {4} is provided under", "This {4} is covered by", "This {4} is free software under",
    "The {4} is licensed under", "The {4} is released under", "{3} is licensed under", "{3} is released under",
    "{3} is distributed under", "{3} is available under", "All {4} is licensed under", "All {4} are licensed under",
)
NAMES = {
    "apache2": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0", "Apache 2.0 License", "Apache-2.0", "Apache-2.0 License", "Apache License, Version 2.0 (the \"License\")", "Apache License v2.0", "Apache v2"],
    "mit": ["MIT License", "MIT", "MIT License (MIT)", "Expat License", "MIT/Expat License"],
    "isc": ["ISC License", "ISC"],
    "bsd3": ["BSD 3-Clause License", "3-Clause BSD License", "BSD 3-Clause", "BSD-3-Clause", "BSD-3-Clause License", "New BSD License", "Modified BSD License", "BSD 3-Clause \"New\" or \"Revised\" License"],
    "bsd2": ["BSD 2-Clause License", "2-Clause BSD License", "BSD 2-Clause", "BSD-2-Clause", "BSD-2-Clause License", "Simplified BSD License", "FreeBSD License"],
    "gpl3": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU General Public License v3", "GNU General Public License version 3", "GNU GPL v3", "GNU GPLv3", "GPL v3", "GPLv3", "GPL-3.0", "GPL version 3", "GPL-3.0 License"],
    "gpl2": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU General Public License v2", "GNU General Public License version 2", "GNU GPL v2", "GNU GPLv2", "GPL v2", "GPLv2", "GPL-2.0", "GPL version 2", "GPL-2.0 License"],
    "gpl3plus": ["GNU General Public License, version 3 or later", "GNU General Public License v3.0 or later", "GPLv3+", "GPL v3 or later", "GPL-3.0-or-later", "GNU GPL v3 or later", "GPL version 3 or later"],
    "gpl2plus": ["GNU General Public License, version 2 or later", "GNU General Public License v2.0 or later", "GPLv2+", "GPL v2 or later", "GPL-2.0-or-later", "GNU GPL v2 or later", "GPL version 2 or later"],
    "lgpl3": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPL v3", "LGPLv3", "LGPL-3.0"],
    "lgpl21": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPL v2.1", "LGPLv2.1", "LGPL-2.1"],
    "agpl3": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPL v3", "AGPLv3", "AGPL-3.0"],
    "mpl2": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0", "MPL-2.0", "Mozilla Public License, v. 2.0"],
    "ccby4": ["CC BY 4.0", "CC-BY 4.0", "Creative Commons Attribution 4.0 International License", "Creative Commons Attribution 4.0 International", "Creative Commons Attribution 4.0 License", "Creative Commons BY 4.0", "CC BY 4.0 International"],
    "ccbysa4": ["CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License", "Creative Commons Attribution-ShareAlike 4.0 International", "Creative Commons Attribution-ShareAlike 4.0 License", "CC BY-SA 4.0 International"],
    "ccbync4": ["CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License", "Creative Commons Attribution-NonCommercial 4.0 International", "Creative Commons Attribution-NonCommercial 4.0 License", "CC BY-NC 4.0 International"],
    "cc0": ["CC0 1.0", "CC0", "CC0 1.0 Universal", "Creative Commons Zero", "Creative Commons CC0 1.0 Universal"],
    "unlicense": ["Unlicense"],
}
#: What may stand between a form and a name, and after the name.
ARTICLES = ("", "the", "a", "the terms of the", "the terms of", "the conditions of the")
TAILS = ("", "http {12}", "https {12}", "see {8}")
#: Identifiers of the licenses that notices name, by the keys of NAMES.
SPDX = {
    "apache2": "Apache-2.0", "mit": "MIT", "isc": "ISC", "bsd3": "BSD-3-Clause", "bsd2": "BSD-2-Clause",
    "gpl3": "GPL-3.0-only", "gpl2": "GPL-2.0-only", "gpl3plus": "GPL-3.0-or-later", "gpl2plus": "GPL-2.0-or-later",
    "lgpl3": "LGPL-3.0-only", "lgpl21": "LGPL-2.1-only", "agpl3": "AGPL-3.0-only", "mpl2": "MPL-2.0",
    "ccby4": "CC-BY-4.0", "ccbysa4": "CC-BY-SA-4.0", "ccbync4": "CC-BY-NC-4.0", "cc0": "CC0-1.0", "unlicense": "Unlicense",
}
#: Names that stand by themselves as the heading of a license or a notice.
HEADINGS = {
    "mit": ["MIT License", "The MIT License", "The MIT License (MIT)"],
    "isc": ["ISC License", "The ISC License"],
    "bsd3": ["BSD 3-Clause License", "The 3-Clause BSD License"],
    "bsd2": ["BSD 2-Clause License", "The 2-Clause BSD License"],
    "gpl3": ["GNU General Public License, version 3"],
    "gpl2": ["GNU General Public License, version 2"],
}



def spdx_lines() -> dict[str, list[str]]:
    """Per license the line that names it by its identifier, also in the older spelling."""
    out = {}
    for key, name in SPDX.items():
        spelt = {name, name.removesuffix("-only"), name.replace("-or-later", "+")}
        out[f"{key}-spdx"] = [f"SPDX-License-Identifier: {i}" for i in sorted(spelt)]
    return out


#: Sentences of texts, headings and identifiers; notices are put together from FORMS, ARTICLES, NAMES and TAILS.
SENTENCES = TEXTS | spdx_lines()
for _key, _lines in HEADINGS.items():
    SENTENCES[f"{_key}-notice"] = SENTENCES.get(f"{_key}-notice", []) + _lines

# Rules in the order in which they are tried; a longer sequence comes before its parts.
RULES = (
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-copy", "apache2-warranty")),
    ("Apache-2.0", ("apache2-notice", "apache2-comply", "apache2-copy")),
    ("Apache-2.0", ("apache2-notice", "apache2-comply")),
    ("Apache-2.0", ("apache2-notice",)),
    ("Apache-2.0", ("apache-heading", "apache2-version", "apache2-terms")),
    ("Apache-2.0", ("apache-heading", "apache2-version")),
    ("Apache-2.0", ("apache2-terms",)),
    ("Apache-2.0", ("apache2-comply", "apache2-copy", "apache2-warranty")),
    ("Apache-2.0", ("apache2-warranty",)),
    ("MIT", ("mit-notice", "mit-grant", "mit-include", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-include", "mit-warranty")),
    ("MIT", ("mit-grant", "mit-include")),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-notice",)),
    ("ISC", ("isc-notice", "isc-grant")),
    ("ISC", ("isc-grant",)),
    ("ISC", ("isc-notice",)),
    ("BSD-3-Clause", ("bsd3-notice", "bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd2-notice", "bsd-redistribute", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribute", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd3-notice",)),
    ("BSD-2-Clause", ("bsd2-notice",)),
    ("BSD-3-Clause", ("bsd-endorse",)),
    ("LGPL-3.0-only", ("lgpl-heading", "gpl3-version")),
    ("LGPL-2.1-only", ("lgpl-heading", "lgpl21-version")),
    ("AGPL-3.0-only", ("agpl-heading", "agpl3-version")),
    ("GPL-3.0-only", ("gpl-heading", "gpl3-version")),
    ("GPL-2.0-only", ("gpl-heading", "gpl2-version")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-warranty")),
    ("GPL-3.0-or-later", ("gpl-free",)),
    ("GPL-2.0-or-later", ("gpl2-free", "gpl-warranty")),
    ("GPL-2.0-or-later", ("gpl2-free",)),
    ("LGPL-3.0-or-later", ("lgpl3-free", "gpl-warranty")),
    ("LGPL-3.0-or-later", ("lgpl3-free",)),
    ("LGPL-2.1-or-later", ("lgpl21-free", "gpl-warranty")),
    ("LGPL-2.1-or-later", ("lgpl21-free",)),
    ("AGPL-3.0-or-later", ("agpl3-free", "gpl-warranty")),
    ("AGPL-3.0-or-later", ("agpl3-free",)),
    ("GPL-3.0-only", ("gpl3-only", "gpl-warranty")),
    ("GPL-3.0-only", ("gpl3-only",)),
    ("GPL-2.0-only", ("gpl2-only", "gpl-warranty")),
    ("GPL-2.0-only", ("gpl2-only",)),
    ("GPL-3.0-only", ("gpl3-notice",)),
    ("GPL-2.0-only", ("gpl2-notice",)),
    ("GPL-3.0-or-later", ("gpl3plus-notice",)),
    ("GPL-2.0-or-later", ("gpl2plus-notice",)),
    ("LGPL-3.0-only", ("lgpl3-notice",)),
    ("LGPL-2.1-only", ("lgpl21-notice",)),
    ("AGPL-3.0-only", ("agpl3-notice",)),
    ("MPL-2.0", ("mpl2-notice",)),
    ("MPL-2.0", ("mpl2-heading",)),
    ("CC-BY-4.0", ("ccby4-heading",)),
    ("CC0-1.0", ("cc0-heading",)),
    ("CC-BY-NC-4.0", ("ccbync4-notice",)),
    ("CC-BY-SA-4.0", ("ccbysa4-notice",)),
    ("CC-BY-4.0", ("ccby4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
    ("Unlicense", ("unlicense-notice",)),
    *((name, (f"{key}-spdx",)) for key, name in SPDX.items()),
)

_BREAK = re.compile(r"\n|(?<=[.!?:;])(?=\s)")
#: A plus sign at the end of a word belongs to it: "GPLv2+".
_WORD = re.compile(r"[^\W_]+(?:\+(?!\w))?")
_SLOT = re.compile(r"\{(\d+)\}")


def normalised(text: str) -> tuple[str, ...]:
    return tuple(_WORD.findall(text.lower()))


def parts_of(sentence: str) -> tuple[str | int, ...]:
    """The words of a sentence, and for each slot the number of words that it takes at most."""
    out: list[str | int] = []
    for i, part in enumerate(_SLOT.split(sentence)):
        out += [int(part)] if i % 2 else normalised(part)
    return tuple(out)


def anchors_of(sentences: Iterable[str]) -> tuple[str, ...] | None:
    """Words of which every sentence holds one, so that a text without any of them need not be cut up: the longest
    ASCII word of each, whose lower case does not depend on what stands beside it. None if a sentence has no such word.
    """
    chosen = set()
    for words in {tuple(p for p in parts_of(s) if isinstance(p, str)) for s in sentences}:
        plain = [w for w in words if w.isascii()]
        if words and not plain:
            return None
        chosen |= {max(plain, key=lambda w: (len(w), w))} if words else set()
    return tuple(sorted(w for w in chosen if not any(o in w for o in chosen - {w})))


class Trie:
    """Sentences by their words; a slot is a branch that takes one word to its number of words."""

    def __init__(self, sentences: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for name, sentence in sentences:
            node = self.root
            for part in parts_of(sentence):
                node = node.setdefault(part, {})
            if node is not self.root:
                node.setdefault(None, name)

    def ends(self, words: list[str], at: int, node: dict | None = None) -> Iterator[tuple[int, str]]:
        """(end, name) of all sentences that the words from ``at`` on begin with."""
        node = self.root if node is None else node
        if None in node:
            yield at, node[None]
        if at < len(words) and words[at] in node:
            yield from self.ends(words, at + 1, node[words[at]])
        for part, after in node.items():
            if isinstance(part, int):
                for n in range(1, min(part, len(words) - at) + 1):
                    yield from self.ends(words, at + n, after)


class Notices:
    """Sentences put together from a form, an article, the name of a license and what may follow it."""

    def __init__(self, forms=FORMS, articles=ARTICLES, names=None, tails=TAILS):
        self.forms = Trie(("", f) for f in forms)
        self.articles = Trie(("", a) for a in articles if a)
        self.names = Trie((f"{key}-notice", n) for key, listed in (names or NAMES).items() for n in listed)
        self.tails = Trie(("", t) for t in tails if t)

    def ends(self, words: list[str], at: int) -> Iterator[tuple[int, str]]:
        for begun, _ in self.forms.ends(words, at):
            for named in {begun, *(end for end, _ in self.articles.ends(words, begun))}:
                for end, name in self.names.ends(words, named):
                    yield end, name
                    for last, _ in self.tails.ends(words, end):
                        yield last, name


class Sentences:
    """The known sentences, of one's own or those of this module with its notices."""

    def __init__(self, sentences: dict[str, Iterable[str]] | None = None):
        table = {name: list(variants) for name, variants in (SENTENCES if sentences is None else sentences).items()}
        self.notices = Notices() if sentences is None else None
        worded = [v for variants in table.values() for v in variants]
        self.anchors = anchors_of(worded + list(FORMS if self.notices else ()))
        self.known = Trie((name, v) for name, variants in table.items() for v in variants)

    def _longest(self, words: list[str], at: int, ends: set[int]) -> tuple[int, str] | None:
        """The longest sentence that begins here and ends a fragment; of equally long ones the first by name."""
        found = [e for e in self.known.ends(words, at) if e[0] in ends]
        if self.notices:
            found += [e for e in self.notices.ends(words, at) if e[0] in ends]
        return min(found, key=lambda e: (-e[0], e[1]), default=None)

    def found(self, text: str) -> list[tuple[str, int, int]]:
        """(identifier, start, end) of known sentences in order, not overlapping; offsets are code points."""
        low = text.lower()
        if self.anchors is not None and not any(a in low for a in self.anchors):
            return []
        words, spans, begins, ends = [], [], set(), set()
        at = 0
        for mark in [*(m.start() for m in _BREAK.finditer(text)), len(text)]:
            begins.add(len(words))
            for m in _WORD.finditer(text, at, mark):
                words.append(m[0].lower())
                spans.append(m.span())
            ends.add(len(words))
            at = mark
        out, after = [], 0
        for i in sorted(begins):
            if after <= i < len(words):
                hit = self._longest(words, i, ends)
                if hit:
                    after = hit[0]
                    out.append((hit[1], spans[i][0], spans[after - 1][1]))
        return out


def matched(names: list[str], rules=RULES) -> tuple[list[tuple[str, int]], list[int]]:
    """Rules on a sequence of identifiers: (license, place of its first sentence), and places that no rule takes."""
    left, out = list(names), []
    for license_, sequence in rules:
        n, i = len(sequence), 0
        while i + n <= len(left):
            if tuple(left[i : i + n]) == sequence:
                out.append((license_, i))
                left[i : i + n] = [""] * n  # taken
                i += n
            else:
                i += 1
    return sorted(out, key=lambda x: x[1]), [i for i, x in enumerate(left) if x]


_RESULT = (
    "licenses array<string>, sentences array<struct<id:string,start:int,end:int>>, n_unmatched int"
)


def scan_licenses(
    docs: DataFrame, text: str = "text", doc_id: str = "doc_id", sentences: dict | None = None, rules=RULES
) -> DataFrame:
    """Per row: doc_id, licenses (distinct, in the order in which they first occur), sentences found (id, start, end)
    and the number of them that no rule took. Null and empty texts have none; null and repeated ids get a row each."""
    bound_batches(docs.sparkSession)
    known = Sentences(sentences)

    @F.pandas_udf(_RESULT)
    def scan(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for t in texts:
            found = known.found(t)
            licenses, rest = matched([f[0] for f in found], rules)
            spans = [{"id": n, "start": s, "end": e} for n, s, e in found]
            rows.append((list(dict.fromkeys(x[0] for x in licenses)), spans, len(rest)))
        return pd.DataFrame(rows, columns=["licenses", "sentences", "n_unmatched"])

    scanned = docs.select(F.col(doc_id).alias("doc_id"), scan.asNondeterministic()(text_of(text)).alias("r"))
    return scanned.select("doc_id", "r.*")


def digest(scanned: DataFrame) -> DataFrame:
    """The result columns of the registered query."""
    listed = F.transform("sentences", lambda s: F.concat_ws(":", s["id"], s["start"], s["end"]))
    return scanned.select(
        "doc_id",
        F.array_join("licenses", ",").alias("licenses"),
        F.array_join(listed, ",").alias("sentences"),
        F.col("n_unmatched").cast("long").alias("n_unmatched"),
    )
