"""Licence scans by sentence rules.

A known licence sentence has an identifier.  A document's sentences are looked
up after normalisation (case and punctuation folded by Unicode, line breaks inside
a sentence ignored), which turns it into a sequence of identifiers; rules are
ordered sequences of identifiers, and the longest rule that matches at a place
wins, so a notice cut into sentences is recognised as a whole and its parts are
not reported again.

Sentences begin at the text's begin, after a line break, or after one of
``. ! ? ; :`` and white space, and end likewise; a known sentence may run across
line breaks.  Of known sentences that begin at one place the longest counts.
Neighbours in a rule have at most ``gap`` other words between them; sentences farther
apart are notices, or parts of one, of their own.

Known are the sentences of SENTENCES and the short statements made of NAMES.  Parts
of an ordered rule count as well, if the whole is not there: a run of its sentences
is the licence that alone has it, or the family (GPL, LGPL, GNU, BSD) of those that do.

A tag ``SPDX-License-Identifier`` gives a row of rule ``spdx`` for each licence of the
expression after it, with its exception; known are all identifiers of the SPDX list,
a ``+`` after them and ``LicenseRef-`` names.  Other words after a tag give no row.

Defined results: null and empty texts match nothing; every match is a row,
repeated documents have their own; a null doc_id stays null.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import map_arrow, slices
from daybook.llm.spdx import EXCEPTIONS, LICENCES
from daybook.llm.words import FOLD, folded, rolling, split_words, text_buffer

#: Sentences of well-known licence notices, by identifier.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-project": "This project is licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-short-title": "MIT License",
    "mit-permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                      "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
                      "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
                      "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
                  "the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
                 "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
                     "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
                     "OR OTHER DEALINGS IN THE SOFTWARE.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-the-license": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-may-not": "you may not use this file except in compliance with the License.",
    "apache-obtain": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-unless": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
                     "on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
                "version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gpl-without": "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-details": "See the GNU General Public License for more details.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                          "the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
                  "disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
                  "disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
                   "products derived from this software without specific prior written permission.",
    "ccby-work": "This work is licensed under CC BY 4.0.",
    "ccby-licensed": "Licensed under CC BY 4.0.",
    "ccbysa-licensed": "Licensed under CC BY-SA 4.0.",
    "ccbync-licensed": "Licensed under CC BY-NC 4.0.",
    "ccbync-work": "This work is licensed under CC BY-NC 4.0.",
    "cc0-work": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "isc-title": "ISC License",
    "isc-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                      "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-permission-and": "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby "
                          "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
                 "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "isc-liability": "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
                     "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER "
                     "TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    "0bsd-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
                       "granted.",
    "mpl2-subject": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "mpl2-copy": "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "mpl2-copy-https": "If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "mpl11-subject": "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not use "
                     "this file except in compliance with the License.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "unlicense-anyone": "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code "
                        "form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "epl2-available": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
                      "which is available at https://www.eclipse.org/legal/epl-2.0/",
    "epl1-available": "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
                      "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    "boost-distributed": "Distributed under the Boost Software License, Version 1.0.",
    "apache-obtain-https": "You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0",
    "lgpl-details": "See the GNU Lesser General Public License for more details.",
    "lgpl2-details": "See the GNU Library General Public License for more details.",
    "agpl-details": "See the GNU Affero General Public License for more details.",
    "reserved": "All rights reserved.",
}

#: Ordered rules, as (licence, identifiers in order).
RULES = [
    ("MIT", ["mit-title", "mit-permission", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-short-title", "mit-permission", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-permission", "mit-notice", "mit-as-is", "mit-liability"]),
    ("MIT", ["mit-permission", "mit-notice", "mit-as-is"]),
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-project"]),
    ("Apache-2.0", ["apache-the-license", "apache-may-not", "apache-obtain", "apache-unless", "apache-see"]),
    ("Apache-2.0", ["apache-the-license", "apache-may-not", "apache-unless"]),
    ("Apache-2.0", ["apache-licensed"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope", "gpl-without", "gpl-details"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-3.0-only", ["gpl3-work"]),
    ("GPL-3.0-only", ["gpl3-licensed"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary", "bsd-endorse"]),
    ("BSD-2-Clause", ["bsd-redistribution", "bsd-source", "bsd-binary"]),
    ("CC-BY-4.0", ["ccby-work"]),
    ("CC-BY-4.0", ["ccby-licensed"]),
    ("CC-BY-SA-4.0", ["ccbysa-licensed"]),
    ("CC-BY-NC-4.0", ["ccbync-licensed"]),
    ("CC-BY-NC-4.0", ["ccbync-work"]),
    ("CC0-1.0", ["cc0-work"]),
    ("Apache-2.0", ["apache-the-license", "apache-may-not", "apache-obtain-https", "apache-unless", "apache-see"]),
    ("ISC", ["isc-title", "isc-permission", "isc-as-is", "isc-liability"]),
    ("ISC", ["isc-title", "isc-permission-and", "isc-as-is", "isc-liability"]),
    ("0BSD", ["0bsd-permission", "isc-as-is", "isc-liability"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-copy"]),
    ("MPL-2.0", ["mpl2-subject", "mpl2-copy-https"]),
    ("MPL-1.1", ["mpl11-subject"]),
    ("Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("EPL-2.0", ["epl2-available"]),
    ("EPL-1.0", ["epl1-available"]),
    ("BSL-1.0", ["boost-distributed"]),
    ("all-rights-reserved", ["reserved"]),
]

#: Names of licences in short statements ("Licensed under the ...").
NAMES = {
    "MIT": ["MIT License", "MIT Licence", "MIT"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache 2.0", "Apache-2.0"],
    "GPL-2.0-only": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2", "GPL v2", "GPL-2.0"],
    "GPL-3.0-only": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3", "GPL v3", "GPL-3.0"],
    "LGPL-2.1-only": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1", "LGPLv2.1", "LGPL-2.1"],
    "LGPL-3.0-only": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0", "LGPLv3", "LGPL-3.0"],
    "AGPL-3.0-only": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0", "AGPLv3", "AGPL-3.0"],
    "MPL-2.0": ["Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "Mozilla Public License, v. 2.0", "MPL 2.0"],
    "ISC": ["ISC License"],
    "Unlicense": ["Unlicense"],
    "EPL-2.0": ["Eclipse Public License 2.0", "Eclipse Public License, version 2.0", "Eclipse Public License v2.0", "EPL 2.0"],
    "EPL-1.0": ["Eclipse Public License 1.0", "Eclipse Public License, version 1.0", "Eclipse Public License v1.0", "EPL 1.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"],
    "BSL-1.0": ["Boost Software License 1.0", "Boost Software License, Version 1.0"],
    "CC0-1.0": ["CC0 1.0", "CC0", "CC0 1.0 Universal"],
}
_CC = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives",
       "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
NAMES |= {f"CC-{k}-{v}": [f"CC {k} {v}", f"CC-{k}-{v}", f"Creative Commons {name} {v}{kind} License"] + [f"Creative Commons {name} {v}{kind}"]
          for k, name in _CC.items() for v, kind in (("2.0", ""), ("2.5", ""), ("3.0", " Unported"), ("4.0", " International"))}
_SAID = [f"{begin} under {article}" for article in ("", "the ", "a ")
         for begin in ("Licensed", "Released", "Distributed", "Available", *(f"This {x} is {verb}" for x in (
             "work", "project", "software", "program", "library", "file", "code") for verb in ("licensed", "released", "distributed")))]
for _licence, _names in NAMES.items():
    for _name in _names:
        for _said in _SAID:
            SENTENCES[_key := f"{_said} {_name}".lower().replace(" ", "-").replace("--", "-")] = f"{_said}{_name}."
            RULES.append((_licence, [_key]))

# The GNU notices: of a kind, a version and what the notice is about.
for _thing in ("program", "library", "file", "software"):
    SENTENCES.setdefault(_hope := "gpl-hope" if _thing == "program" else f"gpl-hope-{_thing}",
                         f"This {_thing} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;")
    for _kind, _name, _version, _details in (
            ("GPL", "General", "2", "gpl"), ("GPL", "General", "3", "gpl"), ("LGPL", "Library General", "2", "lgpl2"),
            ("LGPL", "Lesser General", "2.1", "lgpl"), ("LGPL", "Lesser General", "3", "lgpl"), ("AGPL", "Affero General", "3", "agpl")):
        _key = f"{_kind}{_version}-free-{_thing}".lower()
        _id = f"{_kind}-{_version}" + ("" if "." in _version else ".0")
        _free = f"This {_thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {_name} Public License"
        _later = f"{_free} as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any " \
                 "later version."
        if _key == "gpl3-free-program":
            _key = "gpl-free"
        for _rule, _licence, _text in ((_key, f"{_id}-or-later", _later),
                                       (f"{_key}-only", f"{_id}-only", f"{_free} version {_version} as published by the Free Software Foundation."),
                                       (f"{_key}-only-after", f"{_id}-only", f"{_free} as published by the Free Software Foundation; version "
                                        f"{_version} of the License.")):
            SENTENCES.setdefault(_rule, _text)
            RULES += [(_licence, [_rule, _hope, "gpl-without", f"{_details}-details"]), (_licence, [_rule])]


def _family(names: set[str]) -> str:
    """One name for licences that share sentences."""
    kinds = {n.split("-")[0] for n in names}
    if len(names) == 1 or len(kinds) == 1:
        return min(names) if len(names) == 1 else min(kinds)
    return "GNU" if kinds <= {"GPL", "LGPL", "AGPL"} else " OR ".join(sorted(names))


def with_parts(rules: list[tuple[str, list[str]]]) -> list[tuple[str, list[str]]]:
    """The rules, and for each run of sentences inside them that is no rule one of its own."""
    whole = {tuple(order) for _, order in rules}
    parts: dict[tuple[str, ...], set[str]] = {}
    for licence, order in rules:
        for i in range(len(order)):
            for j in range(i + 1, len(order) + 1):
                parts.setdefault(tuple(order[i:j]), set()).add(licence)
    return rules + [(_family(names), list(run)) for run, names in parts.items() if run not in whole]


_TAG = re.compile(rb"\bSPDX[\W_]{1,3}License[\W_]{1,3}Identifier[\"']?\s*[:=]?[\s\"'`]*", re.I)
_TERM = re.compile(rb"[ \t(]*([A-Za-z0-9][A-Za-z0-9.+-]*)")
_JOIN = re.compile(rb"[ \t)]*\s(AND|OR|WITH)\s+", re.I)
_KNOWN = {x.lower(): x for x in LICENCES}
_EXCEPT = {x.lower(): x for x in EXCEPTIONS}


def _identifier(word: str) -> str | None:
    low = word.lower()
    if low.startswith(("licenseref-", "documentref-")):
        return word
    return _KNOWN.get(low) or (_KNOWN[low[:-1]] + "+" if low.endswith("+") and low[:-1] in _KNOWN else None)


def spdx_tags(text: bytes) -> Iterator[tuple[str, int, int]]:
    """(licence, begin, end) of each licence in the SPDX expressions of a text, in bytes."""
    for tag in _TAG.finditer(text):
        got, end, at, op = [], 0, tag.end(), None
        while m := _TERM.match(text, at):
            word = m[1].decode().rstrip(".-")
            name = _EXCEPT.get(word.lower()) if op == b"WITH" else _identifier(word)
            if name is None:
                break
            if op == b"WITH":
                got[-1] += f" WITH {name}"
            else:
                got.append(name)
            end = m.start(1) + len(word)
            if not (j := _JOIN.match(text, end)):
                break
            op, at = j[1].upper(), j.end()
        yield from ((name, tag.start(), end) for name in dict.fromkeys(got))


_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?;:"]] = True
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


class Scanner:
    """The sentences by length and hash; the rules by their first identifier."""

    def __init__(self, sentences: dict[str, str], rules: list[tuple[str, list[str]]]):
        self.names = list(sentences)
        self.by_length: dict[int, dict[int, int]] = {}
        number: dict[str, int] = {}
        w = split_words(folded(pa.array(list(sentences.values()), pa.string())), FOLD)
        every = w.hashes()
        for i in range(len(self.names)):
            h = every[w.ptr[i]:w.ptr[i + 1]]
            if not len(h):
                continue
            same = self.by_length.setdefault(len(h), {}).setdefault(int(rolling(h, len(h))[0]), i)
            number[self.names[i]] = same  # sentences that fold alike are one
        self.rules: dict[int, list[tuple[list[int], str]]] = {}
        for licence, order in sorted(with_parts(rules), key=lambda r: -len(r[1])):
            ids = [number[s] for s in order]
            self.rules.setdefault(ids[0], []).append((ids, licence))

    def sentences(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """For each text, (first word, words, identifier) of its known sentences in order."""
        texts = folded(texts)
        w = split_words(texts, FOLD)
        h, doc = w.hashes(), w.doc()
        out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        if not len(h):
            return out
        raw, off = text_buffer(texts)
        nxt = np.append(raw[1:], np.uint8(0x20))
        ends = off[1:-1][off[1:-1] > 0] - 1
        stop = (raw == 10) | (_STOP[raw] & _BLANK[nxt])
        stop[ends] |= _STOP[raw[ends]]
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(stop)])
        # a sentence may end after word i and begin at word i + 1
        cut = np.ones(len(h) + 1, bool)
        cut[1:-1] = (total[w.start[1:]] > total[w.end[:-1]]) | (doc[1:] != doc[:-1])
        free = np.full(len(h), -1)
        for n in sorted(self.by_length, reverse=True):
            if n > len(h):
                continue
            at = np.flatnonzero(cut[:len(h) - n + 1] & cut[n:] & (doc[:len(h) - n + 1] == doc[n - 1:]))
            run = rolling(h, n)[at]
            known = self.by_length[n]
            hit = np.flatnonzero(np.isin(run, np.array(list(known), np.uint64)))
            for x in hit.tolist():
                if free[at[x]] < 0:
                    free[at[x]] = n
                    d = int(doc[at[x]])
                    out[d].append((int(at[x] - w.ptr[d]), n, known[int(run[x])]))
        for own in out:
            own.sort()
        return out

    def match(self, found: list[tuple[int, int, int]], gap: int = 200) -> Iterator[tuple[str, str, int, int, int]]:
        """(licence, rule, sentences, first word, end) over a sequence of sentences."""
        ids, i = [f[2] for f in found], 0
        # the sentence after which the next one is too far away, from each sentence on
        until = list(range(1, len(found) + 1))
        for x in range(len(found) - 2, -1, -1):
            if found[x + 1][0] - found[x][0] - found[x][1] <= gap:
                until[x] = until[x + 1]
        while i < len(found):
            for order, licence in self.rules.get(ids[i], []):
                if i + len(order) <= until[i] and ids[i:i + len(order)] == order:
                    last = found[i + len(order) - 1]
                    yield licence, " ".join(self.names[s] for s in order), len(order), found[i][0], last[0] + last[1]
                    i += len(order)
                    break
            else:
                i += 1


def tags(texts: pa.Array) -> Iterator[tuple[int, str, str, int, int, int]]:
    """(text, licence, "spdx", 1, first word, end) of each licence in an SPDX expression."""
    texts = folded(texts)
    near = np.flatnonzero(pc.match_substring(texts, "spdx", ignore_case=True).to_numpy(zero_copy_only=False))
    for i in near.tolist():
        one = texts.slice(i, 1)
        w = split_words(one, FOLD)
        for licence, begin, end in spdx_tags(text_buffer(one)[0].tobytes()):
            yield i, licence, "spdx", 1, int(np.searchsorted(w.start, begin)), int(np.searchsorted(w.start, end))


def licences(docs: DataFrame, sentences: dict[str, str] | DataFrame | None = None,
             rules: list[tuple[str, list[str]]] | DataFrame | None = None, gap: int = 200) -> DataFrame:
    """(doc_id, licence, rule, n_sentences, first_word, end_word) of every match;
    words are counted with case and punctuation folded.  The tables may be
    DataFrames: (identifier, sentence) and (licence, array of identifiers)."""
    if isinstance(sentences, DataFrame):
        sentences = {r[0]: r[1] for r in sentences.collect()}
    if isinstance(rules, DataFrame):
        rules = [(r[0], list(r[1])) for r in rules.collect()]
    tables = (SENTENCES if sentences is None else sentences, RULES if rules is None else rules)

    scanner = Scanner(*tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            got = [(i, *m) for i, found in enumerate(scanner.sentences(b.column("text"))) for m in scanner.match(found, gap)]
            got += tags(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array([g[0] for g in got], pa.int64())), pa.array([g[1] for g in got], pa.string()),
                 pa.array([g[2] for g in got], pa.string()), *(pa.array([g[k] for g in got], pa.int32()) for k in (3, 4, 5))],
                ["doc_id", "licence", "rule", "n_sentences", "first_word", "end_word"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_arrow(rows, run, "doc_id long, licence string, rule string, n_sentences int, first_word int, end_word int")
