"""License scans by a generalised suffix automaton of licence words.

The automaton accepts every run of words that occurs in a template or in a
base phrase.  A file's words are streamed through it; after each word the
state and the length of the longest suffix that is still such a run are known
(matching statistics).  Two things are read off:

* places of a base phrase: the phrase is a suffix of the present match, which
  a list kept with each state tells;
* places of a whole template, in the same way: a span of coverage 1;
* long matches: a match of ``MIN_MATCH`` words or more that the next word
  doesn't extend.  Per template, matches are chained when both positions go
  on and at most ``GAP`` words of the file lie between, none of which names
  another licence (``NAMING``); the chain that covers most template words gives
  a span with its coverage (covered words by template words).  It counts from
  ``MIN_COVER`` on, and for templates under ``SHORT`` words when all are covered.

Where spans overlap, the one that covers most words stays (then the one of the
larger coverage); the spans that stay give the labels.  Templates are customary
notices and the paragraphs of the licence texts of MIT, BSD, ISC and Unlicense;
the long texts of the other licences are known by their notices only.

The automaton's size is that of the templates, a parameter; files are scanned
by a narrow map with no state between rows.

Defined cases: null text is read as empty and has no words; words are compared
after lower-casing A-Z; a template or phrase without words is left out; ties
between spans go to the one that ends first, then to the smaller label; repeated rows and extra columns
pass through (columns named like the results are replaced).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickpipe.llm.common import read_table, workers_import

MIN_MATCH = 4
GAP = 6
MIN_COVER = 0.6
SHORT = 20
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Words that tell one licence from another.
NAMING = frozenset(b"nd nc sa noderivatives noderivs noncommercial sharealike lesser library affero lgpl agpl gpl mit bsd isc apache mozilla mpl eclipse epl cc0 zero unlicense".split())
# Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
# Customary licence notices, by label.
TEMPLATES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD license",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
        "software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
        "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
        "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
        "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
        "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
        "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"),
    "cc-by-nc": ("This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", "Licensed under CC BY-NC 4.0"),
    "cc-by-sa": ("This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0"),
    "cc-by-nc-nd": ("This work is licensed under a Creative Commons Attribution NonCommercial NoDerivatives 4.0 International License", "Licensed under CC BY-NC-ND 4.0"),
    "cc-by-nc-sa": ("This work is licensed under a Creative Commons Attribution NonCommercial ShareAlike 4.0 International License", "Licensed under CC BY-NC-SA 4.0"),
    "cc-by-nd": ("This work is licensed under a Creative Commons Attribution NoDerivatives 4.0 International License", "Licensed under CC BY-ND 4.0"),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "This work is dedicated to the public domain under CC0 1.0 Universal",
        "Creative Commons CC0 1.0 Universal Public Domain Dedication",
    ),
    "epl": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at "
        "https://www.eclipse.org/legal/epl-2.0",
        "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 "
        "which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
        "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\"). ANY USE, REPRODUCTION OR DISTRIBUTION OF "
        "THE PROGRAM CONSTITUTES RECIPIENT'S ACCEPTANCE OF THIS AGREEMENT.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
        "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
        "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "Released under the ISC License",
    ),
    "mit": (
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
        "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
        "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",),
    "unlicense": (
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
        "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software "
        "to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We "
        "intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
        "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE.",
    ),
}

# Notices that differ by name and version only.
_GNU = {"gpl": ("program", "GNU General Public License", ("2", "3")), "lgpl": ("library", "GNU Lesser General Public License", ("2.1", "3")),
        "agpl": ("program", "GNU Affero General Public License", ("3",))}
_CREATIVE = {"cc-by": "Attribution", "cc-by-nc": "Attribution NonCommercial", "cc-by-sa": "Attribution ShareAlike", "cc-by-nd": "Attribution NoDerivatives",
             "cc-by-nc-sa": "Attribution NonCommercial ShareAlike", "cc-by-nc-nd": "Attribution NonCommercial NoDerivatives"}
_TAGS = {"apache": ("Apache-2.0",), "bsd": ("BSD-2-Clause", "BSD-3-Clause"), "cc0": ("CC0-1.0",), "epl": ("EPL-1.0", "EPL-2.0"), "isc": ("ISC",), "mit": ("MIT",),
         "mpl": ("MPL-1.1", "MPL-2.0"), "unlicense": ("Unlicense",), "gpl": ("GPL-2.0", "GPL-3.0"), "lgpl": ("LGPL-2.1", "LGPL-3.0"), "agpl": ("AGPL-3.0",)}
_MORE: dict[str, list[str]] = {label: [f"SPDX-License-Identifier: {tag}" for tag in tags] for label, tags in _TAGS.items()}
for _label, (_what, _name, _versions) in _GNU.items():
    for _version in _versions:
        _MORE[_label].append(f"This {_what} is free software; you can redistribute it and/or modify it under the terms of the {_name} as published by the Free "
                             f"Software Foundation; either version {_version} of the License, or (at your option) any later version.")
    _MORE[_label].append(f"This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                         f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_name} for more details.")
for _label, _name in _CREATIVE.items():
    _MORE[_label] = [f"This work is licensed under a Creative Commons {_name} {v} License" for v in ("3.0 Unported", "4.0 International")]
# Openings and grants of the long licence texts.
_MORE["gpl"] += [
    "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "The licenses for most software are designed to take away your freedom to share and change it. By contrast, the GNU General Public License is intended "
    "to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
]
_MORE["apache"] += [
    "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, "
    "irrevocable copyright license to reproduce, prepare Derivative Works of, publicly display, publicly perform, sublicense, and distribute the Work and such "
    "Derivative Works in Source or Object form.",
    "Subject to the terms and conditions of this License, each Contributor hereby grants to You a perpetual, worldwide, non-exclusive, no-charge, royalty-free, "
    "irrevocable (except as stated in this section) patent license to make, have made, use, offer to sell, sell, import, and otherwise transfer the Work",
]
TEMPLATES = {label: (*TEMPLATES.get(label, ()), *_MORE.get(label, ())) for label in sorted({*TEMPLATES, *_MORE})}


def words(text: str | None) -> list[bytes]:
    return WORD.findall(text.encode("utf-8").lower()) if text else []


class Automaton:
    """Generalised suffix automaton over word numbers, with what each state tells."""

    def __init__(self, templates: Mapping[str, Sequence[str]], phrases: Mapping[str, str]):
        self.vocabulary: dict[bytes, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.names: list[tuple[str, int]] = []  # of templates: label, number of words
        ends: list[tuple[int, int, int]] = []  # state, template, end
        told: list[tuple[int, int, str]] = []  # state, length, label
        known = []
        for label in sorted(templates):
            for text in templates[label]:
                if run := words(text):
                    known.append((label, run))
        for label, run in known:
            self.names.append((label, len(run)))
            state = 0
            for at, w in enumerate(run):
                state = self._extend(state, self.vocabulary.setdefault(w, len(self.vocabulary)))
                ends.append((state, len(self.names) - 1, at))
        runs = [(words(p), label) for p, label in phrases.items() if words(p)]
        for run, _ in runs:
            state = 0
            for w in run:
                state = self._extend(state, self.vocabulary.setdefault(w, len(self.vocabulary)))
        for run, label in runs:  # the automaton is complete now, states stay
            state = 0
            for w in run:
                state = self.step[state][self.vocabulary[w]]
            told.append((state, len(run), label))
        n = len(self.step)
        own_ends: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        own_told: list[list[tuple[int, str]]] = [[] for _ in range(n)]
        own_whole: list[list[int]] = [[] for _ in range(n)]
        for s, t, at in ends:
            own_ends[s].append((t, at))
        for s, k, label in told:
            own_told[s].append((k, label))
        for t, (_, run) in enumerate(known):
            state = 0
            for w in run:
                state = self.step[state][self.vocabulary[w]]
            own_whole[state].append(t)
        order = sorted(range(n), key=lambda s: self.length[s])
        for s in order[1:]:  # a state's strings end with those of its link
            own_told[s] = own_told[s] + own_told[self.link[s]]
            own_whole[s] = own_whole[s] + own_whole[self.link[s]]
        for s in reversed(order[1:]):  # and occur where longer ones do
            own_ends[self.link[s]].extend(own_ends[s])
        self.ends = [sorted(set(x)) for x in own_ends]
        self.told = [tuple(x) for x in own_told]
        self.whole = [tuple(x) for x in own_whole]

    def _extend(self, last: int, w: int) -> int:
        if w in self.step[last]:
            q = self.step[last][w]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, w, q)
        cur = self._new(self.length[last] + 1, {})
        p = last
        while p >= 0 and w not in self.step[p]:
            self.step[p][w] = cur
            p = self.link[p]
        if p >= 0:
            q = self.step[p][w]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._clone(p, w, q)
        else:
            self.link[cur] = 0
        return cur

    def _new(self, length: int, step: dict[int, int]) -> int:
        self.step.append(step)
        self.link.append(0)
        self.length.append(length)
        return len(self.step) - 1

    def _clone(self, p: int, w: int, q: int) -> int:
        c = self._new(self.length[p] + 1, dict(self.step[q]))
        self.link[c], self.link[q] = self.link[q], c
        while p >= 0 and self.step[p].get(w) == q:
            self.step[p][w] = c
            p = self.link[p]
        return c

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int]], list[tuple[str, int, int, int, float]]]:
        """Number of words; places of base phrases; covered template spans."""
        found = words(text)
        places: list[tuple[str, int]] = []
        matches: list[tuple[int, int, int]] = []  # start, end, state
        complete: list[tuple[int, int, int]] = []  # template, start, end
        step, link, length, told, whole = self.step, self.link, self.length, self.told, self.whole
        state = size = 0
        last = -2
        ids = list(map(self.vocabulary.get, found))
        for i, w in [(i, w) for i, w in enumerate(ids) if w is not None]:
            if i != last + 1:  # a word that no template has lies between
                if size >= MIN_MATCH:
                    matches.append((last + 1 - size, last, state))
                state = size = 0
            last = i
            if w not in step[state]:
                if size >= MIN_MATCH:
                    matches.append((i - size, i - 1, state))
                while state and w not in step[state]:
                    state = link[state]
                size = length[state]
            if w in step[state]:
                state, size = step[state][w], size + 1
                for k, label in told[state]:
                    if k <= size:
                        places.append((label, i + 1 - k))
                for t in whole[state]:
                    if (k := self.names[t][1]) <= size:
                        complete.append((t, i + 1 - k, i))
            else:
                state = size = 0
        if size >= MIN_MATCH:
            matches.append((last + 1 - size, last, state))
        return len(found), places, self._chains(matches, complete, [i for i, w in enumerate(found) if w in NAMING] if matches else [])

    def _chains(self, matches: list[tuple[int, int, int]], complete: list[tuple[int, int, int]], naming: list[int]) -> list[tuple[str, int, int, int, float]]:
        """The best of the complete templates and of the chains, from ``MIN_COVER`` on, where spans overlap.

        ``naming``: positions of the file's words that name a licence."""
        per: dict[int, list[tuple[int, int, int, int]]] = {}
        for start, end, state in matches:
            for t, at in self.ends[state]:
                per.setdefault(t, []).append((start, end, at - (end - start), at))
        done = [(-self.names[t][1], -1.0, end, start, self.names[t][0]) for t, start, end in complete]
        for t, own in sorted(per.items()):
            label, n = self.names[t]
            own.sort()
            best: list[tuple[int, int]] = []  # covered words, first word, of the best chain that ends in a match
            low = 0
            for k, (start, end, t0, t1) in enumerate(own):
                while own[low][1] < start - GAP - n:
                    low += 1
                score, first = t1 - t0 + 1, start
                for j in range(low, k):
                    s2, e2, u0, u1 = own[j]
                    if s2 < start and e2 < end and u0 < t0 and u1 < t1 and start - e2 <= GAP + 1 and bisect_right(naming, e2) == bisect_left(naming, start):
                        # runs may overlap by a few words, in the file or in the template
                        gain = t1 - t0 + 1 - max(0, e2 - start + 1, u1 - t0 + 1)
                        if gain > 0 and best[j][0] + gain > score:
                            score, first = best[j][0] + gain, best[j][1]
                best.append((score, first))
                if score >= (n if n < SHORT else MIN_COVER * n):
                    done.append((-score, -score / n, end, first, label))
        spans, taken = [], []  # taken: sorted and disjoint
        for covered, share, end, first, label in sorted(done):
            at = bisect_left(taken, (first,))
            if (not at or taken[at - 1][1] < first) and (at == len(taken) or taken[at][0] > end):
                taken.insert(at, (first, end))
                spans.append((label, first, end, -covered, -share))
        return sorted(spans, key=lambda x: (x[1], x[2], x[0]))


PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("start", T.LongType())])
SPAN = T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
                     T.StructField("covered", T.LongType()), T.StructField("coverage", T.DoubleType())])


def scan(df: DataFrame, automaton: Automaton, text: str = "text") -> DataFrame:
    """Replaces the text by ``n_words``, ``places`` (label and first word of each
    base phrase) and ``spans`` (label, first and last word, covered words, coverage)."""
    workers_import(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(automaton)
    new = {"n_words": T.LongType(), "places": T.ArrayType(PLACE), "spans": T.ArrayType(SPAN)}
    rest = [c for c in df.columns if c not in (text, *new)]
    schema = T.StructType([df.schema[c] for c in rest] + [T.StructField(k, v) for k, v in new.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        span = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64())]))
        for batch in batches:
            rows = [shared.value.scan(x.as_py()) for x in batch.column(text)]
            made = [pa.array([r[0] for r in rows], pa.int64()),
                    pa.array([[dict(zip(("label", "start"), x, strict=True)) for x in r[1]] for r in rows], place),
                    pa.array([[dict(zip(SPAN.names, x, strict=True)) for x in r[2]] for r in rows], span)]
            yield pa.RecordBatch.from_arrays([*map(batch.column, rest), *made], names=[*rest, *new])

    return df.mapInArrow(run, schema)


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    """Base phrases, labels and the best template coverage of every whole text."""
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    found = scan(docs, Automaton(TEMPLATES, PHRASES))
    starts = F.transform("places", lambda x: x["start"])
    base = F.transform("places", lambda x: x["label"])
    labels = F.concat(base, F.transform("spans", lambda x: x["label"]))
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    score = F.greatest(F.coalesce(F.array_max(F.transform("spans", lambda x: x["coverage"])), F.lit(0.0)),
                       F.when(F.size("places") > 0, 0.5).otherwise(0.0))
    return found.select("doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
                        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                        joined(base).alias("base_labels"), joined(labels).alias("labels"), F.least(score, F.lit(1.0)).alias("score"))
