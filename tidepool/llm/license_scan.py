"""License scans by patience alignment.

A license text is a template of words. Text and template are aligned the way
patience diff does: words that occur once in both are anchors, the longest
increasing subsequence of the anchors stands, and the gaps between them are
aligned again in the same way; where a gap has no such words, its longest common
subsequence is taken, so a copy whose words are all there in order has coverage 1. The share of the template's words that are aligned is its coverage.

Only texts that could reach the threshold are aligned: coverage can't exceed
the share of the template's words that the text has at all. Of a text only the
words that the template has are aligned; foreign words between them, however
many, leave the coverage as it is. Where they are further apart than twice the
template's length a new region begins. A region is cut where a second copy
begins, that is where unique phrases of the template go back to an earlier
one. As a phrase of the template may also stand inside a copy, a copy is any number of
neighbouring parts, aligned whole; of all ways to cut a region into copies
that with most aligned words is taken. The work for a region grows with its
copies; only a region of thousands of parts without a whole copy takes the square.

Names and numbers that tell licenses apart (gnu, lesser, nd, 4.0) must follow
their words as in the template, without a foreign word between.

Defined results: null and empty texts match nothing; every license and place of
a text is given, of those that overlap the one with most aligned words; the
license of a text is that with the largest coverage, of those the longest, then
the first by name; repeated rows each get their row; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import words as W
from tidepool.llm.common import query, read

THRESHOLD = 0.8

# Public license notices, standard headers and short licenses, word for word. Others come in a table.
TEMPLATES: dict[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance"
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on an"
        " \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    "BSD": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that"
            " the following conditions are met"),
    "CC-BY-4.0": "Licensed under CC BY 4.0",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3",
    "ISC": ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby"
            " granted, provided that the above copyright notice and this permission notice appear in all copies"),
    "MIT": "Released under the MIT License",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        " documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation"
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
        " to permit persons to whom the Software is furnished to do so"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_AS_IS = (" THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING,"
          " BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT"
          " SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL"
          " DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS"
          " INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE"
          " OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD_2 = (TEMPLATES["BSD"] + ": Redistributions of source code must retain the above copyright notice, this list of conditions and the following"
          " disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following"
          " disclaimer in the documentation and/or other materials provided with the distribution.")
_GNU = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU {0} as published by the Free"
        " Software Foundation, either version {1} of the License, or (at your option) any later version. This program is distributed in the"
        " hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A"
        " PARTICULAR PURPOSE. See the GNU {0} for more details. You should have received a copy of the GNU {0} along with this program")
_GNU_KINDS = {"GPL-2.0": ("General Public License", "2"), "GPL-3.0": ("General Public License", "3"),
              "LGPL-2.1": ("Lesser General Public License", "2.1"), "LGPL-3.0": ("Lesser General Public License", "3"),
              "AGPL-3.0": ("Affero General Public License", "3")}
TEMPLATES |= {
    "BSD-2-Clause": _BSD_2 + _AS_IS,
    "BSD-3-Clause": _BSD_2 + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
                             " products derived from this software without specific prior written permission." + _AS_IS,
    "CC-BY-NC-ND-4.0": "Licensed under CC BY-NC-ND 4.0",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0",
    "ISC-whole": TEMPLATES["ISC"] + (
        ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED"
        " WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR"
        " CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
        " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    "MIT-whole": TEMPLATES["MIT-text"] + (
        ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or"
        " substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING"
        " BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE"
        " AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
        " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile,"
        " sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or"
        " non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate"
        " any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at"
        " large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in"
        " perpetuity of all present and future rights to this software under copyright law."),
    **{f"{n}-header": _GNU.format(*x) for n, x in _GNU_KINDS.items()},
    **{n: "This work is licensed under the GNU {}, version {}".format(*x) for n, x in _GNU_KINDS.items()},
}

#: Words that must be followed, and must follow, as in the template: they tell licenses apart.
DECIDING = frozenset(b"gnu lesser affero cc nc nd sa mit mozilla apache".split())
DECIDING_END = frozenset(b"lesser affero general nc nd sa mit mozilla apache".split())

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def word_list(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def increasing(values: list[int]) -> list[int]:
    """Places of a longest increasing subsequence, by patience sorting: each value goes on the first
    pile whose top is not smaller; links to the pile before lead back from the last pile."""
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        pile = bisect.bisect_left(tops, v)
        back.append(at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def common(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a longest common subsequence. Row i of the table is a number whose bit j is 0 where
    the length for i + 1 words of ``a`` rises at word j of ``b`` (bit-parallel, Hyyro 2004)."""
    places: dict = {}
    for j, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << j
    ones = row = (1 << len(b)) - 1
    rows = []
    for w in a:
        met = row & places.get(w, 0)
        row = ((row + met) | (row - met)) & ones
        rows.append(row)
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            out.append((i, j))
            i, j = i - 1, j - 1
    return out[::-1]


def align(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of ``a`` and ``b``, rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: i for i, w in enumerate(b[b0:b1], b0) if in_b[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if in_a[w] == 1 and w in place]
        if not pairs:
            out += [(a0 + i, b0 + j) for i, j in common(a[a0:a1], b[b0:b1])]
            continue
        anchors = [pairs[i] for i in increasing([j for _, j in pairs])]
        out += anchors
        edges = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1]
    return sorted(out)


def copies(words: list, template: list, threshold: float, valid=lambda pairs: True) -> list[tuple[float, int, int]]:
    """Coverage and range of the aligned words of every copy of ``template`` in ``words``, in order, that ``valid`` accepts."""
    known, k = set(template), 2 if len(template) < 12 else 3
    at = [i for i, w in enumerate(words) if w in known]
    shingles = lambda x: list(zip(*(x[i:] for i in range(k))))
    counts = Counter(shingles(template))
    rank = {x: i for i, x in enumerate(shingles(template)) if counts[x] == 1}
    out: list[tuple[float, int, int]] = []
    edges = [0, *(i for i in range(1, len(at)) if at[i] - at[i - 1] > 2 * len(template) + 1), len(at)]
    for begin, end in zip(edges, edges[1:]):
        if end - begin < threshold * len(template):
            continue
        region = [words[i] for i in at[begin:end]]
        cuts, last = [0], (-1, 0)
        for i, x in enumerate(shingles(region)):
            if (r := rank.get(x)) is not None:
                if r <= last[0]:
                    # The copy may have begun before the first of its words that is an anchor.
                    first, j = i, r
                    while j and first > last[1] + 1 and region[first - 1] == template[j - 1]:
                        first, j = first - 1, j - 1
                    cuts.append(first)
                last = (r, i)
        cuts.append(len(region))
        out += best_parts(region, cuts, template, threshold, valid, at[begin:end])
    return out


def best_parts(region: list, cuts: list[int], template: list, threshold: float, valid, at: list[int]) -> list[tuple[float, int, int]]:
    """The copies that have most aligned words in all, each of any number of neighbouring parts of ``region``.

    A phrase of the template inside a copy is a cut too, so a copy may have many parts. From
    the last part on, ``best[i]`` is the most that the parts from i on can give; a copy
    that begins with part i is made longer only while it could still beat what is found.
    """
    least, size = threshold * len(template), len(template)
    enough = reach(region, cuts, template, least)
    n = len(cuts) - 1
    best, chosen = [0] * (n + 1), [None] * n
    for i in reversed(range(n)):
        best[i] = best[i + 1]
        for j in range(enough[i], n + 1):
            if size + best[j] <= best[i]:
                break
            pairs = [(at[cuts[i] + x], y) for x, y in align(region[cuts[i]:cuts[j]], template)]
            if len(pairs) >= least and len(pairs) + best[j] > best[i] and valid(pairs):
                best[i], chosen[i] = len(pairs) + best[j], (j, (len(pairs) / size, pairs[0][0], pairs[-1][0] + 1))
    out, i = [], 0
    while i < n:
        if chosen[i] is None:
            i += 1
        else:
            i, copy = chosen[i]
            out.append(copy)
    return out


def reach(region: list, cuts: list[int], template: list, least: float) -> list[int]:
    """For each part, the first cut up to which the words, in any order, hold ``least`` words of the template
    (one past the last cut if there is none)."""
    need, have, held = Counter(template), Counter(), 0
    out, j, n = [], 0, len(cuts) - 1
    for i in range(n):
        while held < least and j < n:
            for w in region[cuts[j]:cuts[j + 1]]:
                have[w] += 1
                held += have[w] <= need[w]
            j += 1
        out.append(max(j, i + 1) if held >= least else n + 1)
        for w in region[cuts[i]:cuts[i + 1]] if j > i else ():
            held -= have[w] <= need[w]
            have[w] -= 1
    return out


def decided(template: list[bytes]):
    """Whether pairs of a text and ``template`` have the words that tell licenses apart: a name or number
    follows its word in the text as it does in the template, and the first of each are there."""
    pairs_of = [j for j in range(len(template) - 1) if template[j + 1].isdigit() or template[j] in DECIDING or template[j + 1] in DECIDING_END]
    first = {template[j + 1]: j for j in reversed(pairs_of)}
    must = set(first.values())

    def check(pairs: list[tuple[int, int]]) -> bool:
        place = {j: i for i, j in pairs}
        return all(place[j + 1] == place[j] + 1 if j in place and j + 1 in place else j not in must for j in pairs_of)

    return check


def all_matches(words: list[bytes], names: list[str], templates: dict[str, list[bytes]], threshold: float) -> list[tuple]:
    """(name, coverage, first word, end) of every license in ``words``; of those that overlap, the one with most aligned words."""
    found = [(n, *x) for n in names for x in copies(words, templates[n], threshold, decided(templates[n]))]
    taken: list[tuple] = []  # ranges that don't overlap, by their place
    for n, coverage, first, end in sorted(found, key=lambda x: (-round(x[1] * len(templates[x[0]])), -x[1], x[0], x[2])):
        i = bisect.bisect_left(taken, (first,))
        if (i == 0 or taken[i - 1][1] <= first) and (i == len(taken) or end <= taken[i][0]):
            taken.insert(i, (first, end, n, coverage))
    return [(n, coverage, first, end) for first, end, n, coverage in taken]


PLACE = ("license", "coverage", "first_word", "end_word")
KINDS = (pa.string(), pa.float64(), pa.int64(), pa.int64())


def _scan(templates: dict[str, list[bytes]], threshold: float):
    names = sorted(templates)
    hashes: dict[str, list] = {}
    for n in names:
        part = next(W.slices(pa.array([b" ".join(templates[n]).decode()]), W.ALNUM, fold=True))
        hashes[n] = list(zip(*np.unique(part.hash, return_counts=True)))
    vocabulary = np.unique(np.array([h for n in names for h, _ in hashes[n]], np.uint64))
    need = {n: np.zeros(len(vocabulary), np.int32) for n in names}
    for n in names:
        for h, c in hashes[n]:
            need[n][np.searchsorted(vocabulary, h)] = c

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = [(None, 0.0, None, None, [])] * batch.num_rows
            for part in W.slices(batch.column(1), W.ALNUM, fold=True):
                at = np.minimum(np.searchsorted(vocabulary, part.hash), len(vocabulary) - 1)
                hit = np.flatnonzero(vocabulary[at] == part.hash)
                pairs, has = np.unique(part.row[hit].astype(np.int64) * len(vocabulary) + at[hit], return_counts=True)
                row, word = np.divmod(pairs, len(vocabulary))
                rows, row = np.unique(row, return_inverse=True)
                possible: dict[int, list[str]] = {}
                for n in names:
                    shared = np.bincount(row, np.minimum(has, need[n][word]), len(rows))
                    for r in rows[shared >= threshold * len(templates[n]) - 1e-9].tolist():
                        possible.setdefault(r, []).append(n)
                for r in sorted(possible):
                    here = all_matches(word_list(part.text(r)), possible[r], templates, threshold)
                    if here:
                        best = min(here, key=lambda x: (-x[1], -len(templates[x[0]]), x[0], x[2]))
                        out[part.first + r] = (*best, [dict(zip(PLACE, x)) for x in here])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 5, (*KINDS, pa.list_(pa.struct(zip(PLACE, KINDS))))))],
                names=["doc_id", *PLACE, "licenses"])

    return run


def scan_licenses(docs: DataFrame, templates: dict[str, str] | DataFrame = TEMPLATES, threshold: float = THRESHOLD,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the best template with at least ``threshold`` coverage (else null), its coverage, its words' range, and
    ``licenses``: the same of every license in the text. ``templates`` may be a table (license, text)."""
    if isinstance(templates, DataFrame):
        templates = {r.license: r.text for r in templates.select("license", "text").collect()}
    lists = {n: x for n, t in templates.items() if (x := word_list((t or "").encode()))}
    place = "license string, coverage double, first_word long, end_word long"
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _scan(lists, threshold), f"doc_id long, {place}, licenses array<struct<{place.replace(' ', ':').replace(',:', ', ')}>>")


@query("op7_license_scan")
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, and all licenses that it has."""
    return scan_licenses(read(spark, sf_dir, "documents"))
