"""License scan by patience alignment.

Words that occur once in a stretch of text and once in a template are paired;
the longest increasing subsequence of these pairs anchors the alignment, and
the gaps between anchors are aligned in the same way. A template's coverage is
the share of its words that are aligned.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waybatch.llm.common import NOT_ALNUM, prepared, ragged, steps, text_buffers, word_hashes, word_spans

#: Least coverage of a match.
COVERAGE = 0.8

# Public license texts, notices and statements.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.")
_MIT_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF '
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR "
    "ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
    "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_CONDITION = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_DISCLAIMER = (
    ' THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY "
    "DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
    "documentation and/or other materials provided with the distribution. ")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. ")
_BSD_DISCLAIMER = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT '
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
    "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON "
    "ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF "
    "THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")


def _gnu_notice(thing: str, kind: str, version: str) -> str:
    """The notice that the GNU licenses recommend, which differs in three places."""
    return (f"This {thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} License as published "
            f"by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. This {thing} is "
            "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
            f"FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} License for more details.")


#: Whole texts of the short licenses; notices of the long ones, as their
#: authors have them put in files; one-line statements.
TEMPLATES = {
    "Apache-2.0-statement": "Licensed under the Apache License, Version 2.0.",
    "MIT-statement": "Released under the MIT License.",
    "GPL-3.0-statement": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0-statement": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-statement": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0-statement": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        'in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    "MPL-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    "GPL-2.0-notice": _gnu_notice("program", "General Public", "2"),
    "GPL-3.0-notice": _gnu_notice("program", "General Public", "3"),
    "LGPL-2.1-notice": _gnu_notice("library", "Lesser General Public", "2.1"),
    "LGPL-3.0-notice": _gnu_notice("library", "Lesser General Public", "3"),
    "AGPL-3.0-notice": _gnu_notice("program", "Affero General Public", "3"),
    "MIT": f"{_MIT_GRANT} {_MIT_DISCLAIMER}",
    "ISC": _ISC_GRANT + _ISC_CONDITION + _ISC_DISCLAIMER,
    "0BSD": _ISC_GRANT + "." + _ISC_DISCLAIMER,
    "BSD-2-Clause": _BSD_TWO + _BSD_DISCLAIMER,
    "BSD-3-Clause": _BSD_TWO + _BSD_THIRD + _BSD_DISCLAIMER,
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, "
        "an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any "
        "source distribution."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, "
        "or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and "
        "by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
        "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment "
        "of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future "
        "rights to this software under copyright law."),
}


def _longest_rising(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        back.append(ends[k - 1] if k else -1)
        tails[k:k + 1], ends[k:k + 1] = [v], [i]
    out, i = [], ends[-1] if ends else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(text: Sequence, template: Sequence) -> list[tuple[int, int]]:
    """Aligned places ``(in text, in template)``, rising in both. In each gap,
    equal words at its two ends are aligned first, then the anchors; a gap
    without anchors stays open."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            out.append((b - 1, d - 1))
            b, d = b - 1, d - 1
        if a == b or c == d:
            continue
        here, there = Counter(text[a:b]), Counter(template[c:d])
        place = {w: i for i, w in enumerate(template[c:d], c) if there[w] == 1}
        pairs = [(i, place[w]) for i, w in enumerate(text[a:b], a) if here[w] == 1 and w in place]
        anchors = [pairs[k] for k in _longest_rising([p for _, p in pairs])]
        if anchors:
            out += anchors
            edges = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(i + 1, j, k + 1, m) for (i, k), (j, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def _value(pairs: list[tuple[int, int]], n: int) -> int:
    """Aligned words, less the words that the template of ``n`` words and the
    stretch from the first to the last aligned word have beside them."""
    return 3 * len(pairs) - n - (pairs[-1][0] - pairs[0][0] + 1)


def _dense(pairs: list[tuple[int, int]], least: float) -> list[tuple[int, int]]:
    """The run of pairs of the highest value, without strays at the ends; all
    pairs where the run has fewer than ``least``."""
    start, value, best = 0, 0, (0, 0, 0)
    for k, (i, _) in enumerate(pairs):
        gap = i - pairs[k - 1][0] if k else 0
        if k and value >= gap:
            value += 3 - gap
        else:
            start, value = k, 2
        best = max(best, (value, -start, k + 1))
    run = pairs[-best[1]:best[2]]
    return run if len(run) >= least else pairs


class Templates:
    """Templates as word hashes, and for each which words it has."""

    def __init__(self, texts: dict[str, str]):
        self.names = list(texts)
        words, before = _words(pa.array(list(texts.values()), pa.string()))
        self.words = [words[s:e].tolist() for s, e in zip(before[:-1], before[1:], strict=True)]
        self.vocabulary = np.unique(words)
        self.has = [np.isin(self.vocabulary, w) for w in self.words]
        self.counts = [Counter(w) for w in self.words]

    def matches(self, words: np.ndarray, before: np.ndarray, least: float) -> Iterator[tuple[int, str, float, int, int]]:
        """``(text, template, coverage, from, to)``: the best stretch of each
        template in each text. Stretches of one and a half template lengths,
        half a length apart, are aligned if they hold enough of its words. Of
        matches that share words of the text the one of the highest value
        stays (see ``_value``), then the first by name."""
        if len(self.vocabulary) == 0 or len(words) == 0:
            return
        at = np.minimum(np.searchsorted(self.vocabulary, words), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == words
        found: dict[int, set[tuple]] = {}
        for k, template in enumerate(self.words):
            n = len(template)
            if n == 0:
                continue
            step, width = max(1, n // 2), n + max(1, n // 2)
            sums = np.concatenate([[0], np.cumsum(known & self.has[k][at])])
            text, place = ragged(-(-np.diff(before) // step))
            start = before[:-1][text] + place * step
            end = np.minimum(start + width, before[1:][text])
            for i in np.flatnonzero(sums[end] - sums[start] >= least * n).tolist():
                part = words[start[i]:end[i]].tolist()
                if sum((Counter(part) & self.counts[k]).values()) < least * n:
                    continue
                pairs = align(part, template)
                if len(pairs) >= least * n:
                    pairs = _dense(pairs, least * n)
                    t, origin = int(text[i]), int(start[i] - before[text[i]])
                    first, last = origin + pairs[0][0], origin + pairs[-1][0] + 1
                    found.setdefault(t, set()).add((-_value(pairs, n), self.names[k], first, last, len(pairs) / n))
        for t, matches in found.items():
            taken: list[tuple[int, int]] = []  # disjoint stretches in order
            best: dict[str, tuple[float, int, int]] = {}
            for _, name, first, last, coverage in sorted(matches):
                at = bisect_left(taken, (first, last))
                if (at == 0 or taken[at - 1][1] <= first) and (at == len(taken) or taken[at][0] >= last):
                    taken.insert(at, (first, last))
                    best.setdefault(name, (coverage, first, last))
            for name, (coverage, first, last) in best.items():
                yield t, name, coverage, first, last


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_buffers(pc.utf8_lower(texts))
    starts, ends, before = word_spans(data, offsets, NOT_ALNUM)
    return word_hashes(data, starts, ends), before


def scan(spark: SparkSession, docs: DataFrame, templates: dict[str, str] | None = None, least: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, license, coverage, start_word, end_word)``: a row for each
    template that a text covers to ``least`` or more, with its best stretch
    (the first of equal ones) in words of the text. Of templates that match at
    one place only the best is named: a license that contains another, or
    differs from it in a word, isn't reported as both.

    Words are lower-cased runs of letters and digits. Null, empty and wordless
    texts, and wordless templates, match nothing. Whole texts of any length
    are scanned, stretch by stretch. Repeated rows give repeated rows; other
    columns are ignored. ``templates`` is a bounded list of the caller's.
    """
    prepared(spark)
    texts = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(texts)
        for b in steps(batches, "text"):
            rows = sorted(known.matches(*_words(b.column("text")), least))
            if rows:
                text, name, coverage, start, end = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(text)), pa.array(name), pa.array(coverage, pa.float64()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                    ["doc_id", "license", "coverage", "start_word", "end_word"])

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(run, f"doc_id {kind}, license string, coverage double, start_word long, end_word long")
