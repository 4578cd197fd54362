"""License scans: winnowed fingerprints find templates, banded alignment measures them.

Words of a text that no template has break it; the rest is cut into K-grams, of which winnowing
keeps the smallest hash of each window. An inverted index of the templates' own winnowed
fingerprints gives candidates (template, diagonal). Each is aligned with the text within a band
around its diagonal; reported are the share of the template's words that match and the span, of
overlapping matches the one that explains the most words. The index depends on the templates only, so it goes to every task; texts don't move.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.bpe_trie import slices

#: Words in a fingerprint and fingerprints in a winnowing window: K + WINDOW - 1 words in common are always found.
K, WINDOW = 3, 2
#: Words that the text may run ahead of or behind the template.
BAND = 8
#: Distinct words whose ids a worker remembers.
REMEMBERED = 300_000
#: Least share of a template's words in a report.
COVERAGE = 0.8

_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE'
_REDISTRIBUTION = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_ENDORSEMENT = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_DISCLAIMER = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

#: Whole texts of short licenses, the notices of long ones, and the sentences that refer to them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "BSD-2-Clause": f"{_REDISTRIBUTION} {_DISCLAIMER}",
    "BSD-2-Clause-conditions": _REDISTRIBUTION,
    "BSD-3-Clause": f"{_REDISTRIBUTION} {_ENDORSEMENT} {_DISCLAIMER}",
    "BSD-3-Clause-conditions": f"{_REDISTRIBUTION} {_ENDORSEMENT}",
    "BSL-1.0": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so',
    "CC0-1.0": "To the extent possible under law, the author has dedicated all copyright and related and neighboring rights to this work to the public domain worldwide. This work is distributed without any warranty.",
    "ISC": 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.',
    "ISC-permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "MIT": "Released under the MIT License",
    "MIT-text": f'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. {_WARRANTY} AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "MIT-permission": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    "Zlib": "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions",
}
#: Kinds of the Creative Commons licenses 4.0, and of the GNU licenses with their versions.
_COMMONS = {"BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial", "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike", "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives"}
_GNU = {"GPL": ("GNU General Public License", ("2", "3")), "LGPL": ("GNU Lesser General Public License", ("2.1", "3")), "AGPL": ("GNU Affero General Public License", ("3",))}
for _kind, _name in _COMMONS.items():
    TEMPLATES[f"CC-{_kind}-4.0"] = f"Licensed under CC {_kind} 4.0"
    TEMPLATES[f"CC-{_kind}-4.0-notice"] = f"This work is licensed under a Creative Commons {_name} 4.0 International License"
for _kind, (_name, _versions) in _GNU.items():
    _what = "library" if _kind == "LGPL" else "program"
    for _version in _versions:
        _id = f"{_kind}-{_version}" + ("" if "." in _version else ".0")
        TEMPLATES[_id] = f"This work is licensed under the {_name}, version {_version}"
        TEMPLATES[f"{_id}-header"] = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_name} as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version. This {_what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {_name} for more details."
        TEMPLATES[f"{_id}-permission"] = f"This {_what} is free software: you can redistribute it and/or modify it under the terms of the {_name} as published by the Free Software Foundation, either version {_version} of the License, or (at your option) any later version."

WORD = re.compile(r"\w+")


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def winnow(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the fingerprints of word ids; 0 stands for a word without id and is in none."""
    n = len(ids) - K + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    code = np.zeros(n, np.int64)
    known = np.ones(n, bool)
    for i in range(K):
        part = ids[i : i + n]
        code = (code << 20) | part
        known &= part > 0
    hashes = np.where(known, _mix(code) >> np.uint64(1), np.uint64((1 << 64) - 1))
    if n <= WINDOW:
        places = np.array([int(np.argmin(hashes))])
    else:
        views = np.lib.stride_tricks.sliding_window_view(hashes, WINDOW)
        places = np.unique(np.arange(len(views)) + views.argmin(axis=1))
    places = places[known[places]]
    return places, hashes[places]


class Index:
    """Inverted index of the templates' fingerprints."""

    def __init__(self, templates: Mapping[str, str]):
        self.names = list(templates)
        split = [WORD.findall(t.lower()) for t in templates.values()]
        self.vocabulary = {w: i + 1 for i, w in enumerate(sorted(set().union(*split)))}
        self.seen: dict[str, int] = {}
        self.words = [np.array([self.vocabulary[w] for w in s]) for s in split]
        rows = [(int(h), t, int(p)) for t, ids in enumerate(self.words) for p, h in zip(*winnow(ids), strict=True)]
        rows.sort()
        self.hashes = np.array([r[0] for r in rows], np.uint64)
        self.entries = [r[1:] for r in rows]

    def cased(self, word: str) -> int:
        """Id of a word in any case, 0 if no template has it."""
        if (known := self.seen.get(word)) is None:
            if len(self.seen) > REMEMBERED:
                self.seen.clear()
            known = self.seen[word] = self.vocabulary.get(word.lower(), 0)
        return known

    def candidates(self, ids: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, least and greatest place at which it would start) for each group of diagonals that differ by BAND at most."""
        places, hashes = winnow(ids)
        first, last = np.searchsorted(self.hashes, hashes), np.searchsorted(self.hashes, hashes, "right")
        hits = sorted((self.entries[e][0], int(places[i]) - self.entries[e][1]) for i in np.flatnonzero(last > first) for e in range(first[i], last[i]))
        groups: list[list[int]] = []
        for template, start in hits:
            if groups and groups[-1][0] == template and start - groups[-1][1] <= BAND:
                groups[-1][2] = start
            else:
                groups.append([template, start, start])
        return [tuple(g) for g in groups]

    def matches(self, ids: np.ndarray, template: int, first: int, last: int, coverage: float) -> Iterator[tuple[int, int, int]]:
        """(matched words, first and last place) of the best alignment in the band, then of the best ones before and after it.

        Words put in count against a match as words left out do: matched words have to be the share `coverage` of the template and of the span.
        """
        n = len(self.words[template])
        parts = [(max(first - BAND, 0), min(last + BAND + n, len(ids)))]
        while parts:
            low, high = parts.pop()
            if high - low < coverage * n:
                continue
            matched, start, end = self.align(ids, template, first, last, low, high)
            if matched >= coverage * n:
                if matched >= coverage * (end - start + 1):
                    yield matched, start, end
                parts += [(low, start), (end + 1, high)]

    def align(self, ids: np.ndarray, template: int, first: int, last: int, start_at: int, stop_at: int) -> tuple[int, int, int]:
        """(matched words, first and last place) of the best alignment of places from start_at to before stop_at whose diagonals lie in the band.

        A matched word counts 2, a word of the text between matched ones -1, so that a stray match far off doesn't
        stretch the span; in its span, the alignment is a longest common subsequence.
        """
        low = first - BAND
        width = last - first + 2 * BAND + 1
        # A cell: points, matches, first place; larger is better.
        none = (0, 0, 0)
        row: list[tuple[int, int, int]] = [none] * width
        best, where = none, -1
        for i, w in enumerate(self.words[template]):
            new: list[tuple[int, int, int]] = []
            for b in range(width):
                j = i + low + b
                cell = row[b + 1] if b + 1 < width else none  # the template's word is skipped
                if b and (points := new[b - 1][0]) > 1 and (skipped := (points - 1, *new[b - 1][1:])) > cell:  # the text's word is skipped
                    cell = skipped
                if start_at <= j < stop_at and ids[j] == w:
                    above = row[b]
                    taken = (above[0] + 2, above[1] + 1, above[2]) if above[0] else (2, 1, j)
                    if taken > cell:
                        cell = taken
                        if cell > best:
                            best, where = cell, j
                new.append(cell)
            row = new
        return best[1], best[2], where


_indexes: dict[tuple, Index] = {}


def index(templates: Mapping[str, str]) -> Index:
    key = tuple(templates.items())
    if key not in _indexes:
        _indexes[key] = Index(templates)
    return _indexes[key]


def scan_text(known: Index, text: str, ids: np.ndarray, coverage: float) -> list[tuple[str, float, int, int, int, int]]:
    """(license, coverage, start, end, start_char, end_char) of each match.

    Of matches that overlap, of one template or of several, the one with the most matched words stays, of equals the
    one that leaves out or puts in the fewest: the text of one license is often most of another's.
    """

    def order(m: tuple[int, int, int, int]) -> tuple:
        template, matched, start, end = m
        return -matched, len(known.words[template]) + end - start + 1 - 2 * matched, start, template

    kept: list[tuple[int, int, int, int]] = []  # by start; none overlap
    # Bands of neighbouring groups overlap and may find the same.
    for m in sorted({(t, *m) for t, first, last in known.candidates(ids) for m in known.matches(ids, t, first, last, coverage)}, key=order):
        # Only the last one that starts up to m's end may meet m.
        at = bisect(kept, m[3], key=lambda x: x[2])
        if not at or kept[at - 1][3] < m[2]:
            kept.insert(at, m)
    if not kept:
        return []
    spans = [x.span() for x in WORD.finditer(text)]
    return [(known.names[t], matched / len(known.words[t]), a, b, spans[a][0], spans[b][1]) for t, matched, a, b in kept]


def scan(docs: DataFrame, templates: Mapping[str, str] | None = None, doc_id: str = "doc_id", text: str = "text", coverage: float = COVERAGE) -> DataFrame:
    """One row (doc_id, license, coverage, start_word, end_word, start_char, end_char) for each match in each text.

    Case and punctuation don't count; places are counted from 0, end_char is exclusive, end_word
    is the last word's. A text may hold several licenses and several copies of one. Null and empty
    texts have no rows; repeated rows report each; other columns are ignored.
    """
    used = dict(TEMPLATES if templates is None else templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index(used)
        get = known.cased
        for batch in batches:
            for part in slices(batch, "text"):
                out = []
                for i, value in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    if not value:
                        continue
                    words = WORD.findall(value)
                    ids = np.fromiter(map(get, words), np.int64, len(words))
                    out += [(i, *m) for m in scan_text(known, value, ids, coverage)]
                if out:
                    columns = list(zip(*out, strict=True))
                    kinds = [pa.int64(), pa.string(), pa.float64(), *[pa.int64()] * 4]
                    names = ["doc_id", "license", "coverage", "start_word", "end_word", "start_char", "end_char"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, "doc_id long, license string, coverage double, start_word long, end_word long, start_char long, end_char long")
