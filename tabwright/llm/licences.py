"""Licence scan: lines, paragraphs and windows of words against licence templates by the Dice coefficient of their word bigrams."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tabwright.llm.common import bytes_of, map_arrow, texts

# The wording of public licence notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    ),
    "BSD-line": "Released under the BSD License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; "
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."
    ),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This library is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "MIT-full": (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, '
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. '
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE "
        "OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "BSD-2-Clause-full": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. '
        "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
        "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
        "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
    ),
    "ISC-full": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. "
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. '
        "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, "
        "NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
    ),
    "Zlib": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. "
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: "
        "1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
_WORDS = re.compile(rb"[a-z0-9]+")


def bigrams(text: bytes) -> set[tuple[bytes, bytes]]:
    """Distinct pairs of neighbouring words: runs of ASCII letters and digits, A-Z lower-cased."""
    w = _WORDS.findall(text.lower())
    return set(zip(w, w[1:]))


class Matcher:
    """Templates by size and by bigram. A text of n bigrams is compared only with templates of a size s where 2 * min(n, s) / (n + s) reaches t."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.t = threshold
        self.size = {k: len(bigrams(v.encode())) for k, v in templates.items()}
        self.words = {k: len(_WORDS.findall(v.lower().encode())) for k, v in templates.items()}
        self.having: dict[tuple[bytes, bytes], list[str]] = defaultdict(list)
        for k, v in templates.items():
            for b in bigrams(v.encode()):
                self.having[b].append(k)
        longest = int(max(self.size.values(), default=0) * (2 - threshold) / threshold) + 1
        self.fits = [{k for k, s in self.size.items() if s and 2 * min(n, s) / (n + s) >= threshold} for n in range(longest + 1)]

    def candidates(self, words: list[bytes]) -> set[str]:
        """Templates that some part of a text may match: a part of g bigrams that shares s of a template's h reaches t only if s >= h t / (2 - t), as g >= s."""
        shared = Counter(k for b in {b for b in zip(words, words[1:]) if b in self.having} for k in self.having[b])
        return {k for k, s in shared.items() if (2 - self.t) * s >= self.t * self.size[k] - 1e-9}

    def __call__(self, text: bytes, among: set[str]) -> list[tuple[str, float]]:
        found = bigrams(text)
        if not found or len(found) >= len(self.fits) or not (fits := self.fits[len(found)] & among):
            return []
        shared = Counter(k for b in found & self.having.keys() for k in self.having[b] if k in fits)
        return [(k, d) for k, n in sorted(shared.items()) if (d := 2 * n / (len(found) + self.size[k])) >= self.t]

    def windows(self, words: list[bytes], k: str) -> list[tuple[int, int, float]]:
        """(first word, words, dice) of the parts of a text as long as template k that match it: of windows that begin less than half a template
        apart the best, of equal ones the first."""
        length = min(self.words[k], len(words))
        pairs, counts, shared = list(zip(words, words[1:])), Counter(), 0
        own = {b for b in set(pairs) if k in self.having.get(b, ())}
        found: list[tuple[int, int, float]] = []
        last = -length
        for i, b in enumerate(pairs):
            counts[b] += 1
            shared += b in own and counts[b] == 1
            start = i - (length - 2)
            if start < 0:
                continue
            if start:
                old = pairs[start - 1]
                counts[old] -= 1
                if not counts[old]:
                    del counts[old]
                    shared -= old in own
            if (d := 2 * shared / (len(counts) + self.size[k])) >= self.t:
                if 2 * (start - last) >= length or not found:
                    found.append((start, length, d))
                elif d > found[-1][2]:
                    found[-1] = (start, length, d)
                last = start
        return found


def units(text: bytes) -> Iterator[tuple[int, int, bytes]]:
    r"""(first line, lines, text): every line, and every paragraph (run of lines that hold a letter or digit) of two lines or more."""
    lines, start = text.split(b"\n"), 0
    for i, line in enumerate([*lines, b""]):
        if i < len(lines):
            yield i, 1, line
        if i == len(lines) or not _WORDS.search(line.lower()):
            if i - start > 1:
                yield start, i - start, b"\n".join(lines[start:i])
            start = i + 1


def matches(text: bytes, match: Matcher) -> Iterator[tuple[str, int, int, str, float]]:
    """(unit, first line, lines, licence, dice) of a text's lines, paragraphs and windows."""
    words = _WORDS.findall(text.lower())
    if not (among := match.candidates(words)):
        return
    for i, n, unit in units(text):
        for k, dice in match(unit, among):
            yield "line" if n == 1 else "paragraph", i, n, k, dice
    ends, at = [], 0  # how many words the lines up to each hold
    for line in text.lower().split(b"\n"):
        at += len(_WORDS.findall(line))
        ends.append(at)
    for k in sorted(among):
        for start, n, dice in match.windows(words, k):
            first, last = bisect_right(ends, start), bisect_right(ends, start + n - 1)
            yield "window", first, last - first + 1, k, dice


def scan(docs: DataFrame, threshold: float = 0.8, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, unit, line, n_lines, licence, dice) for each line, paragraph or window whose Dice coefficient with a template is at least ``threshold``.

    A window is a part of the text with as many words as the template, or the whole of a shorter text: it finds notices of several paragraphs, inside
    longer lines, below a copyright line, or behind comment marks, which are no words. Windows that begin less than half a template's length
    after one another are one find, the best of them. ``line`` is the first one's number, from 0. A notice that is a paragraph is found as both.

    Nothing is shuffled: templates are a fixed small table, and a document is scanned where it is read; only those that hold enough of a template's
    bigrams anywhere are looked at closer. Null, empty or wordless texts match nothing, a very long line is only as large as its bigrams, ties are
    all returned, repeated rows repeat their rows; rows without an id are left out; further columns are ignored.
    """
    match = Matcher(TEMPLATES if templates is None else templates, threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.float64())
        for batch in batches:
            rows = [(d, *found) for d, text in zip(batch.column("doc_id").to_pylist(), bytes_of(batch, "text")) for found in matches(text, match)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], ["doc_id", "unit", "line", "n_lines", "licence", "dice"])

    return map_arrow(texts(docs, id_col, text_col), run, "doc_id bigint, unit string, line bigint, n_lines bigint, licence string, dice double")
