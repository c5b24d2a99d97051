"""Licence scans with a generalised suffix automaton of licence tokens.

The automaton holds every run of words of all templates. A text is streamed through it, block by block, which gives at each word the
length of the longest run that ends there and stands in some template (matching statistics). Runs of ``LEAST`` words or more that cannot
grow are matches; matches of a template that follow each other in the text and in the template, with gaps of at most ``GAP`` words, are
chained to spans. A label is given to a text if a span covers ``COVER`` of a template or ``LONG`` of its words, and one of its matches
holds the words that decide for the template, which stand in brackets there: notices of different licences share most of their words. The
score is the largest share of a template that a span which gives a label covers.

Beside that, the places of given short phrases are counted exactly (``BASE``), in the same pass.

Edge cases: null and empty texts have no words, no place, score 0 and empty labels; a phrase or match may cross block borders, since the
automaton's state is carried over; rows are independent, so repeated rows get equal results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.shared import blocks

LEAST, GAP, COVER, LONG = 4, 8, 0.5, 12
BLOCK_BYTES = 1 << 18
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())

# Phrases of the base report by label.
BASE = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}

# Public licence texts and notices by label, the words that decide in brackets.
TEMPLATES = {
    "mit": [
        "Released under the [MIT License]",
        "Licensed under the [MIT License]",
        "This project is licensed under the terms of the [MIT license]",
        "[Permission is hereby granted, free of charge], to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "The above copyright notice and [this permission notice shall be included] in all copies or substantial portions of the Software",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose [with or without fee is hereby granted], provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
        "Released under the [ISC License]", "Licensed under the [ISC License]",
    ],
    "zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. [Permission is granted to anyone to use this software] for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
        "Released under the [zlib License]", "Licensed under the [zlib License]",
    ],
    "apache": [
        "Licensed under the [Apache License], Version 2.0",
        "Licensed under the [Apache License], Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "[Unless required by applicable law or agreed to in writing], software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "gpl": [
        "This work is licensed under the [GNU General Public License], version 3",
        "This work is licensed under the [GNU General Public License], version 2",
        "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU General Public License] as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the [GNU General Public License] along with this program",
    ],
    "agpl": [
        "This work is licensed under the [GNU Affero General Public License], version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the [GNU Affero General Public License] as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the [GNU Affero General Public License] along with this program",
    ],
    "lgpl": [
        "This work is licensed under the [GNU Lesser General Public License], version 3",
        "This library is free software; you can redistribute it and/or modify it under the terms of the [GNU Lesser General Public License] as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "mpl": ["This Source Code Form is subject to the terms of the [Mozilla Public License], v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "epl": ["This program and the accompanying materials are made available under the terms of the [Eclipse Public License] 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"],
    "bsd": [
        "[Redistribution and use in source and binary forms], with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to [endorse or promote products derived from this software]",
    ],
    "cc-by": ["Licensed under CC [BY 4.0]", "This work is licensed under a Creative Commons [Attribution 4.0] International License"],
    "cc-by-sa": ["Licensed under CC [BY-SA 4.0]", "This work is licensed under a Creative Commons [Attribution-ShareAlike 4.0] International License"],
    "cc-by-nd": ["Licensed under CC [BY-ND 4.0]", "This work is licensed under a Creative Commons [Attribution-NoDerivatives 4.0] International License"],
    "cc-by-nc": ["Licensed under CC [BY-NC 4.0]", "This work is licensed under a Creative Commons [Attribution-NonCommercial 4.0] International License"],
    "cc-by-nc-sa": ["Licensed under CC [BY-NC-SA 4.0]", "This work is licensed under a Creative Commons [Attribution-NonCommercial-ShareAlike 4.0] International License"],
    "cc-by-nc-nd": ["Licensed under CC [BY-NC-ND 4.0]", "This work is licensed under a Creative Commons [Attribution-NonCommercial-NoDerivatives 4.0] International License"],
    "cc0": ["To the extent possible under law, the author has [waived all copyright] and related or neighboring rights to this work"],
    "unlicense": [
        "This is [free and unencumbered software] released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain.",
    ],
}

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
          "spans array<struct<label:string,template:int,first_word:long,last_word:long,covered:int,decided:boolean>>")


def tokens(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())


def _deciding(template: str) -> tuple[int, int]:
    """First and end word of the part in brackets; an empty range at the start if there is none."""
    before, bracket, rest = template.partition("[")
    if not bracket:
        return 0, 0
    first = len(tokens(before.encode()))
    return first, first + len(tokens(rest.partition("]")[0].encode()))


@dataclass
class Automaton:
    """Suffix automaton of several word sequences; ``ends`` maps a state to (template, place after the run's last word)."""

    step: list[dict[bytes, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    ends: list[set[tuple[int, int]]] = field(default_factory=lambda: [set()])

    def _new(self, length: int, step: dict[bytes, int], link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.ends.append(set())
        return len(self.step) - 1

    def _split(self, state: int, word: bytes, target: int) -> int:
        """A state for the runs of ``target`` that are reached from ``state`` by ``word`` and not longer."""
        copy = self._new(self.length[state] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.step[state].get(word) == target:
            self.step[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        known = self.step[last].get(word)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
        state, new = last, self._new(self.length[last] + 1, {}, 0)
        while state >= 0 and word not in self.step[state]:
            self.step[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.step[state][word]
            self.link[new] = target if self.length[target] == self.length[state] + 1 else self._split(state, word, target)
        return new

    def add(self, template: int, words: list[bytes]) -> None:
        last = 0
        for word in words:
            last = self._extend(last, word)

    def place(self, template: int, words: list[bytes]) -> None:
        """Notes where the runs end; to be called once all templates are in."""
        state = 0
        for at, word in enumerate(words):
            state = self.step[state][word]
            up = state
            while up > 0:
                self.ends[up].add((template, at + 1))
                up = self.link[up]


class Scanner:
    def __init__(self, templates: dict[str, list[str]], base: dict[str, str]):
        self.labels = [label for label, texts in templates.items() for _ in texts]
        self.words = [tokens(t.encode()) for texts in templates.values() for t in texts]
        self.deciding = [_deciding(t) for texts in templates.values() for t in texts]
        self.automaton = Automaton()
        for number, words in enumerate(self.words):
            self.automaton.add(number, words)
        for number, words in enumerate(self.words):
            self.automaton.place(number, words)
        self.phrases: dict[bytes, list[tuple[str, list[bytes]]]] = {}
        for label, phrase in base.items():
            words = tokens(phrase.encode())
            self.phrases.setdefault(words[-1], []).append((label, words))
        self.reach = max((len(w) for p in self.phrases.values() for _, w in p), default=1)

    def scan(self, text: bytes) -> tuple:
        """n_words, places of phrases as (start, label), matches as (first word, end, state)."""
        step, link, length = self.automaton.step, self.automaton.link, self.automaton.length
        start, places, matches = 0, [], []
        state = run = 0
        tail: list[bytes] = []
        for block in blocks(text, _SEPARATORS, BLOCK_BYTES):
            found = tokens(block)
            words, shift = tail + found, start - len(tail)
            for last, phrases in self.phrases.items():
                at = len(tail) - 1
                while True:
                    try:
                        at = words.index(last, at + 1)
                    except ValueError:
                        break
                    places += [(shift + at + 1 - len(p), label) for label, p in phrases if at + 1 >= len(p) and words[at + 1 - len(p):at + 1] == p]
            root = step[0]
            for at, word in enumerate(found, start):
                if not state and word not in root:
                    continue
                after = step[state].get(word)
                if after is None:
                    if run >= LEAST:
                        matches.append((at - run, at, state))
                    while state and after is None:
                        state = link[state]
                        after = step[state].get(word)
                    run = length[state] + 1 if after is not None else 0
                    state = after or 0
                else:
                    state, run = after, run + 1
            start += len(found)
            tail = words[-self.reach:]
        if run >= LEAST:
            matches.append((start - run, start, state))
        return start, sorted(places), matches

    def spans(self, matches: list[tuple[int, int, int]]) -> list[tuple[str, int, int, int, int, bool]]:
        """Chains of matches by template: label, template, first and last word, covered words of the template, whether a match holds its deciding words."""
        by_template: dict[int, list[tuple[int, int, int]]] = {}
        for first, end, state in matches:
            for template, place in sorted(self.automaton.ends[state]):
                by_template.setdefault(template, []).append((first, end, place))
        out = []
        for template, found in sorted(by_template.items()):
            low, high = self.deciding[template]
            chain: tuple[int, int, int, int, bool] | None = None  # first, end, place in the template, covered, decided
            for first, end, place in sorted(found):
                begin = place - (end - first)
                decided = begin <= low and high <= place
                if chain and 0 <= first - chain[1] <= GAP and 0 <= begin - chain[2] <= GAP:
                    chain = (chain[0], end, place, chain[3] + end - first, chain[4] or decided)
                    continue
                if chain and end <= chain[1]:
                    continue
                out += [(template, chain)] if chain else []
                chain = (first, end, place, end - first, decided)
            out += [(template, chain)] if chain else []
        return [(self.labels[t], t, c[0], c[1] - 1, c[3], c[4]) for t, c in out]

    def report(self, text: bytes) -> tuple:
        """The columns after doc_id of SCHEMA."""
        n, places, matches = self.scan(text)
        spans = self.spans(matches)
        strong = [s for s in spans if s[5] and s[4] >= min(LONG, COVER * len(self.words[s[1]]))]
        base = {label for _, label in places}
        score = max((min(1.0, s[4] / len(self.words[s[1]])) for s in strong), default=0.0)
        starts = [s for s, _ in places]
        return n, len(places), min(starts, default=None), max(starts, default=None), sorted(base), sorted(base | {s[0] for s in strong}), score, spans


@cache
def default_scanner() -> Scanner:
    return Scanner(TEMPLATES, BASE)


def scan(documents: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """A row per document as in SCHEMA: words, places of base phrases, labels, score and covered template spans."""
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
    span = pa.struct([("label", pa.string()), ("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("covered", pa.int32()), ("decided", pa.bool_())])
    kinds = [pa.int64()] * 4 + [pa.list_(pa.string())] * 2 + [pa.float64(), pa.list_(span)]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = scanner or default_scanner()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [used.report(t or b"") for t in part.column(1).cast(pa.binary()).to_pylist()]
                columns = [pa.array([r[k] if k < 7 else [dict(zip(("label", "template", "first_word", "last_word", "covered", "decided"), s)) for s in r[k]] for r in rows], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=names)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(build, SCHEMA)
