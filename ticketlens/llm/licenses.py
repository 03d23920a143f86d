"""License scan by patience alignment of texts with notice templates.

A text's words are runs of ASCII letters, digits and non-ASCII bytes, lower
case.  For every template the places are looked up where a window of one and
a half template lengths holds ``COVERAGE`` of the template's number of words
from its vocabulary (one running count over the text, so every place is
covered).  The words around each such run are aligned with the template by
patience: words that occur once in both are anchors if they are in the longest
increasing run of places, and the gaps between anchors are aligned the same way
after common beginnings and ends are taken off.  Coverage is the share of the
template's words that are aligned.  The words that tell a license from its
siblings (``KEYS``: name and version) must be among the aligned ones wherever the
template has them, and no word of a sibling (``SIBLINGS``) may stand between
them.  Of an SPDX identifier all words must be aligned, with nothing but other
parts of an SPDX expression between them.  Of overlapping finds of one family
(``FAMILIES``) the one with more aligned words stays; finds of different
families may share words, as those of a dual license do.  Spans count the
characters of the text as given.

Defined results: NULL and empty texts hold nothing; equal finds go to the
license first in name order; rows that share an id are each scanned; a NULL id
is returned as it is.  An empty table or no template gives an empty result.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, slices
from ticketlens.llm.words import NOT_ALNUM, span_hashes, spans

COVERAGE = 0.8
BLOCK_CHARS = 400_000
RESULT_SCHEMA = "doc_id long, license string, template string, coverage double, words long, start_char long, end_char long"

# fixed values: wording of public license notices (license, template name, text)
_GNU = (
    "This {0} is free software: you can redistribute it and/or modify it under the terms of the GNU {1} Public "
    "License as published by the Free Software Foundation, either version {2} of the License, or (at your option) any "
    "later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without "
    "even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {1} Public "
    "License for more details."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies."
)
_ISC_WARRANTY = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_ADVERTS = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: "
    "This product includes software developed by the organization."
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission."
)
_BSD_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
    "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
TEMPLATES: tuple[tuple[str, str, str], ...] = (
    ("Apache-2.0", "line", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0", "header",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless "
        "required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
        "specific language governing permissions and limitations under the License.",
    ),
    ("MIT", "line", "Released under the MIT License"),
    ("MIT", "licensed line", "Licensed under the MIT License"),
    (
        "MIT", "text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
        "notice and this permission notice shall be included in all copies or substantial portions of the Software. THE "
        "SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
        "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    ("GPL-3.0", "line", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "header", _GNU.format("program", "General", "3")),
    ("CC-BY-NC-4.0", "line", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "line", "Licensed under CC BY 4.0"),
    ("CC-BY-SA-4.0", "line", "Licensed under CC BY-SA 4.0"),
    ("CC-BY-4.0", "sentence", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    (
        "CC-BY-NC-4.0", "sentence",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ),
    (
        "MPL-2.0", "header",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("ISC", "permission", _ISC),
    ("ISC", "text", f"{_ISC} {_ISC_WARRANTY}"),
    ("BSD-2-Clause", "conditions", _BSD),
    ("BSD-2-Clause", "text", f"{_BSD} {_BSD_WARRANTY}"),
    ("BSD-3-Clause", "conditions", f"{_BSD} {_BSD_NAMES}"),
    ("BSD-3-Clause", "text", f"{_BSD} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("BSD-4-Clause", "text", f"{_BSD} {_BSD_ADVERTS} {_BSD_NAMES} {_BSD_WARRANTY}"),
    ("GPL-2.0", "line", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-2.0", "header", _GNU.format("program", "General", "2")),
    ("LGPL-2.1", "header", _GNU.format("library", "Lesser General", "2.1")),
    ("LGPL-3.0", "header", _GNU.format("library", "Lesser General", "3")),
    ("AGPL-3.0", "header", _GNU.format("program", "Affero General", "3")),
    ("All-rights-reserved", "line", "All rights reserved"),
)
SPDX = "spdx"
TEMPLATES += tuple(
    (license, SPDX, f"SPDX-License-Identifier: {license}")
    for license in dict.fromkeys(license for license, _, _ in TEMPLATES)
    if license != "All-rights-reserved"
)
# what may stand between the words of an SPDX identifier: the rest of the expression
SPDX_WORDS = "and or with only later clause exception " + " ".join(license for license, name, _ in TEMPLATES if name == SPDX)
SPDX_REACH = 16  # words of an expression
# licenses whose notices are variants of each other, by the beginning of the name
FAMILIES = {"GPL": "GNU", "LGPL": "GNU", "AGPL": "GNU"}

# fixed values: words that tell a license from its siblings, and words that only its siblings have
KEYS = {
    "Apache-2.0": "apache 2 0", "MIT": "mit", "MPL-2.0": "mozilla public 2 0", "ISC": "notice appear",
    "GPL-2.0": "gnu general public 2", "GPL-3.0": "gnu general public 3", "LGPL-2.1": "gnu lesser general public 2 1",
    "LGPL-3.0": "gnu lesser general public 3", "AGPL-3.0": "gnu affero general public 3",
    "CC-BY-4.0": "cc by attribution 4 0", "CC-BY-NC-4.0": "cc by nc attribution noncommercial 4 0",
    "CC-BY-SA-4.0": "cc by sa attribution sharealike 4 0", "BSD-3-Clause": "endorse", "BSD-4-Clause": "endorse advertising",
}
SIBLINGS = {
    "GPL-2.0": "lesser affero library", "GPL-3.0": "lesser affero library", "CC-BY-4.0": "nc noncommercial sa sharealike nd noderivatives noderivs",
    "CC-BY-NC-4.0": "sa sharealike nd noderivatives noderivs", "CC-BY-SA-4.0": "nc noncommercial nd noderivatives noderivs",
    "BSD-2-Clause": "endorse advertising", "BSD-3-Clause": "advertising",
}


def words_of(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, bytes]:
    """(word hashes, starts, ends in bytes, the lower-cased bytes)."""
    low = text.lower()
    if len(low) != len(text):  # some capitals have two characters in lower case
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    raw = low.encode("utf-8", "replace")
    data = np.frombuffer(raw + b"\n", dtype=np.uint8)
    starts, ends = spans(NOT_ALNUM[data])
    return span_hashes(data, starts, ends), starts, ends, raw


def longest_increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs, given in order of their first, with increasing seconds."""
    tails: list[int] = []
    tail_at: list[int] = []
    back = [-1] * len(pairs)
    for i, (_, b) in enumerate(pairs):
        j = bisect.bisect_left(tails, b)
        back[i] = tail_at[j - 1] if j else -1
        if j == len(tails):
            tails.append(b)
            tail_at.append(i)
        else:
            tails[j], tail_at[j] = b, i
    out, i = [], tail_at[-1] if tail_at else -1
    while i >= 0:
        out.append(pairs[i])
        i = back[i]
    return out[::-1]


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Aligned places (i, j), a[i] == b[j], both increasing."""
    out: list[tuple[int, int]] = []
    work = [(0, len(a), 0, len(b))]
    while work:
        a0, a1, b0, b1 = work.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once: dict[int, int] = {}
        for i in range(a0, a1):
            once[a[i]] = -1 if a[i] in once else i
        there: dict[int, int] = {}
        for j in range(b0, b1):
            there[b[j]] = -1 if b[j] in there else j
        anchors = [(i, there[w]) for w, i in once.items() if i >= 0 and there.get(w, -1) >= 0]
        chain = longest_increasing(sorted(anchors))
        if not chain:
            continue
        out += chain
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)]
        work += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:])]
    return sorted(out)


class Scanner:
    """Finds the templates in texts."""

    def __init__(self, templates: tuple[tuple[str, str, str], ...], coverage: float) -> None:
        self.names = [(license, name) for license, name, _ in templates]
        self.words = [words_of(text)[0] for _, _, text in templates]
        self.coverage = coverage
        self.vocabulary = np.unique(np.concatenate(self.words)) if templates else np.zeros(0, np.uint64)
        self.filter = np.zeros(1 << 16, dtype=bool)
        self.filter[(self.vocabulary & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.family = [FAMILIES.get(license.split("-")[0], license.split("-")[0]) for license, _ in self.names]
        keys = [words_of(text if name == SPDX else KEYS.get(license, ""))[0] for license, name, text in templates]
        self.expression = frozenset(words_of(SPDX_WORDS)[0].tolist())
        self.reach = [len(w) + (SPDX_REACH if name == SPDX else (len(w) + 1) // 2) for (_, name), w in zip(self.names, self.words)]
        self.keys = [np.searchsorted(self.vocabulary, np.intersect1d(k, w)).tolist() for k, w in zip(keys, self.words)]
        self.siblings = [frozenset(words_of(SIBLINGS.get(license, ""))[0].tolist()) for license, _ in self.names]
        self.member = [np.isin(self.vocabulary, w) for w in self.words]
        self.sequence = [np.searchsorted(self.vocabulary, w).tolist() for w in self.words]

    def scan(self, text: str) -> list[tuple[int, float, int, int, int]]:
        """(template number, coverage, aligned words, first character, character after the last) of every find."""
        if not len(self.vocabulary):
            return []
        hashes, starts, ends, raw = words_of(text)
        some = np.flatnonzero(self.filter[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.vocabulary, hashes[some]), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == hashes[some]
        place, word = some[hit], at[hit]  # only these words count
        found = []
        for t, sequence in enumerate(self.sequence):
            need = max(1, int(np.ceil(self.coverage * len(sequence) - 1e-9)))
            window = self.reach[t]
            own = place[self.member[t][word]]
            if len(own) < need:
                continue
            # runs of ``need`` vocabulary words within a window
            first = np.flatnonzero(own[need - 1 :] - own[: len(own) - need + 1] < window)
            if not len(first):
                continue
            low, high = own[first], own[first + need - 1]
            for run in np.split(np.arange(len(first)), np.flatnonzero(low[1:] > high[:-1] + window) + 1):
                found += self._align(t, hashes, place, word, int(low[run[0]]), int(high[run[-1]]) + 1, need, window)
        out: list[tuple[int, float, int, int, int]] = []
        taken: list[tuple[int, int, str]] = []
        for n, share, t, a, b in sorted(found, key=lambda x: (-x[0], -x[1], self.names[x[2]], x[3])):
            if all(b <= x or a >= y or family != self.family[t] for x, y, family in taken):
                taken.append((a, b, self.family[t]))
                out.append((t, share, n, len(raw[: starts[a]].decode("utf-8", "replace")), len(raw[: ends[b - 1]].decode("utf-8", "replace"))))
        return sorted(out, key=lambda x: (x[3], x[0]))

    def _told(self, t: int, pairs: list[tuple[int, int]], hashes: np.ndarray) -> bool:
        """Whether the template's own words are aligned and no sibling's word stands among the aligned ones."""
        aligned = {self.sequence[t][i] for i, _ in pairs}
        if not aligned.issuperset(self.keys[t]):
            return False
        is_spdx = self.names[t][1] == SPDX
        if not self.siblings[t] and not is_spdx:
            return True
        here = {j for _, j in pairs}
        between = hashes[pairs[0][1] : pairs[-1][1]].tolist()
        if is_spdx and not all(w in self.expression or pairs[0][1] + j in here for j, w in enumerate(between)):
            return False
        return not any(w in self.siblings[t] and pairs[0][1] + j not in here for j, w in enumerate(between))

    def _align(self, t: int, hashes, place, word, low: int, high: int, need: int, window: int) -> list[tuple[int, float, int, int, int]]:
        """Finds of template t between two words: one alignment after the other until one covers too little."""
        sequence, out = self.sequence[t], []
        at = np.full(high - low, -1, dtype=np.int64)
        inside = (place >= low) & (place < high)
        at[place[inside] - low] = word[inside]
        begin = 0
        while begin < len(at):
            # step by step through a long run, each step one window with the next copy's beginning in it
            some = at[begin : begin + window].tolist()
            pairs = patience(sequence, [x if x >= 0 else -2 - i for i, x in enumerate(some)])
            if len(pairs) >= need and self._told(t, pairs, hashes[low + begin :]):
                a, b = begin + pairs[0][1], begin + pairs[-1][1] + 1
                out.append((len(pairs), len(pairs) / len(sequence), t, low + a, low + b))
                begin = b
            else:
                begin += max(1, window - len(sequence)) // 2 or 1
        return out


def scan_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: tuple[tuple[str, str, str], ...] = TEMPLATES,
    coverage: float = COVERAGE,
) -> DataFrame:
    """One row per notice found: doc_id, license, template, coverage, aligned words and character span."""
    ready_workers(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, coverage)
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for t, share, n, a, b in scanner.scan(text or ""):
                    rows.append((doc, *scanner.names[t], share, n, a, b))
            types = [pa.int64(), pa.string(), pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "license", "template", "coverage", "words", "start_char", "end_char"]
            yield pa.record_batch([pa.array([r[i] for r in rows], x) for i, x in enumerate(types)], names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT_SCHEMA)
