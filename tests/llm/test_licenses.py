"""License scan: chains against brute force, planted notices, edge rows."""

import itertools

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, no_docs, prose  # noqa: F401

from ticketlens.llm.licenses import TEMPLATES, Scanner, longest_increasing, patience, scan_licenses


@settings(max_examples=150, deadline=None)
@given(st.permutations(range(7)))
def test_longest_increasing_run(order):
    got = longest_increasing(list(enumerate(order)))
    assert all(a < c and b < d for (a, b), (c, d) in zip(got, got[1:]))
    best = max(n for n in range(8) for some in itertools.combinations(order, n) if list(some) == sorted(some))
    assert len(got) == best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 9), max_size=15), st.lists(st.integers(0, 9), max_size=15))
def test_patience_gives_a_common_subsequence(a, b):
    pairs = patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@settings(max_examples=150, deadline=None)
@given(st.permutations(range(9)), st.sets(st.integers(0, 8)), st.sets(st.integers(20, 29), max_size=4))
def test_patience_of_words_that_occur_once_is_the_longest_alignment(order, gone, more):
    a = list(range(9))
    b = [x for x in order if x not in gone] + sorted(more)
    assert len(patience(a, b)) == lcs(a, b)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_patience_against_its_definition(a, b):
    """Ends that agree and the longest chains of unique words, gap by gap: never more than the longest alignment, and all of that."""
    pairs = patience(a, b)
    assert len(pairs) <= lcs(a, b)
    edges = [(-1, -1), *pairs, (len(a), len(b))]
    for (i, j), (k, m) in zip(edges, edges[1:]):  # a gap that is left holds no agreeing ends and no word unique to both
        x, y = a[i + 1 : k], b[j + 1 : m]
        if x and y:
            assert x[0] != y[0] and x[-1] != y[-1]
            assert not any(x.count(w) == 1 and y.count(w) == 1 for w in x)


def test_dual_licenses_identifiers_and_offsets():
    scanner = Scanner(TEMPLATES, 0.8)

    def found(text):
        return [(scanner.names[x[0]][0], text[x[3] : x[4]]) for x in scanner.scan(text)]

    assert {n for n, _ in found("Licensed under the MIT License and the Apache License, Version 2.0")} == {"MIT", "Apache-2.0"}
    assert found("// SPDX-License-Identifier: MIT\nint x;") == [("MIT", "SPDX-License-Identifier: MIT")]
    assert {n for n, _ in found("# SPDX-License-Identifier: (Apache-2.0 OR MIT)")} == {"MIT", "Apache-2.0"}
    assert {n for n, _ in found("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0")} <= {"GPL-2.0"}
    assert [n for n, _ in found("SPDX-License-Identifier: LGPL-3.0-or-later")] == ["LGPL-3.0"]
    assert [n for n, _ in found("SPDX-License-Identifier: CC-BY-NC-4.0")] == ["CC-BY-NC-4.0"]
    assert found("SPDX-License-Identifier: Zlib. Written at MIT by hand") == []
    text = "İİİ Ǆ straße İ Released under the MIT License. İ"
    assert found(text) == [("MIT", "Released under the MIT License")]


def test_patience_aligns_edited_sequences():
    a = list(range(40))
    b = [x for x in a if x not in (5, 17)]
    b[10:10] = [100, 101]
    assert len(patience(a, b)) == 38


def test_every_template_is_found_whole_and_edited():
    scanner = Scanner(TEMPLATES, 0.8)
    for t, (license, name, text) in enumerate(TEMPLATES):
        whole = f"{prose(t, 50)} {text.upper()}\n{prose(t + 50, 40)}"
        found = [x for x in scanner.scan(whole) if scanner.names[x[0]] == (license, name)]
        assert len(found) == 1 and found[0][1] == 1.0, (license, name)
        _, _, _, a, b = found[0]
        assert whole[a:b].split()[0].strip('"') == text.upper().split()[0].strip('"')
        words = text.split()
        if len(words) > 30:
            del words[20], words[11]
            words[5] = "changed"
            edited = scanner.scan(f"{prose(t, 50)} {' '.join(words)} {prose(t, 9)}")
            best = max(edited, key=lambda x: x[2])
            assert scanner.names[best[0]] == (license, name) and 0.8 < best[1] < 1


def test_siblings_are_told_apart():
    scanner = Scanner(TEMPLATES, 0.8)

    def licenses(text):
        return [scanner.names[x[0]][0] for x in scanner.scan(f"{prose(1, 20)} {text} {prose(2, 20)}")]

    nothing = (
        "Licensed under the BSD License", "Released under the Zlib License", "Licensed under CC BY-SA 3.0", "Licensed under CC BY 3.0",
        "Licensed under CC BY-ND 4.0", "Licensed under CC BY-NC-SA 4.0", "Licensed under the Apache License, Version 1.1",
        "This work is licensed under the GNU Free Documentation License, version 3",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    )
    for text in nothing:
        assert licenses(text) == [], text
    assert licenses("Licensed under the BSD License. Licensed under the MIT License") == ["MIT"]
    gpl = next(text for license, name, text in TEMPLATES if (license, name) == ("GPL-3.0", "header"))
    assert licenses(gpl.replace("software:", "software;").replace("version 3", "version 2")) == ["GPL-2.0"]
    assert licenses(gpl.replace("GNU General", "GNU Lesser General")) == ["LGPL-3.0"]
    assert licenses(gpl.replace("GNU General", "GNU Affero General")) == ["AGPL-3.0"]
    assert licenses(gpl.replace("program", "library").replace("GNU General", "GNU Lesser General").replace("version 3", "version 2.1")) == ["LGPL-2.1"]
    for license, name, text in TEMPLATES:
        assert licenses(text) == [license], (license, name)
        if license.startswith(("BSD", "ISC")) and name == "text":
            found = scanner.scan(text)
            assert [x[3:] for x in found] == [(0, len(text.rstrip(".")))], license


def test_repeated_notices_and_clean_texts():
    scanner = Scanner(TEMPLATES, 0.8)
    line = "Released under the MIT License. "
    assert len(scanner.scan(line * 7 + prose(1, 30) + " " + line)) == 8
    assert scanner.scan(prose(2, 5000) + " the terms of the software under the public of this") == []


def test_edge_rows(spark, edge_docs, no_docs):
    assert scan_licenses(edge_docs).collect() == []
    assert scan_licenses(no_docs).collect() == []
    docs = spark.createDataFrame([(None, "All rights reserved"), (2, "x ALL rights\nreserved."), (3, None), (2, "x ALL rights\nreserved.")], "doc_id long, text string")
    rows = sorted((tuple(r) for r in scan_licenses(docs).collect()), key=str)
    assert [r[0] for r in rows] == [2, 2, None]
    assert rows[0][5:] == (2, 21)
    assert scan_licenses(docs, templates=()).collect() == []
