"""Fill-in-middle: bit arithmetic against a regular expression, cuts and outputs against plain Python, exact round trip."""

import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, no_docs, prose  # noqa: F401
from pyspark.sql import functions as F

from ticketlens.llm import fim

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plain(doc_id, text):
    """n, form, prefix_chars, middle_chars, output."""
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def columns(ids, texts):
    got = fim.transform(ids, [(t or "").encode() for t in texts])
    return [(n, f, p, m, o.decode()) for n, f, p, m, o in zip(*(got[k] for k in ("n", "form", "prefix_chars", "middle_chars", "output")))]


ALPHABET = "abzAZ@[`{ \n.<>PSM019é€😀\x00\x7f\x80ÿ"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(ALPHABET, max_size=40), st.text(max_size=20).filter(lambda t: t.isprintable())), max_size=12), st.integers(0, 10**6))
def test_many_texts_at_once(texts, first):
    ids = [first + i for i in range(len(texts))]
    assert columns(ids, texts) == [plain(i, t) for i, t in zip(ids, texts)]


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET, min_size=1, max_size=60))
def test_rank_and_select_of_unit_ends(text):
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    ranks = fim.Ranks(fim.unit_ends(fim.as_words(data), np.array([len(data) - 1])))
    at, want = 0, []
    for unit in UNIT.findall(text):
        at += len(unit.encode())
        want.append(at - 1)
    assert ranks.select(np.arange(1, len(want) + 1)).tolist() == want
    assert ranks.rank(np.arange(len(data) + 1)).tolist() == [sum(w < p for w in want) for p in range(len(data) + 1)]


def test_letters_by_byte():
    data = np.arange(256, dtype=np.uint8)
    marks = fim.letters(fim.as_words(data))
    flags = [bool(int(marks[i // 8]) >> (8 * (i % 8) + 7) & 1) for i in range(256)]
    assert flags == [chr(i).isascii() and chr(i).isalpha() for i in range(256)]


def test_markers_across_the_seams(spark):
    """Texts that hold pieces of markers come back whole."""
    rs = random.Random(3)
    texts = ["".join(rs.choice(["<", "P", ">", "S", "M", "<P", "S>", "a"]) for _ in range(rs.randint(1, 30))) for _ in range(400)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in fim.fill_in_middle(rows).withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()}
    assert {i: r["back"] for i, r in got.items()} == dict(enumerate(texts))
    assert {r["form"] for r in got.values()} == {"plain", "psm", "spm"}
    assert {i: tuple(r)[1:6] for i, r in got.items()} == {i: plain(i, t) for i, t in enumerate(texts)}


def test_edge_rows_blocks_and_empty_table(spark, edge_docs, edge_rows, no_docs, monkeypatch):  # noqa: F811
    def digest(t):
        return hashlib.sha256(t.encode()).hexdigest()

    want = sorted(((r[0], *p[:4], digest(p[4]), digest(r[1] or "")) for r in edge_rows for p in [plain(r[0], r[1])]), key=repr)
    for size in (fim.BLOCK_BYTES, 100):
        monkeypatch.setattr(fim, "BLOCK_BYTES", size)
        got = fim.fill_in_middle_digests(edge_docs)
        assert sorted(map(tuple, got.collect()), key=repr) == want
    assert fim.fill_in_middle_digests(no_docs).collect() == []


def test_very_long_text():
    text = prose(9, 300_000) + "é" * 1000
    assert columns([7, 8, 9], [text, "", text]) == [plain(7, text), plain(8, ""), plain(9, text)]
