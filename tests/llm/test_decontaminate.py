"""Decontamination: alignment against the textbook table, planted copies, edge rows."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import edge_docs, edge_rows, no_docs, prose  # noqa: F401

from ticketlens.llm.decontaminate import GAP, MATCH, MISMATCH, align, contaminated, keep_clean
from ticketlens.llm.words import word_hashes


def textbook(a, b):
    best = 0
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            s = MATCH if a[i] == b[j] else -MISMATCH
            h[i + 1][j + 1] = max(0, h[i][j] + s, h[i][j + 1] - GAP, h[i + 1][j] - GAP)
            best = max(best, h[i + 1][j + 1])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=12), st.lists(st.integers(0, 4), max_size=20))
def test_alignment_scores_as_the_textbook_table(a, b):
    score, start, end = align(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64))
    best = textbook(a, b)
    assert score == (best / (MATCH * len(a)) if a and b else 0)
    # the span holds the whole alignment
    assert textbook(a, b[start:end]) == best


def _tables(spark):
    items = [(i, prose(1000 + i, 25 + i)) for i in range(8)] + [(90, None), (91, ""), (92, "too short"), (None, prose(5, 30))]
    rs = random.Random(1)
    rows, want = [], set()
    for i in range(60):
        text = prose(2000 + i, 80).split()
        if i % 3 == 0:
            item = items[i % 8][1].split()
            if i % 2:  # an edited copy: one word in six replaced, one dropped
                item = [f"edit{k}" if k % 6 == 4 else w for k, w in enumerate(item) if k != 9]
            at = rs.randint(0, 80)
            text = text[:at] + item + text[at:]
            want.add((i, i % 8))
        rows.append((i, " ".join(text)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), want


def test_exact_and_edited_copies_are_found_and_no_others(spark):
    docs, items, want = _tables(spark)
    found = contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == want
    for r in found:
        if r["doc_id"] % 2 == 0:
            assert r["score"] > 0.9
    kept = keep_clean(docs, items)
    assert {r["doc_id"] for r in kept.collect()} == set(range(60)) - {d for d, _ in want}


def test_a_passage_in_every_document_is_found(spark):
    item = prose(77, 40)
    docs = spark.createDataFrame([(i, f"{prose(i, 20)} {item} {prose(500 + i, 20)}") for i in range(300)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert contaminated(docs, items).count() == 300


@pytest.mark.parametrize("broadcast", [True, False])
def test_edited_copies_of_a_passage_in_most_documents_are_found(spark, monkeypatch, broadcast):
    from ticketlens.llm import decontaminate

    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", -1)
    # every 4th to 6th word of the passage replaced: from any word on, and in all copies the same ones
    passages = {i: prose(900 + i, n) for i, n in enumerate((20, 30, 45, 20))}
    rs = random.Random(3)
    rows, want = [], set()
    for i in range(3000 if broadcast else 400):
        item = i % 4
        step, first = (4, 1) if item == 3 else (rs.choice((4, 5, 6)), rs.randint(0, 5))
        copy = [f"edit{rs.randint(0, 9999)}" if k % step == first % step else w for k, w in enumerate(passages[item].split())]
        rows.append((i, f"{prose(i, 20)} {' '.join(copy)} {prose(5000 + i, 20)}"))
        want.add((i, item))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame(list(passages.items()), "item_id long, text string")
    for i, text in rows:
        assert align(word_hashes([passages[i % 4]])[0], word_hashes([text])[0])[0] >= 0.5
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()} == want


def _edited(words, kind, step, first):
    """Every ``step``-th word replaced, left out, or followed by a new one."""
    out = []
    for k, w in enumerate(words):
        hit = k % step == first % step
        if kind == "replaced":
            out.append(f"new{k}" if hit else w)
        elif kind == "left out":
            out += [] if hit else [w]
        else:
            out += [w, f"new{k}"] if hit else [w]
    return out


@pytest.mark.parametrize("broadcast", [True, False])
def test_no_copy_at_the_threshold_is_lost(spark, monkeypatch, broadcast):
    """Against the alignment of every document with every item: edits of every first to sixth word of all kinds."""
    from ticketlens.llm import decontaminate

    if not broadcast:
        monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", -1)
    items = {i: prose(3000 + i, n) for i, n in enumerate((3, 4, 5, 8, 20, 30, 45))}
    rows = []
    for i, item in items.items():
        for kind in ("replaced", "left out", "added"):
            for step in range(1, 7):
                for first in range(step):
                    copy = _edited(item.split(), kind, step, first)
                    rows.append((len(rows), f"{prose(len(rows), 15)} {' '.join(copy)} {prose(9000 + len(rows), 15)}"))
    rs = random.Random(8)
    vocabulary = " ".join(items.values()).split()  # texts full of the items' words, most in no order
    rows += [(len(rows) + k, " ".join(rs.choice(vocabulary) for _ in range(400))) for k in range(30)]
    hashed = {i: word_hashes([t])[0] for i, t in items.items()}
    want = {(d, i): align(w, h)[0] for d, t in rows for h in [word_hashes([t])[0]] for i, w in hashed.items()}
    want = {k: v for k, v in want.items() if v >= 0.5}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]): r["score"] for r in found} == want
    thirds = [d for d, i in want if want[d, i] < 0.55]
    assert len(thirds) > 40  # copies close to the threshold are among them


def test_pairs_needed_is_a_lower_bound():
    """Against all alignments of short items: the least number of pair seeds among those that score the threshold."""
    from ticketlens.llm.decontaminate import pairs_needed

    for n in range(3, 9):
        least = n
        # steps between matched words: words skipped in the item and in the document
        def walk(at, points, seeds, pairs_at_three):
            nonlocal least
            if points >= n:  # threshold one half: n of 2 n points
                least = min(least, seeds + pairs_at_three)
            for skip in range(n - at - 1):
                for between in range(4):
                    cost = max(skip, between)
                    is_pair = skip == 0 and between <= 1
                    outer = n == 3 and skip == 1 and between <= 1
                    walk(at + skip + 1, points - cost + 2, seeds + is_pair, pairs_at_three + outer)

        for first in range(n):
            walk(first, 2, 0, 0)
        assert pairs_needed(n, 0.5) <= max(1, least)
        assert least >= 1


def test_items_that_share_an_id_are_searched_each(spark):
    items = spark.createDataFrame([(1, prose(1, 30)), (1, prose(2, 30)), (1, prose(2, 30))], "item_id long, text string")
    docs = spark.createDataFrame([(1, prose(1, 30)), (2, f"{prose(2, 30)} {prose(5, 10)}"), (3, prose(3, 60))], "doc_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()} == {(1, 1), (2, 1)}


@pytest.mark.parametrize("hot", [(10**9, 10), (0, 10**9), (0, 0)])
def test_joins_without_broadcast_give_the_same(spark, monkeypatch, hot):
    """No gram hot, all hot and broadcast, all hot but too many."""
    from ticketlens.llm import decontaminate

    docs, items, want = _tables(spark)
    monkeypatch.setattr(decontaminate, "hot_bound", lambda total: hot[0])
    monkeypatch.setattr(decontaminate, "BROADCAST_HOT", hot[1])
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", -1)
    monkeypatch.setattr(decontaminate, "BROADCAST_CHARS", -1)
    assert {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items).collect()} == want


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, prose(4, 60)), (2, prose(2, 80)), (2, prose(2, 80))], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in contaminated(edge_docs, items).collect()}
    assert found == {(9, 1), (1, 2), (2, 2), (3, 2)}
    kept = keep_clean(edge_docs, items)
    assert kept.columns == edge_docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert None in ids and not {1, 2, 3, 9} & set(ids)
    none = items.where("item_id > 5")
    assert contaminated(edge_docs, none).collect() == [] and contaminated(no_docs, items).collect() == []
    assert keep_clean(edge_docs, none).count() == edge_docs.count()
