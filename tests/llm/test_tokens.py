"""Token files: codec round trip, random access, equality with the library, edge rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from llm_fixtures import edge_docs, edge_rows, no_docs  # noqa: F401
from tokenizers import Tokenizer as Library

from ticketlens.llm import dac
from ticketlens.llm.tokens import END_ID, VOCABULARY, Tokenizer, token_table

ODD = [
    "", "  ", "don't stop", "It's, ok. l'été, ÇA İstanbul ΣΑΣ. <|endoftext|> a<|endoftext|>b x", "áb é  x y \x1c z\x85w",
    "tab\tnl\r\nq", "1234.5, 3,4.", "A.B. c,, d., ﬁ ǅ ª º ß ſ K", "한국어, 日本語。 ไทย, हिन्दी. café, CAFÉ.", "I'll, 'S 'T. ’s, we've.",
    "a%%% b### c*** d&&&, (x). [y], z', q's. w''. k-l-. é%%%, ç. 1%%%", "\U0001f600a, b\U0001f600.", "Der Öl, ÄÖÜ. Straße!!",
]


@pytest.fixture(scope="module")
def library():
    return Library.from_file(public_tokenizers.path(VOCABULARY))


@pytest.mark.parametrize("ids", [[], [0], [255], [256], [1, 70_000, 2**32 - 1, 5], list(range(0, 3000, 7)) * 3])
def test_codec_round_trip_and_random_access(ids):
    ids = np.array(ids, dtype=np.uint32)
    cut = len(ids) // 3
    segment = dac.Segment(dac.encode_segment([7, None, 9], np.array([cut, 0, len(ids) - cut]), ids))
    assert segment.all_ids().tolist() == ids.tolist()
    assert [segment.token(i) for i in range(len(ids))] == ids.tolist()
    assert segment.doc_ids == [7, None, 9]
    assert segment.offsets.tolist() == [0, cut, cut, len(ids)]
    with pytest.raises(IndexError):
        segment.token(len(ids))


def test_codec_rejects_other_bytes():
    with pytest.raises(ValueError):
        dac.Segment(b"x" * 64)


@pytest.mark.parametrize("cache", [1_000_000, 4])
def test_tokenizer_equals_library(library, cache):
    tokenizer = Tokenizer(cache_words=cache)
    for _ in range(2):  # the second time from the table
        for text in ODD:
            ids, counts = tokenizer.encode([text], None)
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
    ids, counts = tokenizer.encode(ODD)
    want = [library.encode(t, add_special_tokens=False).ids + [END_ID] for t in ODD]
    assert counts.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


def test_token_table_edge_rows(edge_docs, edge_rows, library):
    got = sorted((tuple(r) for r in token_table(edge_docs, segment_tokens=5000).collect()), key=lambda r: r[1])
    order = sorted(edge_rows, key=lambda r: (r[0] is not None, r[0] or 0))
    at = 0
    for row, (doc_id, text, *_) in zip(got, order, strict=True):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [END_ID], dtype="<u4")
        assert row == (doc_id, at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_table_empty(no_docs):
    assert token_table(no_docs).collect() == []
