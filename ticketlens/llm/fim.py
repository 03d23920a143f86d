"""Fill-in-middle texts, cut by unit numbers found with word-parallel bit arithmetic.

A unit is a run of ASCII letters or one other code point.  The UTF-8 bytes of
a whole batch of texts are viewed as uint64, eight bytes a word.  A byte ends
a unit if the next byte is no part of the same unit; arithmetic on whole words
sets the top bit of exactly those bytes (``unit_ends``).  ``np.bitwise_count``
gives the ends per word, their running sum the word that holds the k-th end
(``searchsorted``), and ``select_in_word`` its place in that word.  So a cut
costs one search, and nothing is done per unit or per character in Python.

The cut points, the form (plain, psm, spm) and so the output follow from the
id and the text alone: reruns and any partitioning give the same rows.

Output: plain, the text; psm, ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
spm, ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.  A text that holds one of
the markers stays plain, so ``restored`` finds each marker once: a marker
starts with ``<`` only, so none can arise across the seam of a part and a
marker either.

A task holds one Arrow batch at a time, cut into blocks of about
``BLOCK_BYTES`` (one text at least); whole texts, no shuffle.

Defined results: NULL and empty texts have no unit and stay plain, the output
being the empty text; a NULL id is hashed as the empty text; rows that share
an id are each transformed; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM = 90  # h3 % 100 from here on: plain
SPM_BELOW = 20  # h4 % 100 below this: spm
BLOCK_BYTES = 8 << 20
RESULT_SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"

_EACH = np.uint64(0x0101010101010101)
_TOP = np.uint64(0x8080808080808080)
_LOW7 = np.uint64(0x7F7F7F7F7F7F7F7F)
_CASE = np.uint64(0x2020202020202020)


def _at_least(low7: np.ndarray, limit: int) -> np.ndarray:
    """Top bit of each byte whose low seven bits are ``limit`` or more (no carry leaves a byte)."""
    return (low7 + _EACH * np.uint64(128 - limit)) & _TOP


def letters(words: np.ndarray) -> np.ndarray:
    """Top bit of each byte that is an ASCII letter."""
    low = (words | _CASE) & _LOW7
    return _at_least(low, ord("a")) & ~_at_least(low, ord("z") + 1) & ~words & _TOP


def continuations(words: np.ndarray) -> np.ndarray:
    """Top bit of each byte 10xxxxxx."""
    return words & ~(words << np.uint64(1)) & _TOP


def _of_next_byte(marks: np.ndarray) -> np.ndarray:
    """Each byte's mark moved to the byte before it (little-endian: the lower one)."""
    moved = marks >> np.uint64(8)
    moved[:-1] |= marks[1:] << np.uint64(56)
    return moved


def as_words(data: np.ndarray) -> np.ndarray:
    """The bytes as little-endian uint64 words, zeros at the end."""
    padded = np.zeros(len(data) // 8 * 8 + 8, dtype=np.uint8)
    padded[: len(data)] = data
    return padded.view("<u8").astype(np.uint64, copy=False)


def unit_ends(words: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Top bit of each byte that ends a unit; ``last`` are the places of the texts' last bytes."""
    letter = letters(words)
    next_letter = _of_next_byte(letter)
    next_inside = _of_next_byte(continuations(words))
    ends = (letter & ~next_letter) | (~letter & ~next_inside & _TOP)
    # a text's last byte ends a unit whatever the next text starts with
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) << 3).astype(np.uint64))
    return ends


class Ranks:
    """Rank and select over the marked bytes of a run of words."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, place: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word, byte = place >> 3, (place & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte << np.uint64(3))) - np.uint64(1)  # the bytes under the place
        return self.upto[word] + np.bitwise_count(self.marks[word] & below)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Place of the k-th marked byte, counted from 1."""
        word = np.searchsorted(self.upto, k, side="left") - 1
        return word * 8 + select_in_word(self.marks[word], k - self.upto[word])


def select_in_word(word: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Byte of the r-th set top bit (from 1): halves of the word are left out by their counts."""
    byte = np.zeros(len(word), dtype=np.int64)
    r = r.astype(np.int64)
    for half in (4, 2, 1):
        low = (word >> (byte << 3).astype(np.uint64)) & np.uint64((1 << (8 * half)) - 1)
        count = np.bitwise_count(low).astype(np.int64)
        up = r > count
        r = np.where(up, r - count, r)
        byte = np.where(up, byte + half, byte)
    return byte


def seeds(ids: list[int | None]) -> np.ndarray:
    """h1 to h4 of each id, one row per id."""
    text = b"".join(hashlib.sha256(f"1:{'' if i is None else i}".encode()).digest()[:16] for i in ids)
    return np.frombuffer(text, dtype=">u4").reshape(-1, 4).astype(np.int64)


def transform(ids: list[int | None], texts: list[bytes]) -> dict[str, list]:
    """Columns of the result for the texts (UTF-8)."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    end = np.cumsum(size)
    start = end - size
    words = as_words(np.frombuffer(b"".join(texts), dtype=np.uint8))
    ends = Ranks(unit_ends(words, end[size > 0] - 1))
    chars = Ranks(~continuations(words) & _TOP)
    before = ends.rank(start)
    n = ends.rank(end) - before
    h = seeds(ids)
    cut = np.sort(h[:, :2] % (n + 1)[:, None], axis=1)
    # a cut after k units is behind the k-th end of the text, or at its start
    place = np.repeat(start[:, None], 2, axis=1)
    inside = cut > 0
    place[inside] = ends.select((before[:, None] + cut)[inside]) + 1
    first, second = place[:, 0], place[:, 1]
    prefix_chars = chars.rank(first) - chars.rank(start)
    middle_chars = chars.rank(second) - chars.rank(first)
    markers = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    out: dict[str, list] = {k: [] for k in ("form", "prefix_chars", "middle_chars", "output")}
    for i, text in enumerate(texts):
        if not text or h[i, 2] % 100 >= PLAIN_FROM or any(m in text for m in markers):
            row = ("plain", None, None, text)
        else:
            a, b = first[i] - start[i], second[i] - start[i]
            prefix, middle, suffix = text[:a], text[a:b], text[b:]
            p, s, m = markers
            spm = h[i, 3] % 100 < SPM_BELOW
            output = b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle))
            row = ("spm" if spm else "psm", int(prefix_chars[i]), int(middle_chars[i]), output)
        for column, value in zip(out.values(), row):
            column.append(value)
    return {"n": n.tolist(), **out}


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output text of every row."""
    ready_workers(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], BLOCK_BYTES):
                made = transform(ids[a:b], texts[a:b])
                yield pa.record_batch(
                    [
                        pa.array(ids[a:b], pa.int64()),
                        pa.array(made["n"], pa.int64()),
                        pa.array(made["form"], pa.string()),
                        pa.array(made["prefix_chars"], pa.int64()),
                        pa.array(made["middle_chars"], pa.int64()),
                        pa.array(made["output"], pa.binary()).view(pa.string()),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    # bytes, so that the texts reach numpy without a detour over Python strings
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, RESULT_SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text an output was made of, read from its markers."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")  # '' before the first marker, then three parts
    return (
        F.when(form == "psm", F.concat(F.get(part, F.lit(1)), F.get(part, F.lit(3)), F.get(part, F.lit(2))))
        .when(form == "spm", F.concat(F.get(part, F.lit(2)), F.get(part, F.lit(3)), F.get(part, F.lit(1))))
        .otherwise(output)
    )


def fill_in_middle_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``fill_in_middle`` with hashes of the output and of the text restored from it."""
    made = fill_in_middle(docs, id_col, text_col)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"),
    )
