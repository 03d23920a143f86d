"""Token-ID / binary output: tokenise documents into segment files, read them back.

``write_tokens`` range-partitions the documents by id, so the files hold the
whole corpus in ascending id order; each task tokenises its rows and writes
segments of a bounded number of ids (``dac`` describes the format).  A file is
written under an attempt's own name and then renamed, and the manifest lists
only files of finished tasks, so a lost executor leaves no wrong result.
``read_tokens`` reads the files with Spark's ``binaryFile`` source.

Files are written through ``pyarrow.fs`` (file, hdfs, s3, gs paths).

Defined results: a NULL text is the empty text (its only id is the end id);
rows with a NULL id come first; rows that share an id are written each, in the
order of their text's hash; an empty table gives no files and an empty result.
Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ticketlens.llm import dac
from ticketlens.llm.common import ready_workers, scratch_path, slices
from ticketlens.llm.words import span_hashes, spans

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SEGMENT_TOKENS = 4_000_000
BLOCK_BYTES = 400_000
CACHE_WORDS = 300_000

MANIFEST_SCHEMA = "file string, part int, seq int, n_docs long, n_tokens long"
DOCS_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


_GAP = np.zeros(256, dtype=bool)
_GAP[[0x20, 0x09, 0x0A, 0x0D]] = True
_MARK = np.zeros(256, dtype=bool)  # ASCII punctuation but the apostrophe, which may tie letters to it
for _a, _b in ((0x21, 0x27), (0x28, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)):
    _MARK[_a:_b] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SMALL = np.arange(256, dtype=np.uint8)
_SMALL[0x41:0x5B] += 0x20


class Tokenizer:
    """Ids of whole texts; a word seen before is looked up, not encoded again.

    The vocabulary drops case and white space and no piece spans white space,
    so a text's ids are its words' ids in order.  The marks that end a word
    after a letter are a piece of their own and are looked up as one.  Words are
    known by two 64-bit hashes in a table of arrays; the first ``CACHE_WORDS``
    stay from block to block, others are encoded again in later blocks.
    """

    def __init__(self, path: str | None = None, cache_words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer as Library

        self.library = Library.from_file(path or public_tokenizers.path(VOCABULARY))
        names = sorted(self.library.get_vocab().items(), key=lambda x: x[1])
        self.ends_word = np.array([t.endswith("</w>") for t, _ in names], dtype=bool)
        self.capacity = cache_words
        self.bits = max(8, (2 * cache_words).bit_length())
        self.slot = np.full(1 << self.bits, -1, dtype=np.int32)
        self.n = 0
        self.key = np.zeros(0, dtype=np.uint64)
        self.check = np.zeros(0, dtype=np.uint64)
        self.start = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _find(self, key: np.ndarray, check: np.ndarray) -> np.ndarray:
        """Number of each known word, -1 for others (linear probing, all words at once)."""
        found = np.full(len(key), -1, dtype=np.int64)
        todo = np.arange(len(key))
        at = (key >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(todo):
            number = self.slot[at]
            held = number >= 0
            todo, at, number = todo[held], at[held], number[held]
            same = (self.key[number] == key[todo]) & (self.check[number] == check[todo])
            found[todo[same]] = number[same]
            todo, at = todo[~same], (at[~same] + 1) & ((1 << self.bits) - 1)
        return found

    def _keep(self, first: int) -> None:
        """Enter the words from number ``first`` on in the table."""
        slot, mask = self.slot, (1 << self.bits) - 1
        for i, at in enumerate((self.key[first:] >> np.uint64(64 - self.bits)).tolist(), first):
            while slot[at] >= 0:
                at = (at + 1) & mask
            slot[at] = i

    def _encode_words(self, words: list[str]) -> list[list[int]]:
        out: list = [None] * len(words)
        joint, single = [], []
        for i, w in enumerate(words):
            if not w.isalpha():
                single.append(i)
            elif w.isascii() and w.islower():  # all letters: one piece
                out[i] = [t.id for t in self.library.model.tokenize(w)]
            else:
                joint.append(i)
        for a in range(0, len(joint), 200):
            some = joint[a : a + 200]
            ids = self.library.encode(" ".join([words[i] for i in some]), add_special_tokens=False).ids
            border = np.flatnonzero(self.ends_word[ids]) + 1
            if len(border) != len(some):  # not one piece each
                single += some
                continue
            for i, x, y in zip(some, [0, *border[:-1].tolist()], border.tolist()):
                out[i] = ids[x:y]
        for i, e in zip(single, self.library.encode_batch([words[i] for i in single], add_special_tokens=False)):
            out[i] = e.ids
        return out

    def encode(self, texts: list[str], end_id: int | None = END_ID) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, number of ids of each), the end id included."""
        if not texts:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        parts = [t.encode("utf-8", "replace") for t in texts]
        raw = b"\n".join(parts) + b"\n"
        data = np.frombuffer(raw, dtype=np.uint8)
        gap = _GAP[data]
        starts, ends = spans(gap)
        if b"<|" not in raw:  # else it may be a special token, which tells case and is no run of marks
            mark = _MARK[data]
            cut = np.flatnonzero(mark[1:] & _LETTER[data[:-1]]) + 1
            other = np.flatnonzero(~mark)
            cut = cut[gap[other[np.searchsorted(other, cut)]]]
            data = _SMALL[data]
            starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
        key, check = span_hashes(data, starts, ends), span_hashes(data, starts, ends, 0xA24BAED4963EE407)
        number = self._find(key, check)
        known, known_ids = self.n, len(self.ids)
        missing = np.flatnonzero(number < 0)
        if len(missing):
            order = missing[np.lexsort((check[missing], key[missing]))]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (key[order[1:]] != key[order[:-1]]) | (check[order[1:]] != check[order[:-1]])
            number[order] = known + np.cumsum(new) - 1
            first = order[new]
            text = data.tobytes()
            spelled = [text[a:b].decode("utf-8") for a, b in zip(starts[first].tolist(), ends[first].tolist())]
            lists = self._encode_words(spelled)
            count = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            self.start = np.concatenate([self.start[:known], known_ids + np.cumsum(count) - count])
            self.count = np.concatenate([self.count[:known], count])
            self.ids = np.concatenate([self.ids, np.fromiter((i for x in lists for i in x), np.uint32, count.sum())])
            if known + len(first) <= self.capacity:
                self.key = np.concatenate([self.key, key[first]])
                self.check = np.concatenate([self.check, check[first]])
                self.n += len(first)
                self._keep(known)
        count = self.count[number]
        upto = np.zeros(len(number) + 1, dtype=np.int64)
        np.cumsum(count, out=upto[1:])
        flat = self.ids[np.repeat(self.start[number] - upto[:-1], count) + np.arange(upto[-1])]
        bounds = np.cumsum([len(p) + 1 for p in parts])
        ends_at = upto[np.searchsorted(starts, bounds)]
        per_text = np.diff(ends_at, prepend=0)
        if self.n == known:  # this block's new words do not stay
            self.start, self.count, self.ids = self.start[:known], self.count[:known], self.ids[:known_ids]
        if end_id is None:
            return flat, per_text
        return np.insert(flat, ends_at, np.uint32(end_id)), per_text + 1


_loaded: dict[str | None, Tokenizer] = {}


def _tokenizer(path: str | None) -> Tokenizer:
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def _filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:"):
        uri = "/" + uri[len("file:") :].lstrip("/")
    return pyarrow.fs.FileSystem.from_uri(uri)


def _put(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Write under the attempt's own name, then rename: a reader sees whole files only."""
    fs, path = _filesystem(folder)
    fs.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{attempt}"
    with fs.open_output_stream(part) as out:
        out.write(data)
    fs.move(part, f"{path}/{name}")


def write_tokens(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> DataFrame:
    """Tokenise ``docs`` into ``folder`` and return the manifest with each file's first token."""
    spark = docs.sparkSession
    ready_workers(spark)

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        part, attempt, seq = ctx.partitionId(), ctx.taskAttemptId(), 0
        encoder = _tokenizer(vocabulary)
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        n_held = 0

        def flush() -> pa.RecordBatch:
            nonlocal held, n_held, seq
            doc_ids = [d for x in held for d in x[0]]
            counts = np.concatenate([x[1] for x in held])
            name = f"segment-{part:07d}-{seq:05d}.dac"
            _put(folder, name, dac.encode_segment(doc_ids, counts, np.concatenate([x[2] for x in held])), attempt)
            row = {"file": [name], "part": [part], "seq": [seq], "n_docs": [len(doc_ids)], "n_tokens": [n_held]}
            held, n_held, seq = [], 0, seq + 1
            types = [pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            return pa.record_batch([pa.array(v, t) for v, t in zip(row.values(), types)], list(row))

        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in slices([len(t) for t in texts], BLOCK_BYTES):
                flat, counts = encoder.encode(texts[a:b], end_id)
                held.append((ids[a:b], counts, flat))
                n_held += len(flat)
                if n_held >= segment_tokens:
                    yield flush()
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text").asc()]
    manifest = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, MANIFEST_SCHEMA)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest")
    return manifest_of(spark, folder)


def manifest_of(spark: SparkSession, folder: str) -> DataFrame:
    """The segments of ``folder`` with the global number of their first token (one row per file)."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    listed = spark.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")
    return listed.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32."""
    ready_workers(spark)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, first in zip(batch.column(0), batch.column(1).to_pylist()):
                segment = dac.Segment(content.as_buffer().to_pybytes())
                flat = segment.all_ids().astype("<u4")
                raw, at = memoryview(flat).cast("B"), segment.offsets
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.record_batch(
                    [
                        pa.array(segment.doc_ids, pa.int64()),
                        pa.array(at[:-1] + first, pa.int64()),
                        pa.array(np.diff(at), pa.int64()),
                        pa.array(crc, pa.int64()),
                    ],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    manifest = manifest_of(spark, folder)
    if not manifest.take(1):
        return spark.createDataFrame([], DOCS_SCHEMA)
    files = (
        spark.read.format("binaryFile")
        .load(f"{folder}/*.dac")
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    return (
        files.join(manifest.select("file", "first_token"), "file")
        .select("content", "first_token")
        .mapInArrow(read, DOCS_SCHEMA)
    )


def token_table(docs: DataFrame, folder: str | None = None, **options) -> DataFrame:
    """Write ``docs`` as token files and return what reading the files back gives."""
    folder = folder or scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, folder, **options)
    return read_tokens(docs.sparkSession, folder)
