"""Language identification by prediction by partial matching (PPM).

Every language has a byte context tree of orders 0 to ``ORDER`` with frozen
counts over lower-cased text with every digit as 0.  The code length of a byte is that of PPM's method C: in the longest
context seen in training the byte costs -log2(count / (total + distinct)); if
it was never seen there, the escape costs -log2(distinct / (total + distinct))
and the next shorter context is asked, down to a uniform byte.  A text's
language is the one whose tree gives the shortest code; ``score`` is that
language's share of the probabilities 2**-bits.

The tree is laid out as one table per order: for every context and byte seen
in any language, the finished code length in each language.  So scoring a byte
is one lookup, and only bytes unseen in all languages go on to a shorter one.

Training reads a sample of the labelled rows: about ``SAMPLE`` rows of each of
the ``MAX_LANGUAGES`` most frequent languages (an expected number, by a hash of
the id; the bound on rows held is twice that, cut in the order of the hash),
rows of over ``SAMPLE_CHARS`` characters left out.  Prediction
covers every whole text.

Defined results: NULL texts and texts without a letter are ``und`` with score
0; so is every text if nothing is labelled; equal code lengths go to the
language first in code point order; a NULL id counts as not held out but
teaches nothing.  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, slices

ORDER = 4
SAMPLE = 500
SAMPLE_CHARS = 20_000
MAX_LANGUAGES = 64  # of a dirty label column the most frequent ones are learned
BLOCK_BYTES = 400_000
SHORT_BITS = 64
PLAIN_RATE = 8.0  # bits a byte of a text that is not coded at all
UNDETERMINED = "und"
RESULT_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double, bits_per_byte double"
_DIGITS = bytes.maketrans(b"123456789", b"000000000")
_MUL = np.uint64(0x9E3779B97F4A7C15)


class Lookup:
    """Open-addressing map from uint64 keys to row numbers, probed with arrays."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.slot = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = keys
        todo = np.arange(len(keys), dtype=np.int32)
        at = self._home(keys)
        while len(todo):
            free = self.slot[at] < 0
            self.slot[at[free]] = todo[free]  # of several for one slot the last stays
            lost = self.slot[at] != todo
            todo, at = todo[lost], (at[lost] + 1) & ((1 << self.bits) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _MUL) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 if it has none."""
        at = self._home(keys)
        row = self.slot[at]
        if not len(self.keys):
            return row
        bad = np.flatnonzero((row >= 0) & (self.keys[row] != keys))
        where = at[bad]
        while len(bad):
            where = (where + 1) & ((1 << self.bits) - 1)
            row[bad] = self.slot[where]
            still = (row[bad] >= 0) & (self.keys[row[bad]] != keys[bad])
            bad, where = bad[still], where[still]
        return row


@dataclass
class Model:
    """Per order k: rows for (context of k bytes, byte) and for contexts, by language."""

    languages: list[str]
    order: int
    seen: list[Lookup]  # (context, byte) -> row of cost
    cost: list[np.ndarray]
    contexts: list[Lookup]  # context -> row of escape
    escape: list[np.ndarray]


def _grams(data: np.ndarray, n: int) -> np.ndarray:
    """For every byte, it and the n - 1 before it as one number (zeros before the first)."""
    key = np.zeros(len(data), dtype=np.uint64)
    for j in range(n):
        key[j:] |= data[: len(data) - j].astype(np.uint64) << np.uint64(8 * j)
    return key


def _bytes(text: str) -> bytes:
    """What is coded: the text in lower case as UTF-8, every ASCII digit as 0."""
    return text.lower().encode("utf-8", "replace").translate(_DIGITS)


def _joined(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array, ``order`` zero bytes before each; the start of each."""
    pad = b"\0" * order
    data = np.frombuffer(b"".join([pad + t for t in texts]), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64) + order
    return data, np.cumsum(sizes) - sizes + order


def fit(samples: dict[str, list[str]], order: int = ORDER) -> Model:
    """Context trees of the given texts, language by language."""
    languages = sorted(samples)
    n = len(languages)
    counts = []  # per order and language: (gram, count)
    for k in range(order + 1):
        per_language = []
        for lang in languages:
            texts = [_bytes(t) for t in samples[lang]]
            data, starts = _joined(texts, order)
            inside = np.ones(len(data), dtype=bool)
            for j in range(1, order + 1):
                inside[starts - j] = False
            per_language.append(np.unique(_grams(data, k + 1)[inside], return_counts=True))
        counts.append(per_language)
    model = Model(languages, order, [], [], [], [])
    for k in range(order + 1):
        grams = np.unique(np.concatenate([g for g, _ in counts[k]])) if n else np.zeros(0, np.uint64)
        contexts = np.unique(grams >> np.uint64(8))
        # what a byte costs once this order has escaped, or does not know the context
        shorter = lower_costs(model, k, grams)
        cost = np.zeros((len(grams), n), dtype=np.float32)
        escape = np.zeros((len(contexts), n), dtype=np.float32)
        for i, (own, number) in enumerate(counts[k]):
            at = np.searchsorted(contexts, own >> np.uint64(8))
            total = np.bincount(at, number, len(contexts))
            distinct = np.bincount(at, minlength=len(contexts))
            known = distinct > 0
            escape[known, i] = -np.log2(distinct[known] / (total + distinct)[known])
            of_gram = np.searchsorted(contexts, grams >> np.uint64(8))
            cost[:, i] = escape[of_gram, i] + shorter[:, i]
            rows = np.searchsorted(grams, own)
            cost[rows, i] = -np.log2(number / (total + distinct)[at])
        model.seen.append(Lookup(grams))
        model.cost.append(cost)
        model.contexts.append(Lookup(contexts))
        model.escape.append(escape)
    return model


def lower_costs(model: Model, k: int, grams: np.ndarray) -> np.ndarray:
    """Code lengths of the grams' last bytes in the orders below ``k``."""
    if k == 0:
        return np.full((len(grams), len(model.languages)), 8.0, dtype=np.float32)
    return gram_costs(model, k - 1, grams & np.uint64((1 << (8 * k)) - 1))


def gram_costs(model: Model, k: int, grams: np.ndarray) -> np.ndarray:
    """Code length in each language of each gram's last byte after the k bytes before it."""
    row = model.seen[k].find(grams)
    out = model.cost[k][row] if len(model.cost[k]) else np.zeros((len(grams), len(model.languages)), np.float32)
    miss = np.flatnonzero(row < 0)
    if len(miss):
        some = grams[miss]
        below = lower_costs(model, k, some)
        context = model.contexts[k].find(some >> np.uint64(8))
        held = context >= 0
        below[held] += model.escape[k][context[held]]
        out[miss] = below
    return out


def code_lengths(model: Model, texts: list[str]) -> np.ndarray:
    """Bits of each text in each language (one row per text)."""
    out = np.zeros((len(texts), len(model.languages)))
    raw = [_bytes(t) for t in texts]
    for i, piece in enumerate(raw):  # a very long text is summed block by block
        if len(piece) > 2 * BLOCK_BYTES:
            for a in range(0, len(piece), BLOCK_BYTES):
                before = piece[max(0, a - model.order) : a]
                data = np.frombuffer(b"\0" * (model.order - len(before)) + before + piece[a : a + BLOCK_BYTES], np.uint8)
                out[i] += gram_costs(model, model.order, _grams(data, model.order + 1)[model.order :]).sum(0, np.float64)
            raw[i] = b""
    data, starts = _joined(raw, model.order)
    sizes = np.array([len(t) for t in raw], dtype=np.int64)
    costs = gram_costs(model, model.order, _grams(data, model.order + 1))
    for i in np.flatnonzero(sizes):
        out[i] += costs[starts[i] : starts[i] + sizes[i]].sum(0, dtype=np.float64)
    return out


def classify(model: Model, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, bits per byte) of each text."""
    letters = np.array([any(c.isalpha() for c in t) for t in texts], dtype=bool)
    n_bytes = np.array([max(1, len(_bytes(t))) for t in texts], dtype=np.float64)
    if not model.languages or not texts:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.zeros(len(texts))
    bits = code_lengths(model, texts)
    best = bits.argmin(axis=1)
    least = bits[np.arange(len(texts)), best]
    share = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000.0)).sum(axis=1)
    names = [model.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)]
    return names, np.where(letters, share, 0.0), least / n_bytes


def held_out(id_col: str) -> Column:
    """crc32 of the id as text leaves 1 modulo 3; these rows never teach."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
    sample_chars: int = SAMPLE_CHARS,
    order: int = ORDER,
) -> Model:
    """Fit the trees on a bounded sample of the rows that may teach."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & ~held_out("id"))
    rows = rows.where(F.length("text").between(1, sample_chars))
    counted = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    sizes = {r["lang"]: r["count"] for r in counted}
    rank = F.pmod(F.xxhash64(F.lit(3), "id", "text"), F.lit(1 << 30))
    chosen = F.lit(False)
    for lang, n in sorted(sizes.items()):
        chosen = chosen | ((F.col("lang") == lang) & (rank < int(min(1.0, sample / n) * (1 << 30)) + 1))
    picked = rows.where(chosen).withColumn("rank", rank).orderBy("rank", "id", F.xxhash64("text"), "lang")
    picked = picked.limit(2 * sample * max(1, len(sizes))).collect()  # what the bound cuts is last in rank
    samples: dict[str, list[str]] = {}
    for r in sorted(picked, key=lambda r: (r["rank"], r["text"])):
        samples.setdefault(r["lang"], []).append(r["text"])
    return fit({lang: texts[: 2 * sample] for lang, texts in samples.items()}, order)


def _predictor(spark: SparkSession, model: Model):
    ready_workers(spark)
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def predict(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        names: list[str] = []
        score, rate = [np.zeros(0)], [np.zeros(0)]
        for a, b in slices([len(t) for t in texts], BLOCK_BYTES):
            x, y, z = classify(shared.value, texts[a:b])
            names += x
            score.append(y)
            rate.append(z)
        return names, np.concatenate(score), np.concatenate(rate)

    return predict


def identify(docs: DataFrame, model: Model | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score, bits_per_byte of every row."""
    model = model or train(docs, id_col, text_col, lang_col)
    predict = _predictor(docs.sparkSession, model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, score, rate = predict([t or "" for t in batch.column(2).to_pylist()])
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(score), pa.array(rate)],
                ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, RESULT_SCHEMA)


def keep_identified(
    docs: DataFrame,
    model: Model | None = None,
    min_score: float = 0.5,
    max_rate: float = PLAIN_RATE,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Rows of ``docs`` whose language is identified (columns unchanged).

    The language must be likelier than all others together (``min_score``)
    and its tree must explain the text: a code of ``max_rate`` and more bits a
    byte is no shorter than the text itself, which is what letters without a
    language or in a script or language that was never learned come to.  A
    text may cost ``SHORT_BITS`` more, since a slip of the pen or two outweigh
    the rest of a very short one.
    """
    model = model or train(docs, id_col, text_col, lang_col)
    predict = _predictor(docs.sparkSession, model)

    @F.arrow_udf("boolean")
    def accepted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            texts = [t or "" for t in batch.to_pylist()]
            names, score, rate = predict(texts)
            known = np.array(names, dtype=object) != UNDETERMINED
            limit = max_rate + SHORT_BITS / np.array([max(1, len(_bytes(t))) for t in texts], dtype=np.float64)
            yield pa.array(known & (score >= min_score) & (rate < limit), pa.bool_())

    return docs.where(accepted(F.col(text_col)))
