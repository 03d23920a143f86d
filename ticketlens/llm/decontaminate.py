"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. Every word n-gram of a test item is counted over the whole corpus (in how
   many documents it occurs).  Rare seeds are the n-grams in at most
   ``SEED_FLOOR + SEED_SHARE * documents`` documents, and of every
   ``SEED_WINDOW`` consecutive n-grams of an item the rarest.  A place of one
   rare seed makes a candidate.
2. Copies so edited that no rare n-gram survives (every third word replaced,
   say) are found by pair seeds: two neighbouring words of an item that stand
   next to each other in the document, or with one word between them.  An
   alignment that scores ``threshold`` has at least ``pairs_needed`` of them,
   about a third of the item's words (see there), so a stretch with fewer is
   no candidate and none is lost.
3. The text around the places is aligned with the item by a Smith-Waterman
   local alignment over words (match 2, mismatch -1, gap -1); the score is the
   alignment's points over those of a whole copy, so edited and paraphrased
   copies keep a graded score.

Scale: documents are read twice (counts, then places and alignment in one task)
and only gram counts and results are shuffled; a task holds one block of texts.
Documents' grams pass a bit table of the seeds first (its bits are put together
in Spark; ``FILTER_WORDS`` words at most reach the driver).  Seeds and items are
broadcast only if the measured number of seeds and item characters is within
``BROADCAST_SEEDS`` and ``BROADCAST_CHARS``; otherwise joins find the (document,
item, places) and shuffle the texts of these documents.

Defined results: NULL and empty texts hit nothing; items of fewer than
``SEED_WORDS`` words take no part; rows that share an id are searched each and
give one row per item with the best score; equal scores go to the first place;
rows with a NULL id take no part.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import by_ids, hot_bound, join_hot, mix64, ready_workers, save, slices
from ticketlens.llm.words import shingle_hashes, word_hashes

SEED_WORDS = 3
SEED_WINDOW = 8
SEED_FLOOR = 10
SEED_SHARE = 0.0005
THRESHOLD = 0.5
MATCH, MISMATCH, GAP = 2, 1, 1
BLOCK_CHARS = 400_000
FILTER_BITS = 22
FILTER_WORDS = 1 << (FILTER_BITS - 6)
BROADCAST_SEEDS = 500_000
BROADCAST_CHARS = 16_000_000
BROADCAST_HOT = 500_000  # seeds of very common grams
RESULT_SCHEMA = "doc_id long, item_id long, score double, start_word long, end_word long"


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
    """(score, first word, word after the last) of the item's best local alignment in the passage.

    One row of the matrix at a time: gaps along the row are a running maximum.
    ``origin`` carries the place where the alignment through a cell began.
    """
    n = len(passage)
    if not len(item) or not n:
        return 0.0, 0, 0
    step = np.arange(n + 1, dtype=np.int64) * GAP
    score, origin = np.zeros(n + 1, dtype=np.int64), np.arange(n + 1)
    best, at, start = 0, 0, 0
    for word in item:
        diagonal = score[:-1] + np.where(passage == word, MATCH, -MISMATCH)
        above = score[1:] - GAP
        cell = np.zeros(n + 1, dtype=np.int64)
        begun = np.arange(n + 1)
        up = np.maximum(above, diagonal)
        alive = up > 0
        cell[1:][alive] = up[alive]
        begun[1:][alive] = np.where(diagonal >= above, origin[:-1], origin[1:])[alive]
        lifted = cell + step
        high = np.maximum.accumulate(lifted)
        source = np.maximum.accumulate(np.where(lifted == high, np.arange(n + 1), 0))
        across = high - step
        moved = across > cell
        cell[moved], begun[moved] = across[moved], begun[source[moved]]
        score, origin = cell, begun
        top = int(score.argmax())
        if score[top] > best:
            best, at, start = int(score[top]), top, int(origin[top])
    return best / (MATCH * len(item)), start, at


def _texts(df: DataFrame, id_col: str, text_col: str, name: str) -> DataFrame:
    rows = df.select(F.col(id_col).cast("long").alias(name), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.where(F.col(name).isNotNull())


def _item_grams(items: DataFrame, n: int) -> DataFrame:
    """(item_id, place, gram) of every n-gram of every item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, at = word_hashes(batch.column(1).to_pylist())
            for i, item in enumerate(batch.column(0).to_pylist()):
                own = words[at[i] : at[i + 1]]
                if len(own) < n:
                    continue
                grams = shingle_hashes(own, n).view(np.int64)
                yield pa.record_batch(
                    [pa.array(np.full(len(grams), item)), pa.array(np.arange(len(grams))), pa.array(grams)],
                    ["item_id", "place", "gram"],
                )

    return items.mapInArrow(run, "item_id long, place long, gram long")


def _item_pairs(items: DataFrame, threshold: float) -> DataFrame:
    """(item_id, gram, pos, need): the pair seeds of every item and how many of them a copy holds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, at = word_hashes(batch.column(1).to_pylist())
            for i, item in enumerate(batch.column(0).to_pylist()):
                gram, pos = pair_seeds(words[at[i] : at[i + 1]])
                need = np.full(len(gram), pairs_needed(int(at[i + 1] - at[i]), threshold))
                yield pa.record_batch(
                    [pa.array(np.full(len(gram), item, np.int64)), pa.array(gram.view(np.int64)), pa.array(pos), pa.array(need)],
                    ["item_id", "gram", "pos", "need"],
                )

    return items.mapInArrow(run, "item_id long, gram long, pos long, need long")


def pair_hashes(words: np.ndarray, apart: int) -> np.ndarray:
    """Hash of every word with the one ``apart`` places on; the distance is no part of it."""
    return mix64(words[:-apart] * np.uint64(0xA0761D6478BD642F) + mix64(words[apart:])) if len(words) > apart else words[:0]


def pair_seeds(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, number) of an item's pairs of neighbouring words; an item of three words has its outer two as well."""
    gram = pair_hashes(words, 1)
    if len(words) == 3:
        gram = np.concatenate([gram, pair_hashes(words, 2)])
    return gram, np.arange(len(gram), dtype=np.int64)


def pairs_needed(n: int, threshold: float) -> int:
    """The least number of an item's pair seeds in an alignment that scores ``threshold``.

    Let m of the item's n words match.  The m - 1 steps between them cost at
    most 2 m - 2 threshold n points.  A step that is no pair seed leaves out a
    word of the item (n - m of them at most, a point each) or skips two words
    and more of the document (two points each); all others are pair seeds.
    """
    least = n
    for m in range(math.ceil(threshold * n), n + 1):
        points = int(2 * m - 2 * threshold * n + 1e-9)
        skips = min(points, n - m)
        least = min(least, m - 1 - skips - (points - skips) // 2)
    return max(1, least)


def _bit_table(grams: DataFrame) -> np.ndarray:
    """Bits set for two hashes of each gram; the table's size is fixed, whatever the number of grams."""
    mask = (1 << FILTER_BITS) - 1
    places = grams.select(F.explode(F.array(F.col("gram").bitwiseAND(mask), F.shiftright("gram", 32).bitwiseAND(mask))).alias("p"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("p").bitwiseAND(63).cast("int"))
    found = places.groupBy(F.shiftright("p", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    words = np.zeros(FILTER_WORDS, dtype="<u8")
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return np.unpackbits(words.view(np.uint8), bitorder="little").astype(bool)


def _may_hold(table: np.ndarray, grams: np.ndarray) -> np.ndarray:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    hit = np.flatnonzero(table[(grams & mask).astype(np.int64)])
    return hit[table[((grams[hit] >> np.uint64(32)) & mask).astype(np.int64)]]


def _blocks(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, words, offsets) of runs of texts; text i of a run has words[at[i]:at[i + 1]]."""
    for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
        yield a, *word_hashes(texts[a:b])


def _found(grams: np.ndarray, length: int, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, place in the text, gram) of a run's grams of ``length`` words that may be seeds; none reaches over a text's end."""
    hit = _may_hold(table, grams)
    text = np.searchsorted(at, hit, "right") - 1
    inside = hit + length <= at[text + 1]
    hit, text = hit[inside], text[inside]
    return text, hit - at[text], grams[hit]


def _ngrams(words: np.ndarray, n: int) -> np.ndarray:
    return shingle_hashes(words, n) if len(words) >= n else words[:0]


def _pairs_found(words: np.ndarray, at: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    parts = [_found(pair_hashes(words, apart), apart + 1, at, table) for apart in (1, 2)]
    return tuple(np.concatenate(x) for x in zip(*parts))


def _document_counts(docs: DataFrame, table, n: int) -> DataFrame:
    """(gram, documents) for the grams that may be items' (summed in the task first)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.zeros(0, np.uint64)]
            for _, words, at in _blocks(batch.column(0).to_pylist()):
                text, _, gram = _found(_ngrams(words, n), n, at, table.value)
                order = np.lexsort((gram, text))  # a text counts once
                text, gram = text[order], gram[order]
                first = np.ones(len(gram), dtype=bool)
                first[1:] = (text[1:] != text[:-1]) | (gram[1:] != gram[:-1])
                held.append(gram[first])
            gram, number = np.unique(np.concatenate(held), return_counts=True)
            yield pa.record_batch([pa.array(gram.view(np.int64)), pa.array(number)], ["gram", "docs"])

    return docs.select("text").mapInArrow(run, "gram long, docs long").groupBy("gram").agg(F.sum("docs").alias("docs"))


def _places(docs: DataFrame, table, pair_table, n: int) -> DataFrame:
    """(doc_id, place, gram, pair) of the documents' grams that may be seeds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for first, words, at in _blocks(batch.column(1).to_pylist()):
                both = (_found(_ngrams(words, n), n, at, table.value), False), (_pairs_found(words, at, pair_table.value), True)
                for (text, place, gram), pair in both:
                    yield pa.record_batch(
                        [pa.array(ids[first + text]), pa.array(place), pa.array(gram.view(np.int64)), pa.array(np.full(len(gram), pair))],
                        ["doc_id", "place", "gram", "pair"],
                    )

    return docs.mapInArrow(run, "doc_id long, place long, gram long, pair boolean")


def seeds_of(items: DataFrame, docs: DataFrame, n: int = SEED_WORDS) -> DataFrame:
    """(item_id, gram) of the rare seeds; ``items(item_id, text)``, ``docs(doc_id, text)``."""
    spark = docs.sparkSession
    grams = save(_item_grams(items, n), "decontaminate-grams")
    table = spark.sparkContext.broadcast(_bit_table(grams))
    counts = _document_counts(docs, table, n)
    total = docs.count()
    known = grams.join(counts, "gram", "left").select("item_id", "place", "gram", F.coalesce("docs", F.lit(0)).alias("docs"))
    onward = Window.partitionBy("item_id").orderBy("place").rowsBetween(0, SEED_WINDOW - 1)
    rarest = F.min(F.struct("docs", "gram")).over(onward)["gram"]
    local = known.select("item_id", rarest.alias("gram"))
    every = known.where(F.col("docs") <= SEED_FLOOR + SEED_SHARE * total).select("item_id", "gram")
    return local.unionByName(every).distinct()


def _best(wanted: np.ndarray, words: np.ndarray, places: np.ndarray, pos: np.ndarray, need: int, n: int, threshold: float) -> tuple[float, int, int]:
    """(score, first word, word after the last) of the item's best alignment in a text.

    ``places`` (in order) are those of its seeds, ``pos`` the number of a pair
    seed and -1 for a rare n-gram.  An alignment that scores ``threshold``
    spans at most twice the item's words.
    """
    reach = 2 * len(wanted)
    rare = pos < 0
    # a pair seed counts where enough of them stand within one span
    crowded = np.zeros(len(places), dtype=bool)
    pair = np.flatnonzero(~rare)
    if len(pair) >= need:
        at = places[pair]
        upto = np.searchsorted(at, at + reach, "right")
        for k in np.flatnonzero(upto - np.arange(len(at)) >= need):
            if len(np.unique(pos[pair[k : upto[k]]])) >= need:
                crowded[pair[k : upto[k]]] = True
    chosen = places[rare | crowded]
    best = (0.0, 0, 0)
    if not len(chosen):
        return best
    for run in np.split(chosen, np.flatnonzero(np.diff(chosen) > reach) + 1):
        low = max(0, int(run[0]) - reach)
        passage = words[low : int(run[-1]) + n + reach]
        if np.isin(wanted, passage).sum() < threshold * len(wanted):
            continue  # each point comes from one of these words
        value, a, b = align(wanted, passage)
        if value > best[0]:
            best = (value, low + a, low + b)
    return best


def _record(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
    names = ["doc_id", "item_id", "score", "start_word", "end_word"]
    return pa.record_batch([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)


def _scored_in_place(given: DataFrame, seeds: DataFrame, pairs: DataFrame, items: DataFrame, tables, n: int, threshold: float) -> DataFrame:
    """Scores of all candidates, found and aligned in the task that reads the text; seeds and items are broadcast."""
    rare, pair = seeds.select("gram", "item_id").toArrow(), pairs.select("gram", "item_id", "pos", "need").toArrow()
    gram = np.concatenate([rare.column("gram").to_numpy(), pair.column("gram").to_numpy()]).view(np.uint64)
    item = np.concatenate([rare.column("item_id").to_numpy(), pair.column("item_id").to_numpy()])
    pos = np.concatenate([np.full(rare.num_rows, -1), pair.column("pos").to_numpy()]).astype(np.int64)
    order = np.argsort(gram, kind="stable")
    texts = {r["item_id"]: word_hashes([r["text"]])[0] for r in items.select("item_id", "text").collect()}
    need = dict(zip(pair.column("item_id").to_pylist(), pair.column("need").to_pylist()))
    held = given.sparkSession.sparkContext.broadcast((gram[order], item[order], pos[order], texts, need))
    table, pair_table = tables

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, item, pos, texts, need = held.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            out = []
            for first, words, at in _blocks(batch.column(1).to_pylist()):
                parts = _found(_ngrams(words, n), n, at, table.value), _pairs_found(words, at, pair_table.value)
                is_pair = np.repeat([False, True], [len(p[0]) for p in parts])
                text, place, own = (np.concatenate(x) for x in zip(*parts))
                low = np.searchsorted(gram, own)
                number = np.searchsorted(gram, own, "right") - low
                seed = np.repeat(low - np.cumsum(number) + number, number) + np.arange(number.sum())
                text, place, is_pair = (np.repeat(x, number) for x in (text, place, is_pair))
                same = (pos[seed] >= 0) == is_pair
                seed, text, place = seed[same], text[same], place[same]
                order = np.lexsort((place, item[seed], text))
                seed, text, place = seed[order], text[order], place[order]
                cuts = np.flatnonzero((np.diff(text) != 0) | (np.diff(item[seed]) != 0)) + 1
                starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(seed)]])
                if not len(seed):
                    continue
                rare_in = np.add.reduceat((pos[seed] < 0).astype(np.int64), starts)
                wants = np.array([need[i] for i in item[seed[starts]].tolist()])
                for g in np.flatnonzero((rare_in > 0) | (ends - starts >= wants)):
                    some, t = seed[starts[g] : ends[g]], text[starts[g]]
                    of = int(item[some[0]])
                    best = _best(texts[of], words[at[t] : at[t + 1]], place[starts[g] : ends[g]], pos[some], need[of], n, threshold)
                    if best[0] >= threshold:
                        out.append((ids[first + t], of, *best))
            yield _record(out)

    return given.mapInArrow(run, RESULT_SCHEMA)


def _scored_by_joins(given: DataFrame, seeds: DataFrame, pairs: DataFrame, items: DataFrame, tables, n: int, threshold: float) -> DataFrame:
    """The same scores where seeds or items are too many to broadcast."""
    wants = pairs.groupBy("item_id").agg(F.max("need").alias("need"))
    every = seeds.select("gram", "item_id", F.lit(-1).cast("long").alias("pos"), F.lit(False).alias("pair"))
    every = every.unionByName(pairs.select("gram", "item_id", "pos", F.lit(True).alias("pair")))
    places = save(_places(given, *tables, n), "decontaminate-places")
    every = every.join(places.groupBy("gram", "pair").agg(F.count(F.lit(1)).alias("n")), ["gram", "pair"])
    every = save(every, "decontaminate-weighted")
    bound = hot_bound(places.count())  # the places of a very common gram stay where they are
    if every.where(F.col("n") > bound).count() > BROADCAST_HOT:
        bound = places.count()  # too many items share the common grams: a shuffle, cut by AQE where it is skewed
    hits = join_hot(places, every, ["gram", "pair"], "n", bound).groupBy("doc_id", "item_id")
    hits = hits.agg(
        F.sort_array(F.collect_set(F.struct("place", "pos"))).alias("places"),
        F.max(F.col("pos") < 0).alias("rare"), F.count_distinct("pos").alias("n_pairs"),
    )
    hits = hits.join(wants, "item_id").where(F.col("rare") | (F.col("n_pairs") >= F.col("need")))
    hits = save(hits.select("doc_id", "item_id", "places", "need"), "decontaminate-hits")
    found = by_ids(given, hits.select("doc_id"), "doc_id").join(hits, "doc_id")
    both = found.join(items.select("item_id", F.col("text").alias("item")), "item_id")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, item_id, text, places, pos, item, need in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                wanted, words = word_hashes([item])[0], word_hashes([text])[0]
                best = _best(wanted, words, np.array(places), np.array(pos), need, n, threshold)
                if best[0] >= threshold:
                    out.append((doc, item_id, *best))
            yield _record(out)

    return both.select("doc_id", "item_id", "text", "places.place", "places.pos", "item", "need").mapInArrow(score, RESULT_SCHEMA)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    n: int = SEED_WORDS,
) -> DataFrame:
    """One row per document and test item whose alignment scores ``threshold`` or more.

    ``start_word`` and ``end_word`` bound the copy in the document's words.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    given = _texts(docs, id_col, text_col, "doc_id")
    # every distinct text of an item is searched by itself, under a number of its own
    named = _texts(benchmark, item_col, item_text_col, "name").distinct()
    named = save(named.withColumn("item_id", F.monotonically_increasing_id()), "decontaminate-items")
    items = named.select("item_id", "text")
    seeds = save(seeds_of(items, given, n), "decontaminate-seeds")
    pairs = save(_item_pairs(items.join(seeds.select("item_id").distinct(), "item_id", "left_semi"), threshold), "decontaminate-pairs")
    tables = [spark.sparkContext.broadcast(_bit_table(t)) for t in (seeds, pairs)]
    n_chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    few = seeds.count() + pairs.count() <= BROADCAST_SEEDS and n_chars <= BROADCAST_CHARS
    scored = (_scored_in_place if few else _scored_by_joins)(given, seeds, pairs, items, tables, n, threshold)
    best = F.max(F.struct("score", (-F.col("start_word")).alias("first"), "end_word")).alias("best")
    names = named.select("item_id", "name")
    scored = scored.join(F.broadcast(names) if few else names, "item_id")
    return scored.groupBy("doc_id", "name").agg(best).select(
        "doc_id", F.col("name").alias("item_id"), "best.score", (-F.col("best.first")).alias("start_word"), "best.end_word"
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Rows of ``docs`` that hold no copy of a test item (columns unchanged; NULL ids stay)."""
    found = save(contaminated(docs, benchmark, id_col, **options).select(F.col("doc_id").alias("found")).distinct(), "contaminated")
    return by_ids(docs, found, id_col, "left_anti")
