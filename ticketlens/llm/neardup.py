"""Near-duplicate documents by DartMinHash.

Signatures.  An element (a distinct word shingle) of weight x owns the region
[0, x) x [0, inf) of a weight-rank plane in which hashing throws darts with
density one; every document sees the same darts of an element.  A dart also
hashes to one of ``k`` coordinates, and each coordinate keeps the dart of the
earliest rank inside the document's regions.  Two documents keep the same
dart in a coordinate with the probability of their weighted Jaccard
similarity.  Only ranks up to about (ln k + 4) k / (sum of weights) are
thrown, so the work is O(elements + k log k); a document that leaves a
coordinate empty is thrown again with twice the rank.

Production weights are 1 (plain Jaccard of the shingle sets, five words,
0.8 or more); ``weights="count"`` takes the shingle counts.

Grouping, without listing the pairs of a group:

1. documents with the same weighted shingle set are one class at once; the
   smallest id stands for them (aggregated before the shuffle);
2. bands of ``rows`` coordinates are hashed; of every bucket the member that
   meets most others over all its buckets is the hub (in a group of copies,
   the text they come from), and each member is compared with it by exact
   similarity;
3. components of the links found are labelled; documents of a bucket that
   still holds several components get finer bands, which texts that only
   share a passage hardly meet in, and the members of a fine bucket outside
   its largest component are compared with all members of other components
   whose sketch (two bits per coordinate) could be that similar.
   So a link that no hub showed is not lost, and the pairs of a large group
   of copies are never listed.

Hot keys (a bucket, hub or digest with more than a thousandth of all rows) are
joined where their rows are, against a broadcast of bounded size.

Defined results: a text without words (NULL, empty, blank) is alone in its
class; texts of fewer than five words are one shingle; rows with a NULL id
get a NULL class and take no part.  Rows that share an id are one document and
share a class, each of its texts with its own links; ``keep_one_each`` groups
the texts themselves and loses none of them.  An empty table gives an empty result.  Other columns are not
read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from ticketlens.llm.common import BROADCAST_IDS, by_ids, hot_bound, join_hot, mix64, ready_workers, save, slices
from ticketlens.llm.graph import components
from ticketlens.llm.words import shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS = 40  # a pair of similarity 0.8 shares none of them with a chance of 5e-6
ROWS = 6
FINE_BANDS = 96  # the same for the finer bands: 2e-5
FINE_ROWS = 10
BLOCK_CHARS = 400_000
HUB_BYTES = 1 << 15  # of a broadcast shingle set
SKETCH_SIGMAS = 4.5
SIGNATURE_SCHEMA = "doc_id long, digest binary, weight double, bands array<long>, sketch array<long>"

_U = np.uint64
# cumulative Poisson(1) probabilities: how many darts a cell of area 1 gets
_POISSON = np.cumsum([math.exp(-1) / math.factorial(n) for n in range(18)])


def _unit(h: np.ndarray) -> np.ndarray:
    """Hashes as numbers in [0, 1)."""
    return (h >> _U(11)).astype(np.float64) * 2.0**-53


def darts(elements: np.ndarray, weights: np.ndarray, rank: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(dart ids, ranks) of all darts in the elements' regions below ``rank``.

    The plane is cut into cells of area 1: weight band 0 is [0, 1), band v is
    [2**(v-1), 2**v), and a band of width w has cells of height 1 / w.  A cell
    holds a Poisson(1) number of darts at hashed places.
    """
    out_id, out_rank = [np.zeros(0, _U)], [np.zeros(0)]
    band, low, width = 0, 0.0, 1.0
    todo = np.arange(len(elements))
    while len(todo):
        heights = math.ceil(rank * width)
        own = np.repeat(elements[todo], heights)
        weight = np.repeat(weights[todo], heights)
        level = np.tile(np.arange(heights, dtype=np.uint64), len(todo))
        cell = mix64(own ^ mix64(level * _U(0x9FB21C651E98DF25) + _U((band + 1) * 0xD1B54A32D192ED03 + seed & (2**64 - 1))))
        n = np.searchsorted(_POISSON, _unit(mix64(cell + _U(1))), side="right")
        hit = np.flatnonzero(n)
        n = n[hit]
        which = np.repeat(hit, n)
        number = (np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)).astype(np.uint64)
        dart = mix64(cell[which] + _U(2) + number * _U(0xC2B2AE3D27D4EB4F))
        place = low + width * _unit(mix64(dart + _U(3)))
        at = (level[which].astype(np.float64) + _unit(mix64(dart + _U(4)))) / width
        inside = (place < weight[which]) & (at < rank)
        out_id.append(dart[inside])
        out_rank.append(at[inside])
        low, width, band = low + width, (1.0 if band == 0 else 2 * width), band + 1
        todo = todo[weights[todo] > low]
    return np.concatenate(out_id), np.concatenate(out_rank)


def signature(elements: np.ndarray, weights: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """The earliest dart of each of ``k`` coordinates (uint64 ids)."""
    total = float(weights.sum())
    if not total > 0:
        raise ValueError("a signature needs a positive weight")
    rank = (math.log(k) + 4) / total * k
    while True:
        ids, ranks = darts(elements, weights, rank, seed)
        order = np.argsort(-ranks, kind="stable")  # the earliest is written last
        coordinate = (ids[order] % _U(k)).astype(np.int64)
        out = np.zeros(k, dtype=_U)
        filled = np.zeros(k, dtype=bool)
        out[coordinate] = ids[order]
        filled[coordinate] = True
        if filled.all():
            return out
        rank *= 2


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One int64 per band of ``rows`` coordinates; the band's number is part of it."""
    parts = sig.reshape(bands, rows)
    h = np.arange(bands, dtype=np.uint64) * _U(0x9E3779B97F4A7C15)
    for j in range(rows):
        h = mix64(h * _U(0xFF51AFD7ED558CCD) + parts[:, j])
    return h.view(np.int64)


def sketch(sig: np.ndarray) -> np.ndarray:
    """Two bits of every coordinate, 32 coordinates in an int64."""
    two = np.zeros(-(-len(sig) // 32) * 32, dtype=_U)
    two[: len(sig)] = (sig >> _U(40)) & _U(3)
    return (two.reshape(-1, 32) << (_U(2) * np.arange(32, dtype=_U))).sum(axis=1, dtype=_U).view(np.int64)


def _unlike(a: str, b: str, k: int) -> Column:
    """In how many of ``k`` coordinates two sketches differ."""
    parts = []
    for i in range(-(-k // 32)):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        parts.append(F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))))
    return functools.reduce(lambda x, y: x + y, parts)


def most_unlike(threshold: float, k: int) -> int:
    """In how many of ``k`` sketch coordinates a pair of the similarity may differ, but for a chance of 4e-6."""
    p = threshold + (1 - threshold) / 4
    return math.ceil((1 - p + SKETCH_SIGMAS * math.sqrt(p * (1 - p) / k)) * k)


def weighted_shingles(words: np.ndarray, size: int, weights: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their weights."""
    if weights == "count":
        elements, n = np.unique(shingle_hashes(words, size), return_counts=True)
        return elements, n.astype(np.float64)
    elements = np.unique(shingle_hashes(words, size))
    return elements, np.ones(len(elements))


def digest(elements: np.ndarray, weights: np.ndarray) -> bytes:
    """128 bits of a weighted shingle set, whatever its order."""
    mixed = mix64(elements ^ mix64(weights.view(np.uint64)))
    return mixed.sum().tobytes() + mix64(mixed).sum().tobytes()


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard of two shingle sets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    return both / float(a[1].sum() + b[1].sum() - both)


def _sets(texts: list[str], size: int, weights: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for a, b in slices([len(t) for t in texts], BLOCK_CHARS):
        words, at = word_hashes(texts[a:b])
        for i in range(b - a):
            yield weighted_shingles(words[at[i] : at[i + 1]], size, weights)


def signatures(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    weights: str = "binary",
    sketches: bool = False,
) -> DataFrame:
    """doc_id, digest of the weighted shingle set, its weight, band hashes, sketch (NULL id or no word: no row)."""
    ready_workers(docs.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = batch.column(1).to_pylist()
            keep, digests, weight, hashes, sketched = [], [], [], [], []
            for i, (elements, w) in enumerate(_sets(texts, size, weights)):
                if not len(elements):
                    continue
                keep.append(ids[i])
                digests.append(digest(elements, w))
                weight.append(float(w.sum()))
                sig = signature(elements, w, bands * rows)
                hashes.append(band_hashes(sig, bands, rows))
                sketched.append(sketch(sig).tolist() if sketches else None)
            flat = pa.array(np.concatenate(hashes) if hashes else np.zeros(0, np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * bands), flat)
            yield pa.record_batch(
                [pa.array(keep, pa.int64()), pa.array(digests, pa.binary()), pa.array(weight, pa.float64()), lists, pa.array(sketched, pa.list_(pa.int64()))],
                ["doc_id", "digest", "weight", "bands", "sketch"],
            )

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return given.where(F.col("doc_id").isNotNull()).mapInArrow(run, SIGNATURE_SCHEMA)


def _verified(pairs: DataFrame, texts_of: Callable[[DataFrame], DataFrame], size: int, weights: str, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts have the similarity; shingle sets travel, not texts.

    A node of very many pairs (a hub) is the second one to be looked up, and
    its set is broadcast if it is of at most ``HUB_BYTES``: it is not copied
    into a row of the shuffle per pair.
    """

    def shingled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (elements, w) in zip(batch.column(0).to_pylist(), _sets(batch.column(1).to_pylist(), size, weights)):
                counts = w.tobytes() if weights == "count" else None
                yield pa.record_batch(
                    [pa.array([i], pa.int64()), pa.array([elements.tobytes()], pa.binary()), pa.array([counts], pa.binary())],
                    ["id", "elements", "counts"],
                )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(elements, counts):
            e = np.frombuffer(elements.as_buffer(), np.uint64)
            return e, np.ones(len(e)) if counts.as_py() is None else np.frombuffer(counts.as_buffer(), np.float64)

        for batch in batches:
            good = [
                similarity(side(batch.column(2)[i], batch.column(3)[i]), side(batch.column(4)[i], batch.column(5)[i])) >= threshold
                for i in range(batch.num_rows)
            ]
            yield pa.record_batch([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    n_pairs = pairs.count()
    nodes = save(pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n")), "neardup-nodes")
    # rows that repeat a text give equal sets
    sets = texts_of(nodes.select("node")).mapInArrow(shingled, "id long, elements binary, counts binary")
    sets = sets.groupBy("id").agg(F.min(F.struct("elements", "counts")).alias("s")).select("id", "s.elements", "s.counts")
    sets = save(sets, "neardup-sets")
    hot = nodes.where(F.col("n") > hot_bound(2 * n_pairs)).select(F.col("node").alias("id"))
    hubs = sets.where(F.length("elements") <= HUB_BYTES).join(F.broadcast(hot), "id")  # a bounded number of bounded sets
    hubs = save(hubs, "neardup-hubs")

    def named(some: DataFrame, name: str) -> DataFrame:
        return some.select(F.col("id").alias(name), F.col("elements").alias(f"e{name}"), F.col("counts").alias(f"c{name}"))

    is_hub = hubs.select(F.col("id").alias("b"), F.lit(True).alias("hub"))
    turned = pairs.join(F.broadcast(is_hub), "b", "left")
    turned = turned.select(
        F.when(F.col("hub"), F.col("b")).otherwise(F.col("a")).alias("x"), F.when(F.col("hub"), F.col("a")).otherwise(F.col("b")).alias("y")
    )
    # the pairs of a hub x meet the other set by a shuffle on y and the hub's where they are
    of_hub = turned.join(F.broadcast(hubs.select(F.col("id").alias("x"))), "x", "left_semi")
    others = turned.join(F.broadcast(hubs.select(F.col("id").alias("x"))), "x", "left_anti")
    both = of_hub.join(named(sets, "y"), "y").join(F.broadcast(named(hubs, "x")), "x")
    both = both.unionByName(others.join(named(sets, "y"), "y").join(named(sets, "x"), "x"))
    both = both.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "ex", "cx", "ey", "cy")
    return both.mapInArrow(compare, "a long, b long")


def _labelled(members: DataFrame, components: DataFrame) -> DataFrame:
    """``members(bucket, rep, ..)`` with their component (themselves, if they have no link)."""
    named = components.withColumnRenamed("node", "rep")
    return members.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _open(members: DataFrame, bound: int) -> DataFrame:
    """Members of buckets with more than one component, with the bucket's largest one as ``main``."""
    held = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    mains = held.groupBy("bucket").agg(
        F.max(F.struct("n", (-F.col("component")).alias("first"), F.col("component").alias("main"))).alias("top"),
        F.count(F.lit(1)).alias("n_components"), F.sum("n").alias("n"),
    )
    mains = mains.where("n_components > 1").select("bucket", "top.main", "n")
    return join_hot(members, mains, "bucket", "n", bound)


@F.arrow_udf(BinaryType())
def _digest_of(texts: pa.Array, size: pa.Array, weights: pa.Array) -> pa.Array:
    """Digest of each text's weighted shingle set, NULL without a word."""
    if not len(texts):
        return pa.array([], pa.binary())
    found = _sets([t or "" for t in texts.to_pylist()], size[0].as_py(), weights[0].as_py())
    return pa.array([digest(elements, w) if len(elements) else None for elements, w in found], pa.binary())


def text_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    size: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    weights: str = "binary",
) -> tuple[DataFrame, bool]:
    """(doc_id, digest, component) of every row with an id and a word, and whether an id has several texts.

    Texts are grouped, not ids: two texts of one id may be in two components.
    A node of the links stands for a digest: the least id that has this text
    alone or, if there is none, a hash of the digest.
    """
    given = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    marks = save(signatures(docs, id_col, text_col, size, bands, rows, weights), "neardup-signatures")
    several = marks.groupBy(F.col("doc_id").alias("id")).agg(F.min("digest").alias("low"), F.max("digest").alias("high"))
    several = save(several.where("low != high").select("id"), "neardup-several")
    n_several = several.count()
    flagged = marks.withColumn("several", F.lit(False))
    if n_several:
        side = several.select(F.col("id").alias("doc_id"), F.lit(True).alias("many"))
        side = F.broadcast(side) if n_several <= BROADCAST_IDS else side
        flagged = marks.join(side, "doc_id", "left").withColumn("several", F.col("many").isNotNull())
    # 1. equal shingle sets: one representative each
    alone = F.min(F.when(~F.col("several"), F.col("doc_id")))
    same = flagged.groupBy("digest").agg(
        alone.alias("rep"), F.min("doc_id").alias("first_id"), F.max("weight").alias("weight"), F.min("bands").alias("bands"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    same = save(same.withColumn("named", F.col("rep").isNull()).withColumn("rep", F.coalesce("rep", F.xxhash64(F.lit(9), "digest"))), "neardup-reps")
    named = same.where("named").select("rep", F.col("first_id").alias("id"), "digest") if n_several else None

    def texts_of(nodes: DataFrame) -> DataFrame:
        """(node, text) of the rows whose text a node stands for."""
        plain = by_ids(given, nodes, "id").select(F.col("id").alias("node"), "text")
        if named is None:
            return plain
        wanted = save(named.join(nodes.withColumnRenamed(nodes.columns[0], "rep"), "rep", "left_semi"), "neardup-named")
        rows_of = by_ids(given, wanted.select("id"), "id").withColumn("digest", _digest_of("text", F.lit(size), F.lit(weights)))
        return plain.unionByName(rows_of.join(wanted, ["id", "digest"]).select(F.col("rep").alias("node"), "text"))

    # 2. buckets of more than one representative; their hub is the member that meets most others in all its buckets
    members = same.select(F.explode("bands").alias("bucket"), "rep", "weight")
    bound = hot_bound(same.count() * bands)
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = save(join_hot(members, sizes.withColumn("n_", F.col("n")), "bucket", "n_", bound), "neardup-buckets")
    degree = crowded.groupBy("rep").agg(F.sum(F.col("n") - 1).alias("degree"))
    crowded = save(crowded.join(degree, "rep"), "neardup-members")
    hub_key = F.struct("degree", (-F.col("rep")).alias("first"), "rep", "weight")
    hubs = crowded.groupBy("bucket").agg(F.max(hub_key).alias("hub"), F.count(F.lit(1)).alias("n_"))
    close = F.least("w1", "w2") >= threshold * F.greatest("w1", "w2") - 1e-9  # else the similarity is below the threshold
    pairs = join_hot(crowded.drop("n", "degree"), hubs, "bucket", "n_", bound).select(
        F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b"),
        F.col("weight").alias("w1"), F.col("hub.weight").alias("w2"),
    )
    pairs = save(pairs.where((F.col("a") < F.col("b")) & close).select("a", "b").distinct(), "neardup-hub-pairs")
    links = save(_verified(pairs, texts_of, size, weights, threshold), "neardup-hub-links")
    found = components(links)
    # 3. members of one bucket still in different components: looked for once more by finer bands
    labelled = _labelled(crowded.select("bucket", "rep", "weight"), found)
    open_ids = save(_open(labelled, bound).select("rep").distinct(), "neardup-open")
    fine = signatures(texts_of(open_ids), "node", "text", size, FINE_BANDS, FINE_ROWS, weights, sketches=True)
    fine = fine.groupBy(F.col("doc_id").alias("rep")).agg(F.min(F.struct("weight", "bands", "sketch")).alias("s"))
    fine = fine.select("rep", "s.weight", "s.bands", "s.sketch")
    fine = save(_labelled(fine, found), "neardup-fine")
    fine_bound = hot_bound(fine.count() * FINE_BANDS)
    members = _open(fine.select(F.explode("bands").alias("bucket"), "rep", "weight", "sketch", "component"), fine_bound)
    members = save(members, "neardup-fine-members")
    x = members.where("component != main").select("bucket", F.col("rep").alias("x"), F.col("weight").alias("w1"), F.col("component").alias("c1"), F.col("sketch").alias("s1"))
    y = members.select("bucket", F.col("rep").alias("y"), F.col("weight").alias("w2"), F.col("component").alias("c2"), F.col("sketch").alias("s2"), "main")
    k = FINE_BANDS * FINE_ROWS
    apart = (F.col("c1") != F.col("c2")) & ((F.col("c2") == F.col("main")) | (F.col("x") < F.col("y"))) & close
    apart = apart & (_unlike("s1", "s2", k) <= most_unlike(threshold, k))
    rest = x.join(y, "bucket").where(apart).select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    rest = save(rest.join(pairs, ["a", "b"], "left_anti"), "neardup-rest-pairs")
    more = save(_verified(rest, texts_of, size, weights, threshold), "neardup-rest-links")
    final = components(links.unionByName(more))
    class_of = (
        same.select("digest", "rep", "n_rows")
        .join(final.withColumnRenamed("node", "rep"), "rep", "left")
        .select("digest", "n_rows", F.coalesce("component", "rep").alias("component"))
    )
    whole = join_hot(marks.select("doc_id", "digest"), class_of, "digest", "n_rows", hot_bound(marks.count()))
    return whole.select("doc_id", "digest", "component"), n_several > 0


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, class_id (smallest id of the class) of every row; ``options`` as for ``text_classes``."""
    found, several = text_classes(docs, id_col, text_col, **options)
    if several:  # rows that share an id are one document, so their texts' components are one class
        found = save(found, "neardup-texts")
        least = found.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("most")).where("a != most")
        meet = found.select("doc_id", F.col("component").alias("b")).distinct().join(least.select("doc_id", "a"), "doc_id")
        merged = components(save(meet.where("a != b").select("a", "b").distinct(), "neardup-meet"))
        found = found.join(merged.withColumnRenamed("component", "merged").withColumnRenamed("node", "component"), "component", "left")
        found = found.select("doc_id", F.coalesce("merged", "component").alias("component"))
        found = found.join(found.groupBy("component").agg(F.min("doc_id").alias("class_id")), "component")
    else:
        found = found.withColumnRenamed("component", "class_id")  # named by its least id
    by_id = found.groupBy("doc_id").agg(F.min("class_id").alias("class_id"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    return ids.join(by_id, "doc_id", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each group of near-duplicate texts, that of the smallest id (columns unchanged).

    Of rows that share this id, the one of the smallest text hash stays (and
    of equal texts the one of the smallest row hash); texts of one id that are
    no near-duplicates are all kept.  A text without words is like its repeats
    under the same id only.  Rows with a NULL id stay.
    """
    size, weights = options.get("size", SHINGLE), options.get("weights", "binary")
    found, _ = text_classes(docs, id_col, text_col, **options)
    found = save(found, "neardup-texts")
    first = found.groupBy("component").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
    found = save(join_hot(found, first, "component", "n", hot_bound(found.count())), "neardup-firsts")
    ids = docs.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL")
    repeated = save(ids.groupBy("id").count().where("count > 1").select("id"), "neardup-repeated")
    gone = found.where(F.col("doc_id") != F.col("first")).select("doc_id").distinct()
    if not repeated.take(1):
        return by_ids(docs, save(gone, "neardup-gone"), id_col, "left_anti")
    # rows of repeated ids are told apart by their texts
    single = by_ids(docs, save(gone.unionByName(repeated.withColumnRenamed("id", "doc_id")).distinct(), "neardup-gone"), id_col, "left_anti")
    own = F.struct(*[docs[c] for c in docs.columns])
    rows = by_ids(docs, repeated, id_col).select(
        own.alias("row"), F.col(id_col).cast("long").alias("doc_id"), _digest_of(F.col(text_col), F.lit(size), F.lit(weights)).alias("digest"),
        F.sha2(F.coalesce(F.col(text_col), F.lit("")).cast("binary"), 256).alias("text_hash"),
    )
    chosen = by_ids(found, repeated, "doc_id").distinct()
    rows = rows.join(chosen, ["doc_id", "digest"], "left").where(F.col("first").isNull() | (F.col("first") == F.col("doc_id")))
    group = F.coalesce(F.col("component").cast("string"), F.lit("no word"))
    order = Window.partitionBy("doc_id", group).orderBy("text_hash", F.xxhash64("row"))
    kept = rows.withColumn("nth", F.row_number().over(order)).where("nth = 1").select("row.*")
    return single.unionByName(kept)
