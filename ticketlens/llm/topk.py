"""Exact top-k search by tiled matrix products.

Vectors are turned to whole numbers (floor(scale * x)).  Queries are taken in
blocks of at most ``BLOCK_BYTES``, each broadcast to the tasks that scan the
candidates, so no candidate is copied or shuffled.  A task multiplies tiles of
queries and of the candidates streaming by, keeps the k best of each query per
tile (partial selection) and merges them into its running lists; the tasks'
lists, k rows a query, are merged in groups of tasks and then per query.  All
queries meet all candidates, as the search asks; a task holds one block of
queries with its lists and one tile, whatever the table's size.

The products run in float64, which is exact while every partial sum is below
2**53; a tile where the components are too large for that uses Python's whole
numbers instead, and a score that no long holds counts as the nearest long.

Defined results: rows whose vector is NULL, empty, or holds a NULL or a
non-finite component take no part, as do rows with a NULL id; vectors of
different lengths are not compared; a query is not compared with rows of its
own id; equal scores go to the smaller id.  Rows that share an id are each a
candidate; as queries they share one list, which holds a candidate row once,
with its best score.  No candidate or no query: no row.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, save

K = 5
SCALE = 256
QUERY_TILE = 1024
VECTOR_TILE = 4096
BLOCK_BYTES = 64 << 20  # of queries in one broadcast
MERGE_GROUP = 32
RESULT_SCHEMA = "query_id long, place long, vec_id long, score long"
LONG = 2**63 - 1


def fit_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) with x as doubles; unfit rows are left out."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    finite = F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf)))
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))
    return rows.where(F.col("vec_id").isNotNull() & (F.size("x") > 0) & F.coalesce(finite, F.lit(False)))


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as float64, which holds it exactly, or as Python's whole numbers where it is beyond float64."""
    with np.errstate(over="ignore"):
        v = np.floor(scale * x)
    if np.isfinite(v).all():
        return v
    return np.array([[math.floor(c) * scale if abs(c) >= 2**53 else math.floor(scale * c) for c in row] for row in x], dtype=object)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``q`` and ``v``, cut to what a long holds."""
    if q.dtype != object and v.dtype != object:
        largest = max(1.0, np.abs(q).max()) * max(1.0, np.abs(v).max()) * q.shape[1]
        if largest < 2**53:
            return q @ v.T
    ints = [np.array([[int(c) for c in row] for row in m], dtype=object) for m in (q, v)]
    return np.clip(ints[0] @ ints[1].T, -LONG - 1, LONG).astype(np.int64)


class Lists:
    """The k best of each query so far: higher score first, then smaller id, then place."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        none = np.zeros(0, dtype=np.int64)
        self.query, self.score, self.vec, self.place = none, none, none, none
        self.floor = np.full(len(ids), -LONG - 1, dtype=np.int64)  # what a new score must reach

    def add(self, vec: np.ndarray, place: np.ndarray, v: np.ndarray, tile: int) -> None:
        """The candidates (ids, places, vectors) of one tile."""
        for a in range(0, len(self.ids), tile):
            ids = self.ids[a : a + tile]
            scores = products(self.vectors[a : a + tile], v)
            own = ids[:, None] == vec[None, :]
            scores[own] = -LONG - 1
            wanted = ~own & (scores >= self.floor[a : a + tile, None])
            if scores.shape[1] > self.k:  # all that reach the k-th score of the tile, ties included
                least = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
                wanted &= scores >= least[:, None]
            row, column = np.nonzero(wanted)
            if len(row):
                self._merge(row + a, scores[row, column].astype(np.int64), vec[column], place[column])

    def _merge(self, query: np.ndarray, score: np.ndarray, vec: np.ndarray, place: np.ndarray) -> None:
        query, score, vec, place = (
            np.concatenate(x) for x in ((self.query, query), (self.score, score), (self.vec, vec), (self.place, place))
        )
        order = np.lexsort((place, vec, ~score, query))  # ~ turns the order of whole numbers round
        query = query[order]
        nth = np.arange(len(query)) - np.searchsorted(query, query)
        best = order[nth < self.k]
        query, nth = query[nth < self.k], nth[nth < self.k]
        self.query, self.score, self.vec, self.place = query, score[best], vec[best], place[best]
        full = nth == self.k - 1
        self.floor[query[full]] = self.score[full]


def _block_lists(rows: DataFrame, block: dict[int, tuple[np.ndarray, np.ndarray]], k: int, query_tile: int, vector_tile: int, scale: int) -> DataFrame:
    """The k best of every query of the block among each task's rows."""
    held = rows.sparkSession.sparkContext.broadcast(block)  # at most BLOCK_BYTES

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {dim: Lists(ids, whole(x, scale), k) for dim, (ids, x) in held.value.items()}
        for batch in batches:
            for start in range(0, batch.num_rows, vector_tile):
                part = batch.slice(start, vector_tile)
                size = np.diff(part.column(2).offsets.to_numpy())
                for dim in np.unique(size).tolist():
                    if dim in lists:
                        own = part.filter(pa.array(size == dim))
                        x = own.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                        lists[dim].add(own.column(0).to_numpy(), own.column(1).to_numpy(), whole(x, scale), query_tile)
        for found in lists.values():
            yield pa.record_batch(
                [pa.array(c, pa.int64()) for c in (found.ids[found.query], found.place, found.vec, found.score)],
                ["query_id", "place", "vec_id", "score"],
            )

    return rows.select("vec_id", "place", "x").mapInArrow(run, RESULT_SCHEMA)


def top_k(
    vectors: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    query_tile: int = QUERY_TILE,
    vector_tile: int = VECTOR_TILE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best inner products of every query row (``is_query`` over vec_id)."""
    spark = vectors.sparkSession
    ready_workers(spark)
    rows = save(fit_vectors(vectors, id_col, vector_col).withColumn("place", F.monotonically_increasing_id()), "topk-vectors")
    queries = rows.where(is_query)
    n_queries, n_ids, n_bytes = queries.agg(
        F.count(F.lit(1)), F.count_distinct("vec_id"), F.coalesce(F.sum(8 * F.size("x") + 16), F.lit(0))
    ).first()
    n_blocks = max(1, math.ceil(2 * n_bytes / block_bytes))  # twice as many as fit: hashed shares are not equal
    dealt = save(queries.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(n_blocks)).cast("int")), "topk-queries")
    partial = []
    for number in range(n_blocks if n_queries else 0):
        block: dict[int, tuple[list, list]] = {}
        for r in dealt.where(F.col("block") == number).select("vec_id", "x").toArrow().to_pylist():
            ids, x = block.setdefault(len(r["x"]), ([], []))
            ids.append(r["vec_id"])
            x.append(r["x"])
        arrays = {dim: (np.array(ids, dtype=np.int64), np.array(x, dtype=np.float64)) for dim, (ids, x) in block.items()}
        partial.append(_block_lists(rows, arrays, k, query_tile, vector_tile, scale))
    if not partial:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    lists = reduce(DataFrame.unionByName, partial)
    if n_ids < n_queries:  # query rows that share an id: a candidate row counts once, with its best score
        lists = lists.groupBy("query_id", "place", "vec_id").agg(F.max("score").alias("score"))
    order = [F.col("score").desc(), F.col("vec_id").asc(), F.col("place").asc()]
    n_tasks = len(rows.inputFiles())
    if n_tasks > MERGE_GROUP:  # a first level of the merge, in groups of lists
        group = F.pmod(F.xxhash64("place"), F.lit(n_tasks // MERGE_GROUP))
        place = F.row_number().over(Window.partitionBy("query_id", group).orderBy(*order))
        lists = lists.withColumn("nth", place).where(F.col("nth") <= k).drop("nth")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return lists.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
