"""Helpers shared by the operators: scratch tables, worker set-up, arrays."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.session import ensure_checkpoint_dir

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package.

    On a cluster the package is installed or sent with ``--py-files``; in
    local runs started from another folder the workers need its root.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join([p for p in have if p] + [ROOT])


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def save(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


BROADCAST_IDS = 500_000


def by_ids(df: DataFrame, ids: DataFrame, id_col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose id is (``left_semi``) or is not (``left_anti``) in the one column of ``ids``.

    Give a saved table of ids: they are counted, and at most
    ``BROADCAST_IDS`` of them (some 12 MB) are broadcast, so the texts stay
    where they are; more are joined by a shuffle.
    """
    wanted = ids.select(F.col(ids.columns[0]).cast("long").alias("__id")).distinct()
    side = F.broadcast(wanted) if ids.count() <= BROADCAST_IDS else wanted
    return df.join(side, df[id_col].cast("long") == F.col("__id"), how)


HOT_ROWS = 1000


def hot_bound(total: int) -> int:
    """More rows than this make a key hot; of ``total`` rows at most ``HOT_ROWS`` keys can be."""
    return max(HOT_ROWS, total // HOT_ROWS)


def join_hot(left: DataFrame, right: DataFrame, on: str | list[str], weight: str, bound: int) -> DataFrame:
    """``left`` joined with ``right``, which has one row per key and in ``weight`` the number of left rows of it.

    Keys with more than ``bound`` rows (see ``hot_bound``: a bounded number)
    are broadcast, so the rows of a hot key stay where they are instead of
    meeting in one task; the others are joined by a shuffle.
    """
    keys = [on] if isinstance(on, str) else on
    hot, cold = (right.where(c).drop(weight) for c in (F.col(weight) > bound, F.col(weight) <= bound))
    few = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(cold, keys)
    return left.join(F.broadcast(hot), keys).unionByName(few)


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The column as Python strings, NULL as the empty text."""
    return [x or "" for x in column.to_pylist()]


def slices(n_bytes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Cut 0..len(n_bytes) into runs of about ``limit`` bytes (one item at least)."""
    start, total = 0, 0
    for i, n in enumerate(n_bytes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(n_bytes):
        yield start, len(n_bytes)


def mix64(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser on uint64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
