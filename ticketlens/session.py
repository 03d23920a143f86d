"""Spark session settings the library relies on.

Clock and date maths assume a UTC session; bad date / time text must become
NULL (the ``try_`` functions are used everywhere), so ANSI mode can stay on.
Broadcast rule: the planner's static size guess (file size x column share)
is switched off, so no table that grows with the data is broadcast on an
estimate.  AQE still turns a join into a broadcast join at run time when a
finished shuffle stage has *measured* one side below the adaptive threshold;
explicit ``broadcast()`` hints are given only for sides with a row bound
known from how they were built (see ``operators.joins``).  AQE also splits
skewed shuffle partitions and coalesces small ones.
"""

from __future__ import annotations

import math
import os
import re
import tempfile
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


# SQL settings that can be applied to a running session (see ``apply_sql_defaults``).
SQL_DEFAULTS = {k: v for k, v in DEFAULT_CONF.items() if k.startswith("spark.sql.")}


def apply_sql_defaults(spark: SparkSession) -> SparkSession:
    """Put the library's SQL settings on a session someone else built."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


MB = 1024 * 1024


def scale_conf(
    input_bytes: int,
    target_partition_bytes: int = 256 * MB,
    min_partitions: int = 8,
) -> dict[str, str]:
    """Shuffle sizes for a run over ``input_bytes`` of raw input.

    The only shuffle that carries whole tickets is the whole-row dedupe of
    the raw files (and the joins of the test mapping); every question after
    cleaning shuffles partial aggregates.  So the start partition count is
    sized for the dedupe: no reduce partition above ``target_partition_bytes``
    at any input size (which keeps its hash table and sort within one
    executor's memory), with AQE coalescing the small shuffles of the
    questions back down.
    """
    n = max(math.ceil(input_bytes / target_partition_bytes), min_partitions)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
    }


def input_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Size of the files under ``paths`` (a listing; no content is read)."""
    sizes = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths)).select("length")
    return int(sizes.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])


def size_shuffles(
    spark: SparkSession,
    input_bytes: int,
    start_partition_bytes: int = 4 * MB,
    reduce_partition_bytes: int = 8 * MB,
) -> SparkSession:
    """Bound what one task of a join or dedupe over stored tables holds.

    A task of the whole-row dedupe keeps its rows sorted for the join and in
    two hash tables: measured, up to 28 times the bytes it fetches.  AQE joins
    small partitions but splits none below an aggregate, so the count it
    starts from follows the input (one per ``start_partition_bytes`` of
    Parquet), and none is joined to more than ``reduce_partition_bytes``.  A
    caller's larger count or smaller size stays.
    """
    def known(key: str) -> str:
        return spark.conf.get(key, None) or "0"

    start, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    asked = max(int(known(start)), int(known("spark.sql.shuffle.partitions")))
    spark.conf.set(start, str(max(asked, math.ceil(input_bytes / start_partition_bytes))))
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", known(size).strip().lower()).groups()
    given = int(number) * 1024 ** " kmgtp".index(unit or " ")
    spark.conf.set(size, str(min(given or reduce_partition_bytes, reduce_partition_bytes)))
    return spark


def isolated(spark: SparkSession) -> SparkSession:
    """A session of its own on the same context, with the caller's SQL
    settings and the library's defaults on top; the caller's stay as they are."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and own.conf.isModifiable(key):
            own.conf.set(key, value)
    return apply_sql_defaults(own)


def build_session(
    master: str | None = None,
    app_name: str = "ticketlens",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with the library's defaults.

    ``master`` is only set when given (on a cluster the launcher sets it).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if spark.sparkContext.master.startswith("local"):
        ensure_checkpoint_dir(spark)  # a scratch folder only if none is configured
    return spark


def apply_scale(spark: SparkSession, input_bytes: int, **kwargs) -> SparkSession:
    """Set the ``scale_conf`` sizes on a running session (all are SQL settings)."""
    for key, value in scale_conf(input_bytes, **kwargs).items():
        spark.conf.set(key, value)
    return spark


def checkpoint_root(spark: SparkSession) -> str | None:
    """The shared folder named by the cluster for checkpoints, if any."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; create a scratch one only in
    local mode (tests, laptop runs) when nothing is configured."""
    root = checkpoint_root(spark)
    sc = spark.sparkContext
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return sc.getCheckpointDir() or root
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; name a shared folder for checkpoints"
        )
    scratch = tempfile.mkdtemp(prefix="ticketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch
