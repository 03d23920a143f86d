"""Cleaned-table sink: Parquet partitioned by fiscal year.

The raw CSVs are read and cleaned once; every question afterwards reads
only the columns it needs from Parquet, and a per-year question prunes
whole partitions.  Writing a table also cuts the lineage of the cleaning
plan (dedupe, joins), so a lost executor recomputes from the written files,
not from the raw text.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ticketlens.session import MB, ensure_checkpoint_dir


# Shuffled bytes of one writing task (the Parquet file is several times
# smaller).  AQE joins the partitions of the joins before the write up to this
# size too, so it also bounds what a task of those holds.
TARGET_FILE_BYTES = 64 * MB
# Files a writing task keeps open, one per partition value, before it falls
# back to sorting its rows.
OPEN_FILES = 16


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """``key`` set for the block, then back as it was."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_clean(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = "fiscal_year",
    mode: str = "overwrite",
    max_records_per_file: int | None = 5_000_000,
    target_bytes: int | None = TARGET_FILE_BYTES,
    parted: bool = False,
) -> str:
    """Write ``df`` as Parquet at ``path`` and return the path.

    The rows are rebalanced on the partition columns first: AQE measures the
    shuffled bytes, puts small years together into few tasks and cuts a large
    year into tasks of about ``target_bytes``, so a year has as many files as
    its size asks for, however many tasks the cleaning ran with and however
    unequal the years are.  ``target_bytes=None`` leaves the shuffle out (each
    task then writes one file per year it holds), for scratch tables; so does
    a session without AQE, where rebalancing would put a year into one task.

    A rebalanced task holds few partition values, so it writes their files side
    by side instead of sorting all its rows by them first.  ``parted`` says that
    every task of ``df`` holds one partition value already, after a shuffle that
    AQE sizes (yearly frames deduped one by one): the rows are not shuffled again.
    """
    cols = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    spark = df.sparkSession
    rebalance = bool(cols and target_bytes) and not parted and spark.conf.get("spark.sql.adaptive.enabled", "true") == "true"
    sized = rebalance or (parted and bool(cols and target_bytes))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": target_bytes, "spark.sql.maxConcurrentOutputFileWriters": OPEN_FILES}
    with ExitStack() as held:
        for key, value in settings.items() if sized else ():
            held.enter_context(_setting(spark, key, str(value)))
        writer = (df.hint("rebalance", *cols) if rebalance else df).write.mode(mode)
        if max_records_per_file:
            writer = writer.option("maxRecordsPerFile", max_records_per_file)
        if cols:
            writer = writer.partitionBy(*cols)
        writer.parquet(path)
    return path


def write_profiled(df: DataFrame, path: str, mode: str = "overwrite") -> dict[str, tuple[int, int]]:
    """Write ``df`` as Parquet and return ``{column: (n_null, n_rows)}``.

    The counts are observed by the writing tasks themselves: one pass, no
    second evaluation of ``df`` and no job besides the write.
    """
    seen = Observation()
    counts = [F.count(F.col("`" + c.replace("`", "``") + "`")).alias(f"_{i}") for i, c in enumerate(df.columns)]
    df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.mode(mode).parquet(path)
    found = seen.get
    return {c: (found["rows"] - found[f"_{i}"], found["rows"]) for i, c in enumerate(df.columns)}


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str, partition_by: str | list[str] | None = None) -> DataFrame:
    """Write ``df`` under the session's checkpoint folder and read it back.

    The checkpoint folder is the shared one the cluster names in
    ``spark.checkpoint.dir`` (a scratch folder only in local mode).
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = os.path.join(root, "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    if partition_by:
        write_clean(df, path, partition_by, target_bytes=None)
    else:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
