"""Profiling: structure, counts, duplicates, NULLs, month histogram.

All counts are exact and computed in one aggregation pass each; results are
small DataFrames (one row per column, per year-month, ...).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticketlens.session import isolated


def _c(name: str) -> Column:
    """Column by exact name (dots and spaces are not paths)."""
    return F.col("`" + name.replace("`", "``") + "`")


def _long_form(wide: DataFrame, names: Sequence[str], keep: Sequence[str], value_name: str) -> DataFrame:
    """Unpivot one-row ``wide`` (value columns aliased ``_0``, ``_1``, ...)
    into ``(column_name, value)`` rows, mapping the aliases back to names."""
    aliases = [f"_{i}" for i in range(len(names))]
    long = wide.unpivot(list(keep), aliases, "_alias", value_name)
    mapping = F.create_map(*[F.lit(x) for pair in zip(aliases, names) for x in pair])
    return long.withColumn("column_name", mapping[F.col("_alias")]).drop("_alias")


def schema_profile(df: DataFrame, examples: bool = False) -> DataFrame:
    """Names, types and nullability of ``df``'s columns (like ``str(df)``).

    ``examples=True`` adds ``example``: the column's smallest value as text,
    from one aggregation pass (deterministic, unlike "the first rows")."""
    rows = [
        (i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)
    ]
    meta = df.sparkSession.createDataFrame(
        rows, "position INT, column_name STRING, data_type STRING, nullable BOOLEAN"
    )
    if not examples:
        return meta
    names = df.columns

    def example(i: int, f) -> Column:
        if isinstance(f.dataType, T.MapType):  # maps have no order
            return F.lit(None).cast("string").alias(f"_{i}")
        return F.min(_c(f.name)).cast("string").alias(f"_{i}")

    wide = df.agg(*[example(i, f) for i, f in enumerate(df.schema.fields)])
    ex = _long_form(wide, names, [], "example")
    return meta.join(ex, "column_name", "left").orderBy("position")


def schema_diff(
    frames: Mapping[str, DataFrame], spark: SparkSession | None = None, with_counts: bool = False
) -> DataFrame:
    """Which columns each frame has: one row per column name seen anywhere,
    one boolean ``in_<name>`` per frame, in first-seen order.

    ``with_counts=True`` adds ``n_<name>``: the number of values (non-NULL)
    the frame holds in that column, NULL where it has no such column - a
    column that exists but is empty shows 0.  One aggregation pass per frame.
    """
    names: list[str] = []
    for df in frames.values():
        names.extend(c for c in df.columns if c not in names)
    labels = list(frames)
    rows = [(i + 1, n, *[n in frames[k].columns for k in labels]) for i, n in enumerate(names)]
    session = spark or next(iter(frames.values())).sparkSession
    schema = "position INT, column_name STRING, " + ", ".join(f"in_{k} BOOLEAN" for k in labels)
    out = session.createDataFrame(rows, schema)
    if not with_counts:
        return out
    for k in labels:
        df = frames[k]
        wide = df.agg(*[F.count(_c(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
        counts = _long_form(wide, df.columns, [], f"n_{k}")
        out = out.join(counts, "column_name", "left")
    return out.select("position", "column_name", *[f"in_{k}" for k in labels], *[f"n_{k}" for k in labels])


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def duplicate_report(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Rows, distinct rows and duplicate rows in one shuffle.

    Groups by every column (NULLs compare equal, as in ``distinct``); the
    map-side partial aggregate already collapses copies inside each task, so
    a row repeated a billion times ships one row per task.
    """
    cols = list(subset) if subset else df.columns
    groups = df.groupBy(*[_c(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.sum("_n").cast("long").alias("n_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        (F.sum("_n") - F.count(F.lit(1))).cast("long").alias("duplicates"),
    )


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Exact NULL count of every column, one pass, long form
    ``(column_name, n_null, n_rows)``."""
    cols = list(columns) if columns else df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_c(c).isNull()).alias(f"_{i}") for i, c in enumerate(cols)],
    )
    long = _long_form(wide, cols, ["__rows"], "n_null")
    return long.select("column_name", F.col("n_null").cast("long").alias("n_null"), F.col("__rows").alias("n_rows"))


def stored_profile(spark: SparkSession, path: str) -> DataFrame:
    """``null_profile`` of a stored Parquet table, from the files' footers.

    ``count(*)`` and ``count(column)`` are pushed into the scan, which adds up
    the row and NULL counts that every footer holds: no column is read,
    whatever the size of the table.  Partition columns live in no footer and
    are left out, as are columns of nested types.
    """
    own = isolated(spark)
    own.conf.set("spark.sql.sources.useV1SourceList", "")  # aggregates are pushed to the V2 reader only
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    stored = own.read.parquet(path)
    folders = set(partition_columns(stored))
    nested = (T.StructType, T.ArrayType, T.MapType)
    names = [f.name for f in stored.schema.fields if f.name not in folders and not isinstance(f.dataType, nested)]
    wide = stored.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(_c(c)).alias(f"_{i}") for i, c in enumerate(names)])
    long = _long_form(wide, names, ["__rows"], "n_values")
    return long.select("column_name", (F.col("__rows") - F.col("n_values")).alias("n_null"), F.col("__rows").alias("n_rows"))


def partition_columns(stored: DataFrame) -> list[str]:
    """Columns whose values stand in the folder names of a stored table."""
    names = stored.columns
    folders = {part.split("=", 1)[0] for file in stored.inputFiles()[:1] for part in file.split("/")[:-1] if "=" in part}
    return [c for c in names if c in folders]


def empty_columns(df: DataFrame, profile: DataFrame | Mapping[str, tuple[int, int]] | None = None) -> list[str]:
    """Columns with no value at all.

    ``profile`` is what a write or a stored table already knows
    (``sink.write_profiled``: no job; ``stored_profile``: footers only).
    Without one the frame is profiled, a full pass over it.  Collects one small
    row per column, never data rows.
    """
    if isinstance(profile, Mapping):
        return [c for c in df.columns if c in profile and profile[c][1] > 0 and profile[c][0] == profile[c][1]]
    rows = (profile if profile is not None else null_profile(df)).collect()
    return [r["column_name"] for r in rows if r["n_rows"] > 0 and r["n_null"] == r["n_rows"]]


def drop_empty_columns(df: DataFrame, profile: DataFrame | Mapping[str, tuple[int, int]] | None = None) -> DataFrame:
    """``df`` without its empty columns; for ``profile`` see ``empty_columns``."""
    empty = set(empty_columns(df, profile))
    return df.select([_c(c) for c in df.columns if c not in empty])


def month_histogram(df: DataFrame, date: str, year_name: str = "year", month_name: str = "month") -> DataFrame:
    """Rows per calendar (year, month) of ``date``, in calendar order."""
    d = F.col(date)
    return (
        df.groupBy(F.year(d).alias(year_name), F.month(d).alias(month_name))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(year_name, month_name)
    )


def missing_count(df: DataFrame, column: str, name: str = "n_missing") -> DataFrame:
    return df.agg(F.count_if(_c(column).isNull()).cast("long").alias(name))


def sample_rows(df: DataFrame, fraction: float = 0.01, seed: int = 42, key: str | Sequence[str] | None = None) -> DataFrame:
    """Rows whose key's seeded hash falls into the first ``fraction`` of all hashes.

    The choice depends on the key (default: the whole row) and the seed only,
    so it is the same however the rows are partitioned; rows with equal keys
    are taken or left together.
    """
    keys = [key] if isinstance(key, str) else list(key or df.columns)
    text = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(_c(k).cast("string"), F.lit("")) for k in keys])
    if fraction >= 1:
        return df
    bound = format(max(0, int(fraction * 2**32)), "08x")
    return df.where(F.substring(F.md5(text), 1, 8) < bound)
