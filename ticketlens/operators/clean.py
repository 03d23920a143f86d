"""Cleaning a yearly file and combining years.

Order per year: dedupe over every column (before anything is dropped, so
"duplicate" means the whole raw record), keep the data columns, parse the
date, label the fiscal year, keep only rows dated inside it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.dates import fiscal_year_of, in_fiscal_year, parse_date


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Whole-row distinct (hash aggregate; copies collapse map-side)."""
    return df.dropDuplicates(list(subset)) if subset else df.distinct()


def first_columns(df: DataFrame, keep: int | Sequence[str]) -> DataFrame:
    """Keep the first ``keep`` columns, or the named ones in the given order
    (a name the frame lacks becomes a NULL column).  Names are the safe
    form; a count only works when the files' headers agree."""
    if isinstance(keep, int):
        return df.select(df.columns[:keep])
    return df.select([F.col(c) if c in df.columns else F.lit(None).alias(c) for c in keep])


def label_fiscal_year(
    df: DataFrame,
    fiscal_year: int | Column | None = None,
    date: str = "issue_date",
    name: str = "fiscal_year",
) -> DataFrame:
    """Add the fiscal-year label: a constant for a yearly file, a column, or
    (``None``) the fiscal year derived from ``date``."""
    if fiscal_year is None:
        value = fiscal_year_of(date)
    elif isinstance(fiscal_year, int):
        value = F.lit(fiscal_year)
    else:
        value = fiscal_year
    return df.withColumn(name, value.cast("int"))


def fiscal_filter(df: DataFrame, date: str = "issue_date", year: str | int = "fiscal_year") -> DataFrame:
    """Keep rows whose date lies in their fiscal year (NULL dates dropped).

    With an integer year the predicate is a date range that Parquet scans
    can push down."""
    return df.where(in_fiscal_year(date, year))


def clean_year(
    raw: DataFrame,
    fiscal_year: int | str | Column,
    keep: int | Sequence[str] | None = None,
    date_text: str = "issue_date",
    date_format: str = "M/d/yyyy",
    year_name: str = "fiscal_year",
    cast: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Raw yearly records to clean ones.

    ``cast`` types the columns of a text frame after the copies are removed,
    so two records that differ only in text their types cannot hold stay two.

    ``fiscal_year`` is the file's year: an int for one file, or a column
    name/expression when several files are cleaned in one pass (the file
    year then takes part in the dedupe key, so copies are only looked for
    inside a file).  The text date column is replaced by a DATE and the
    label column ``year_name`` (INT) is added.
    """
    per_row = not isinstance(fiscal_year, int)
    out = raw
    if per_row:
        expr = F.col(fiscal_year) if isinstance(fiscal_year, str) else fiscal_year
        out = out.withColumn("__file_year", expr)
    out = dedupe(out)
    if cast is not None:
        out = cast(out)
    if keep is not None:
        cols = raw.columns[:keep] if isinstance(keep, int) else list(keep)
        out = out.select(*cols, *(["__file_year"] if per_row else []))
    out = out.withColumn(date_text, parse_date(date_text, date_format))
    if per_row:
        out = out.withColumn(year_name, F.col("__file_year").cast("int")).drop("__file_year")
        if isinstance(fiscal_year, str) and fiscal_year != year_name and fiscal_year in out.columns:
            out = out.drop(fiscal_year)
        return out.where(in_fiscal_year(date_text, year_name))
    out = out.withColumn(year_name, F.lit(fiscal_year).cast("int"))
    return out.where(in_fiscal_year(date_text, fiscal_year))


def combine_years(frames: Iterable[DataFrame] | Mapping[int, DataFrame]) -> DataFrame:
    """Union by column name; a column missing from a year is NULL there.

    The result has every column of every input, in first-seen order.
    """
    dfs = list(frames.values()) if isinstance(frames, Mapping) else list(frames)
    if not dfs:
        raise ValueError("no frames to combine")
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
    order: list[str] = []
    for df in dfs:
        order.extend(c for c in df.columns if c not in order)
    return combined.select(order)
