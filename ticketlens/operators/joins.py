"""Join helpers with an explicit rule for when a side may be broadcast.

A side is hinted for broadcast only when its row count has a bound known
from how it was built (a literal table, a ``limit(k)`` result) or counted
(``counted_small_side``).  Any other
side is left to the planner: it broadcasts from the measured size below
``spark.sql.autoBroadcastJoinThreshold`` (re-checked at run time by AQE) and
falls back to a shuffle join above it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Largest row bound for which a broadcast hint is given.  Key lists and
# lookup tables here are a few columns wide, so this stays far below the
# default 10 MB broadcast threshold's worth of rows times a safety factor.
BROADCAST_MAX_ROWS = 10_000


def small_side(df: DataFrame, row_bound: int | None) -> DataFrame:
    """``broadcast(df)`` if ``row_bound`` proves it small, else ``df``."""
    if row_bound is not None and 0 <= row_bound <= BROADCAST_MAX_ROWS:
        return F.broadcast(df)
    return df


def counted_small_side(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` if counting says it has at most ``max_rows`` rows, else ``df``.

    The count reads at most one row more than the bound.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def restrict_to(
    facts: DataFrame,
    keys: DataFrame,
    on: str | Sequence[str] | Column,
    row_bound: int | None = None,
) -> DataFrame:
    """Rows of ``facts`` whose key appears in ``keys`` (LEFT SEMI join).

    Replaces a pasted literal list (``IN (0, 19, 14)``) by the derived list
    itself, so the filter stays right when the data changes.
    """
    return facts.join(small_side(keys, row_bound), on, "left_semi")


def with_unique_key(table: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``table``, failing at run time with the key's name if two rows share a key.

    One window over the (small) table's own keys; NULL keys join nothing and
    may repeat.
    """
    keys = [on] if isinstance(on, str) else list(on)
    shown = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    several = F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    message = F.concat(F.lit(f"lookup table holds several rows for {'/'.join(keys)} = "), shown)
    checked = table.select("*", F.when(several & known, F.raise_error(message).cast("boolean")).alias("__repeats"))
    return checked.where(F.col("__repeats").isNull()).drop("__repeats")


def lookup(
    facts: DataFrame,
    table: DataFrame,
    on: Column | str | Sequence[str],
    how: str = "inner",
    row_bound: int | None = None,
    unique_key: str | Sequence[str] | None = None,
) -> DataFrame:
    """Many-to-one join of a fact table to a small dimension.

    A dimension that lists a key twice would repeat the facts and double
    their totals; ``unique_key`` names the dimension's key columns and makes
    such a table fail instead.
    """
    side = table if unique_key is None else with_unique_key(table, unique_key)
    return facts.join(small_side(side, row_bound), on, how)
