"""Label columns: time-of-day bins and seasons (chained CASE WHEN)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Six 4-hour bins of the day, as the case study defines them.
# Each bin is [start hour, end hour); hours outside all of them are "Late Night".
TIME_BINS = (
    ("Early Morning", 2, 6),
    ("Morning", 6, 10),
    ("Afternoon", 10, 14),
    ("Evening", 14, 18),
    ("Night", 18, 22),
)
TIME_BIN_ELSE = "Late Night"
TIME_BIN_INITIALS = {
    "Early Morning": "EM",
    "Morning": "M",
    "Afternoon": "A",
    "Evening": "E",
    "Night": "N",
    "Late Night": "LN",
}

# Seasons by month; months outside these are "Winter".
SEASONS = (
    ("Spring", 3, 6),
    ("Summer", 6, 9),
    ("Autumn", 9, 12),
)
SEASON_ELSE = "Winter"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def range_label(
    value: str | Column,
    bins: Sequence[tuple[str, int, int]],
    otherwise: str,
) -> Column:
    """First bin with ``start <= value < end``; ``otherwise`` for the rest.
    A NULL value stays NULL."""
    v = _col(value)
    expr = None
    for label, lo, hi in bins:
        cond = (v >= lo) & (v < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    expr = F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))
    return F.when(v.isNotNull(), expr)


def time_bin(hour: str | Column, bins=TIME_BINS, otherwise: str = TIME_BIN_ELSE) -> Column:
    """Time-of-day label for an hour 0-23."""
    return range_label(hour, bins, otherwise)


def season_label(month: str | Column, seasons=SEASONS, otherwise: str = SEASON_ELSE) -> Column:
    """Season label for a month 1-12."""
    return range_label(month, seasons, otherwise)


def bin_initials(label: str | Column) -> Column:
    """Short form of a time-bin label ("Late Night" -> "LN")."""
    mapping = F.create_map(*[F.lit(x) for kv in TIME_BIN_INITIALS.items() for x in kv])
    return F.coalesce(mapping[_col(label)], _col(label))
