"""Date text parsing and fiscal-year maths (column expressions only)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The ticket files write dates as month/day/year; the fiscal
# year runs July to June and is named after the year in which it ends.
ISSUE_DATE_FORMAT = "M/d/yyyy"
FISCAL_START_MONTH = 7


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(text: str | Column, fmt: str = ISSUE_DATE_FORMAT) -> Column:
    """Text to DATE; unparseable text gives NULL instead of an ANSI error.

    ``M/d/yyyy`` accepts both ``06/03/2015`` and ``6/3/2015``.
    """
    return F.try_to_date(_col(text), fmt)


def fiscal_year_of(date: str | Column, start_month: int = FISCAL_START_MONTH) -> Column:
    """Fiscal year (INT) a date falls in: the year in which that fiscal year ends."""
    d = _col(date)
    if start_month == 1:
        return F.year(d)
    return (F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)).cast("int")


def fiscal_year_bounds(
    fiscal_year: int, start_month: int = FISCAL_START_MONTH
) -> tuple[_dt.date, _dt.date]:
    """Half-open date range [start, end) of a fiscal year."""
    if start_month == 1:
        return _dt.date(fiscal_year, 1, 1), _dt.date(fiscal_year + 1, 1, 1)
    return _dt.date(fiscal_year - 1, start_month, 1), _dt.date(fiscal_year, start_month, 1)


def in_fiscal_year(
    date: str | Column, fiscal_year: int | str | Column, start_month: int = FISCAL_START_MONTH
) -> Column:
    """Predicate: ``date`` lies inside ``fiscal_year``.

    With a literal year this is a plain range on the date column, which
    Parquet scans take as a pushed filter (``year(d) = ..`` would not be
    pushed).  With a per-row year column it compares the date's own fiscal
    year.  NULL dates never pass.
    """
    d = _col(date)
    if isinstance(fiscal_year, int):
        lo, hi = fiscal_year_bounds(fiscal_year, start_month)
        return (d >= F.lit(lo)) & (d < F.lit(hi))
    return fiscal_year_of(d, start_month) == _col(fiscal_year)
