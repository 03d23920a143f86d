"""Clock text of the form ``HHMM`` + ``A``/``P`` (e.g. ``0752A``).

Everything here is a JVM-side column expression; nothing goes through
``unix_timestamp`` (session-time-zone dependent and raising on bad text
under ANSI).  The result of parsing is one INT, minutes after midnight.

Two modes:

* ``"clock"`` (default) - a real 12-hour clock: ``12xxA`` is just after
  midnight, ``12xxP`` just after noon.  Hours 00-12 accepted.
* ``"additive"`` - the case study's arithmetic: the hour text is taken as a
  24-hour hour (00-23), ``P`` adds 12 hours and the sum wraps at 24, so
  ``1230P`` lands at 00:30 and ``1230A`` stays at 12:30.  A missing
  suffix counts as ``A``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = "clock"
ADDITIVE = "additive"

# Accepted shapes of the clock text.
CLOCK_PATTERN = r"^[0-9]{4}[AP]$"
ADDITIVE_PATTERN = r"^[0-9]{4}[AP]?$"
NO_TIME_SENTINEL = "ALL"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill_time(time: str | Column, fallback: str | Column, sentinel: str = NO_TIME_SENTINEL) -> Column:
    """Take ``fallback`` where ``time`` is NULL, unless it equals ``sentinel``.

    A NULL ``fallback`` makes the condition NULL, so the value stays NULL.
    """
    t, f = _col(time), _col(fallback)
    return F.when(t.isNull() & (f != F.lit(sentinel)), f).otherwise(t)


def clock_pieces(time: str | Column) -> tuple[Column, Column, Column]:
    """Hour text (chars 1-2), minute text (3-4) and suffix (5)."""
    t = _col(time)
    return F.substring(t, 1, 2), F.substring(t, 3, 2), F.substring(t, 5, 1)


def clock_string(time: str | Column) -> Column:
    """``HH:mm`` text built from the pieces (no validation)."""
    hh, mm, _ = clock_pieces(time)
    return F.concat_ws(":", hh, mm)


def minute_of_day(time: str | Column, mode: str = CLOCK) -> Column:
    """Minutes after midnight (INT), NULL for text that is not a clock time."""
    t = _col(time)
    hh_txt, mm_txt, suffix = clock_pieces(t)
    hh = hh_txt.try_cast("int")
    mm = mm_txt.try_cast("int")
    pm = suffix == F.lit("P")
    if mode == CLOCK:
        ok = t.rlike(CLOCK_PATTERN) & (hh <= 12) & (mm <= 59)
        value = ((hh % 12) + F.when(pm, 12).otherwise(0)) * 60 + mm
    elif mode == ADDITIVE:
        ok = t.rlike(ADDITIVE_PATTERN) & (hh <= 23) & (mm <= 59)
        value = ((hh + F.when(pm, 12).otherwise(0)) % 24) * 60 + mm
    else:
        raise ValueError(f"unknown clock mode {mode!r}")
    return F.when(ok, value).cast("int")


def hour_of(minutes: str | Column) -> Column:
    """Hour (0-23) of a minute-of-day value."""
    return F.floor(_col(minutes) / 60).cast("int")


def clock_timestamp(minutes: str | Column) -> Column:
    """The parsed time as a TIMESTAMP_NTZ on 1970-01-01 (zone free)."""
    m = _col(minutes)
    return F.make_timestamp_ntz(
        F.lit(1970), F.lit(1), F.lit(1), hour_of(m), (m % 60).cast("int"), F.lit(0)
    )
