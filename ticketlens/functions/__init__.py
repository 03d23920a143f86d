"""Scalar column functions (all built-in Spark expressions, no UDFs)."""

from ticketlens.functions.clock import (
    ADDITIVE,
    CLOCK,
    clock_pieces,
    clock_string,
    clock_timestamp,
    fill_time,
    hour_of,
    minute_of_day,
)
from ticketlens.functions.dates import (
    fiscal_year_bounds,
    fiscal_year_of,
    in_fiscal_year,
    parse_date,
)
from ticketlens.functions.labels import bin_initials, range_label, season_label, time_bin

__all__ = [
    "ADDITIVE",
    "CLOCK",
    "bin_initials",
    "clock_pieces",
    "clock_string",
    "clock_timestamp",
    "fill_time",
    "fiscal_year_bounds",
    "fiscal_year_of",
    "hour_of",
    "in_fiscal_year",
    "minute_of_day",
    "parse_date",
    "range_label",
    "season_label",
    "time_bin",
]
