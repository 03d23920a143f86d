"""Relational operators over DataFrames (built-in Spark only)."""

from ticketlens.operators.clean import (
    clean_year,
    combine_years,
    dedupe,
    fiscal_filter,
    first_columns,
    label_fiscal_year,
)
from ticketlens.operators.compare import common_items, facet_frame, pivot_years, share_lift, yoy
from ticketlens.operators.freq import frequency, rank_list, top_n, top_n_per_group
from ticketlens.operators.joins import lookup, restrict_to, small_side, with_unique_key
from ticketlens.operators.profile import (
    drop_empty_columns,
    duplicate_report,
    empty_columns,
    missing_count,
    month_histogram,
    null_profile,
    row_count,
    sample_rows,
    schema_diff,
    schema_profile,
    stored_profile,
)
from ticketlens.operators.revenue import (
    average_fine,
    fines_frame,
    fines_from_averages,
    fines_join,
    revenue,
    revenue_rollup,
    top_revenue_code,
    yearly_revenue,
)

__all__ = [
    "average_fine",
    "clean_year",
    "combine_years",
    "common_items",
    "dedupe",
    "drop_empty_columns",
    "duplicate_report",
    "empty_columns",
    "facet_frame",
    "fines_frame",
    "fines_from_averages",
    "fines_join",
    "first_columns",
    "fiscal_filter",
    "frequency",
    "label_fiscal_year",
    "lookup",
    "missing_count",
    "month_histogram",
    "null_profile",
    "pivot_years",
    "rank_list",
    "restrict_to",
    "revenue",
    "revenue_rollup",
    "row_count",
    "sample_rows",
    "schema_diff",
    "schema_profile",
    "share_lift",
    "small_side",
    "stored_profile",
    "top_n",
    "top_n_per_group",
    "top_revenue_code",
    "yearly_revenue",
    "yoy",
]
