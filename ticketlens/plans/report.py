"""The whole case study, end to end.

``clean_files`` turns the raw yearly CSVs into one cleaned Parquet table
(read once, deduped, cut, dated, labelled, fiscal-filtered, partitioned by
fiscal year).  ``case_study`` returns every question as a lazy DataFrame over
a cleaned table, keyed by name; the caller decides to collect, show or write
each one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from ticketlens.functions.clock import CLOCK
from ticketlens.operators.clean import clean_year, combine_years
from ticketlens.operators.compare import facet_frame
from ticketlens.operators.profile import duplicate_report, null_profile, schema_diff
from ticketlens.plans import questions as q
from ticketlens.roles import DEFAULT_ROLES, Roles
from ticketlens.sources.csv import KEPT_COLUMNS, cast_columns, kept_names, pad_columns, read_years, unparsed_counts
from ticketlens.sources.sink import read_clean, write_clean


def profile_files(raw: Mapping[int, DataFrame]) -> dict[str, DataFrame]:
    """Structure difference, duplicates, NULL counts and values that do not parse, of the raw years as text."""
    out: dict[str, DataFrame] = {"schema_diff": schema_diff({str(y): df for y, df in raw.items()})}
    for year, df in raw.items():
        out[f"duplicates_{year}"] = duplicate_report(df)
        out[f"nulls_{year}"] = null_profile(df)
        out[f"unparsed_{year}"] = unparsed_counts(df)
    return out


def clean_files(
    spark: SparkSession,
    paths: Mapping[int, str],
    out_path: str,
    headers: Mapping[int, list[str] | str] | None = None,
    keep: int | Sequence[str] = KEPT_COLUMNS,
) -> DataFrame:
    """Raw yearly CSVs -> cleaned Parquet at ``out_path`` (partitioned by
    fiscal year) -> the table read back from Parquet."""
    raw = read_years(spark, paths, headers, as_text=True)
    names = kept_names(keep) if isinstance(keep, int) else list(keep)

    def typed(df: DataFrame) -> DataFrame:
        return pad_columns(cast_columns(df), names)

    cleaned = combine_years({year: clean_year(df, year, keep=names, cast=typed) for year, df in raw.items()})
    write_clean(cleaned, out_path, "fiscal_year", parted=True)
    return read_clean(spark, out_path)


def case_study(
    t: DataFrame,
    times: DataFrame | None = None,
    fines: DataFrame | None = None,
    fines_rows: int | None = None,
    r: Roles = DEFAULT_ROLES,
    given_precincts: Sequence[int] = (0, 19, 14),
    given_codes: Sequence = (14, 21, 38),
    years: Sequence[int] | None = None,
    mode: str = CLOCK,
    exclude_precincts: Sequence[int] | None = None,
    shared_scan: bool = False,
) -> dict[str, DataFrame]:
    """Every question over the cleaned table ``t``.

    ``times`` is the table the clock questions use (the case study uses the
    same ticket table; default ``t``).  Revenue questions need ``fines``.
    ``exclude_precincts`` keeps placeholder precincts (e.g. 0) out of the
    precinct rankings.  ``shared_scan=True`` answers them all from two
    grouping-sets aggregates (one scan of each table, see ``shared.py``)
    instead of one scan per question; the answers are the same.  The two
    aggregates are computed and written (under the checkpoint folder) when
    this is called; the questions stay lazy.
    """
    tt = t if times is None else times
    if shared_scan:
        from ticketlens.plans import shared

        cube = shared.ticket_cube(t, r).materialize("ticket_cube")
        tcube = shared.time_cube(tt, r, mode).materialize("time_cube")
        out = shared.ticket_questions(cube, r, fines, fines_rows, given_precincts, years, exclude_precincts)
        out.update(shared.time_questions(tcube, r, given_codes))
        return out
    ex = list(exclude_precincts) if exclude_precincts else None
    out: dict[str, DataFrame] = {
        "tickets_per_year": q.tickets_per_year(t, r),
        "unique_states": q.unique_states(t, r),
        "missing_address_3": q.missing_address(t, r),
        "missing_address_2": q.missing_address(t, r, r.street_address),
        "top5_code": q.top_items_per_year(t, r.code, 5, r),
        "top5_body": q.top_items_per_year(t, r.body, 5, r),
        "top5_make": q.top_items_per_year(t, r.make, 5, r),
        "top5_viol_precinct": q.top_items_per_year(t, r.violation_precinct, 5, r, exclude=ex),
        "top5_issuer_precinct": q.top_items_per_year(t, r.issuer_precinct, 5, r, exclude=ex),
        "global_top_precincts": q.busiest_precincts(t, 3, r, ex),
        "precinct_code_freq": q.precinct_code_freq(t, given_precincts, r),
        "top5_code_per_precinct": q.top_codes_per_precinct(t, 5, 3, r, ex),
        "common_codes": q.common_codes_precincts(t, 5, 3, r, ex),
        "precinct_code_lift": q.precinct_code_lift(t, 3, r, ex),
        "rank_list_precinct": q.rank_list_precinct(t, 5, 3, r, ex),
        "missing_time_count": q.missing_time_count(tt, r, mode),
        "top3_code_per_bin": q.top_codes_per_bin(tt, 3, r, mode),
        "bins_for_codes": q.bins_for_codes(tt, given_codes, r, mode),
        "top5_bin_per_code": q.top_bins_per_code(tt, 5, 3, r, mode),
        "rank_list_bin": q.rank_list_bin(tt, 3, r, mode, pad=2),
        "rank_list_code": q.rank_list_code(tt, 5, 3, r, mode),
        "common_codes_bins": q.common_codes_bins(tt, 3, r, mode),
        "tickets_per_season": q.tickets_per_season(t, r),
        "top3_code_per_season": q.top_codes_per_season(t, 3, r),
        "rank_list_season": q.rank_list_season(t, 3, r),
        "common_codes_seasons": q.common_codes_seasons(t, 3, r),
        "top4_code": q.top_codes_by_tickets(t, 4, r),
        "yoy_tickets": q.tickets_change(t, r),
        "pivot_years": q.codes_by_year(t, years, r),
        "facet_frame": q.chart_top_codes(t, 5, r),
    }
    if fines is not None:
        out.update(
            {
                "fines_join": q.code_fines(t, fines, 4, r, fines_rows),
                "revenue": q.code_revenue(t, fines, 4, r, fines_rows),
                "revenue_rollup": q.revenue_by_year(t, fines, 4, r, fines_rows),
                "top_revenue_code": q.best_revenue_code(t, fines, 4, r, fines_rows),
                "yoy_revenue": q.revenue_change(t, fines, 4, r, fines_rows),
            }
        )
    return out


def chart_tables(results: Mapping[str, DataFrame], r: Roles = DEFAULT_ROLES) -> dict[str, DataFrame]:
    """Long, chart-ready tables for the eleven bar charts of the analysis
    (x as text, y, fill, facet row / column), from ``case_study`` results.
    Drawing is left to the client; these are the data behind each chart."""
    y = r.year
    specs = {
        "codes": ("top5_code", r.code, "frequency", None),
        "body_types": ("top5_body", r.body, "frequency", None),
        "makes": ("top5_make", r.make, "frequency", None),
        "violation_precincts": ("top5_viol_precinct", r.violation_precinct, "frequency", None),
        "issuer_precincts": ("top5_issuer_precinct", r.issuer_precinct, "frequency", None),
        "codes_per_precinct": ("top5_code_per_precinct", r.code, "frequency", r.issuer_precinct),
        "codes_per_bin": ("top3_code_per_bin", r.code, "frequency", r.time_of_day),
        "bins_per_code": ("top5_bin_per_code", r.time_of_day, "frequency", r.code),
        "seasons": ("tickets_per_season", r.season, "frequency", None),
        "codes_per_season": ("top3_code_per_season", r.code, "frequency", r.season),
        "revenue": ("revenue", r.code, "revenue", None),
    }
    return {
        name: facet_frame(results[key], x=x, y=value, fill=x, facet_row=row, facet_col=y)
        for name, (key, x, value, row) in specs.items()
        if key in results
    }
