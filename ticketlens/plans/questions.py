"""The case study's questions as compositions of the operators.

Each function takes a cleaned ticket table (any DataFrame with the columns
named in ``Roles``) and returns a lazy DataFrame; nothing is collected.
Questions that count items themselves use ``count(item)`` (the NULL item
scores 0) and those that count tickets use ``count(*)``, as in the case
study.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.clock import CLOCK, fill_time, hour_of, minute_of_day
from ticketlens.functions.labels import bin_initials, season_label, time_bin
from ticketlens.operators.compare import common_items, facet_frame, pivot_years, share_lift, yoy
from ticketlens.operators.freq import frequency, rank_list, top_n, top_n_per_group
from ticketlens.operators.joins import lookup, restrict_to
from ticketlens.operators.profile import missing_count
from ticketlens.operators.revenue import (
    fines_join,
    revenue,
    revenue_rollup,
    top_revenue_code,
    yearly_revenue,
)
from ticketlens.roles import DEFAULT_ROLES, Roles

R = DEFAULT_ROLES


# --- examine the data -------------------------------------------------------


def tickets_per_year(t: DataFrame, r: Roles = R) -> DataFrame:
    return t.groupBy(r.year).agg(F.count(r.summons).alias("n_tickets")).orderBy(r.year)


def unique_states(t: DataFrame, r: Roles = R, approx_rsd: float | None = None) -> DataFrame:
    """Distinct registration states per year.  Exact by default (Spark
    expands it to a two-level aggregate, so no task sees more than one row
    per year and state); ``approx_rsd`` switches to HyperLogLog++ with that
    relative error, for very high-cardinality columns."""
    if approx_rsd is None:
        agg = F.countDistinct(r.state)
    else:
        agg = F.approx_count_distinct(r.state, rsd=approx_rsd)
    return t.groupBy(r.year).agg(agg.alias("n_states")).orderBy(r.year)


def missing_address(t: DataFrame, r: Roles = R, columns: Sequence[str] | None = None) -> DataFrame:
    """Tickets with every address column NULL, per year."""
    cols = list(columns or r.address)
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNull()
    return t.where(cond).groupBy(r.year).agg(F.count(r.year).alias("n_missing")).orderBy(r.year)


# --- frequencies and top-N --------------------------------------------------


def item_frequency(
    t: DataFrame, item: str, r: Roles = R, count_nulls: bool = False, exclude: Sequence | None = None
) -> DataFrame:
    return frequency(t, r.year, item, count_nulls=count_nulls, exclude=exclude)


def top_items_per_year(
    t: DataFrame,
    item: str,
    n: int = 5,
    r: Roles = R,
    count_nulls: bool = False,
    exclude: Sequence | None = None,
) -> DataFrame:
    """Top ``n`` values of ``item`` per year (dense rank: ties kept).
    ``exclude`` leaves out placeholder values such as precinct 0."""
    return top_n_per_group(item_frequency(t, item, r, count_nulls, exclude), r.year, "frequency", n)


def busiest_precincts(t: DataFrame, n: int = 3, r: Roles = R, exclude: Sequence | None = None) -> DataFrame:
    """The ``n`` issuer precincts with most tickets over all years (ties:
    smaller precinct first)."""
    freq = frequency(t, None, r.issuer_precinct, exclude=exclude)
    return top_n(freq, "frequency", n, tiebreak=[r.issuer_precinct])


def precinct_code_freq(t: DataFrame, precincts: Sequence[int], r: Roles = R) -> DataFrame:
    """Code counts per (year, precinct) for a given precinct list."""
    sub = t.where(F.col(r.issuer_precinct).isin(list(precincts)))
    return frequency(sub, [r.year, r.issuer_precinct], r.code)


def precinct_code_freq_derived(
    t: DataFrame, n_precincts: int = 3, r: Roles = R, exclude: Sequence | None = None
) -> DataFrame:
    """Same, for the ``n_precincts`` busiest precincts found in the data
    (``exclude`` keeps placeholder precincts out of that ranking)."""
    counts = _precinct_code_counts(t.where(F.col(r.issuer_precinct).isNotNull()), r)
    keys = _busiest_of(counts, n_precincts, r, exclude)
    kept = lookup(counts, keys, r.issuer_precinct, row_bound=n_precincts)
    return kept.select(r.year, r.issuer_precinct, r.code, _item_count(r.code).alias("frequency"))


def _precinct_code_counts(t: DataFrame, r: Roles) -> DataFrame:
    """The one aggregate behind the precinct questions: their ranking and
    their counts both come from it, so the tickets are read once (the two uses
    have the same plan and share one exchange)."""
    return t.groupBy(r.year, r.issuer_precinct, r.code).agg(F.count(F.lit(1)).alias("n_rows"))


def _item_count(item: str) -> Column:
    """``count(item)`` of a group that has the item among its keys."""
    return F.when(F.col(item).isNull(), F.lit(0)).otherwise(F.col("n_rows")).cast("long")


def _busiest_of(counts: DataFrame, n: int, r: Roles, exclude: Sequence | None) -> DataFrame:
    """``busiest_precincts`` from the aggregate instead of the tickets."""
    p = F.col(r.issuer_precinct)
    if exclude:
        counts = counts.where(~p.isin(list(exclude)) | p.isNull())
    totals = counts.groupBy(r.issuer_precinct).agg(
        F.sum(_item_count(r.issuer_precinct)).alias("total")
    )
    return top_n(totals, "total", n, tiebreak=[r.issuer_precinct]).select(r.issuer_precinct)


def top_codes_per_precinct(
    t: DataFrame, n: int = 5, n_precincts: int = 3, r: Roles = R, exclude: Sequence | None = None
) -> DataFrame:
    freq = precinct_code_freq_derived(t, n_precincts, r, exclude)
    return top_n_per_group(freq, [r.year, r.issuer_precinct], "frequency", n)


def common_codes_precincts(
    t: DataFrame, n: int = 5, n_precincts: int = 3, r: Roles = R, exclude: Sequence | None = None
) -> DataFrame:
    top = top_codes_per_precinct(t, n, n_precincts, r, exclude)
    return common_items(top, r.year, r.code, r.issuer_precinct)


def precinct_code_lift(
    t: DataFrame, n_precincts: int = 3, r: Roles = R, exclude: Sequence | None = None
) -> DataFrame:
    """Share of each code inside each busy precinct against the code's
    share of all tickets that year."""
    counts = _precinct_code_counts(t, r)
    freq = counts.select(r.year, r.issuer_precinct, r.code, _item_count(r.code).alias("frequency"))
    lift = share_lift(freq, r.year, r.issuer_precinct, r.code)
    keys = _busiest_of(counts, n_precincts, r, exclude)
    return restrict_to(lift, keys, r.issuer_precinct, row_bound=n_precincts)


def rank_list_precinct(
    t: DataFrame, n: int = 5, n_precincts: int = 3, r: Roles = R, exclude: Sequence | None = None
) -> DataFrame:
    top = top_codes_per_precinct(t, n, n_precincts, r, exclude)
    return rank_list(top, [r.year, r.issuer_precinct], r.code, pad=2)


# --- time of day --------------------------------------------------------------


def with_clock(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    """Fill the clock text from ``from_hours`` and add ``minute_of_day``."""
    filled = t.withColumn(r.time, fill_time(r.time, r.from_hours))
    return filled.withColumn(r.minute_of_day, minute_of_day(r.time, mode))


def missing_time_count(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return missing_count(with_clock(t, r, mode), r.minute_of_day)


def drop_missing_time(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return with_clock(t, r, mode).where(F.col(r.minute_of_day).isNotNull())


def binned(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    """Rows with a usable time, labelled with their time-of-day bin."""
    return drop_missing_time(t, r, mode).withColumn(
        r.time_of_day, time_bin(hour_of(r.minute_of_day))
    )


def freq_bin_code(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return frequency(binned(t, r, mode), [r.year, r.time_of_day], r.code, count_nulls=True)


def top_codes_per_bin(t: DataFrame, n: int = 3, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return top_n_per_group(freq_bin_code(t, r, mode), [r.year, r.time_of_day], "frequency", n)


def bins_for_codes(t: DataFrame, codes: Sequence, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    b = binned(t, r, mode).where(F.col(r.code).isin(list(codes)))
    return frequency(b, [r.year, r.code], r.time_of_day, count_nulls=True)


def top_codes_overall(t: DataFrame, n: int = 3, r: Roles = R) -> DataFrame:
    """The ``n`` most frequent codes over all years (ties: smaller code; NULL is no code)."""
    return top_n(frequency(t.where(F.col(r.code).isNotNull()), None, r.code, count_nulls=True), "frequency", n, tiebreak=[r.code])


def bins_for_top_codes(t: DataFrame, n_codes: int = 3, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    known = binned(t, r, mode).where(F.col(r.code).isNotNull())
    counts = frequency(known, [r.year, r.code], r.time_of_day, count_nulls=True)
    totals = counts.groupBy(r.code).agg(F.sum("frequency").alias("total"))
    keys = top_n(totals, "total", n_codes, tiebreak=[r.code]).select(r.code)
    return lookup(counts, keys, r.code, row_bound=n_codes).select(r.year, r.code, r.time_of_day, "frequency")


def top_bins_per_code(t: DataFrame, n: int = 5, n_codes: int = 3, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return top_n_per_group(bins_for_top_codes(t, n_codes, r, mode), [r.year, r.code], "frequency", n)


def rank_list_bin(t: DataFrame, n: int = 3, r: Roles = R, mode: str = CLOCK, pad: int | None = None) -> DataFrame:
    return rank_list(top_codes_per_bin(t, n, r, mode), [r.year, r.time_of_day], r.code, pad=pad)


def rank_list_code(t: DataFrame, n: int = 5, n_codes: int = 3, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    top = top_bins_per_code(t, n, n_codes, r, mode)
    return rank_list(top, [r.year, r.code], bin_initials(r.time_of_day))


def common_codes_bins(t: DataFrame, n: int = 3, r: Roles = R, mode: str = CLOCK) -> DataFrame:
    return common_items(top_codes_per_bin(t, n, r, mode), r.year, r.code, r.time_of_day)


# --- seasons ------------------------------------------------------------------


def with_season(t: DataFrame, r: Roles = R) -> DataFrame:
    return t.withColumn(r.season, season_label(F.month(r.date)))


def tickets_per_season(t: DataFrame, r: Roles = R) -> DataFrame:
    freq = frequency(with_season(t, r), r.year, r.season, count_nulls=True)
    return freq.orderBy(F.col("frequency").desc(), r.year, r.season)


def freq_season_code(t: DataFrame, r: Roles = R) -> DataFrame:
    return frequency(with_season(t, r), [r.year, r.season], r.code, count_nulls=True)


def top_codes_per_season(t: DataFrame, n: int = 3, r: Roles = R) -> DataFrame:
    return top_n_per_group(freq_season_code(t, r), [r.year, r.season], "frequency", n)


def rank_list_season(t: DataFrame, n: int = 3, r: Roles = R, pad: int | None = 2) -> DataFrame:
    return rank_list(top_codes_per_season(t, n, r), [r.year, r.season], r.code, pad=pad)


def common_codes_seasons(t: DataFrame, n: int = 3, r: Roles = R) -> DataFrame:
    return common_items(top_codes_per_season(t, n, r), r.year, r.code, r.season)


# --- fines and revenue --------------------------------------------------------


def top_codes_by_tickets(t: DataFrame, n: int = 4, r: Roles = R) -> DataFrame:
    """Top ``n`` codes per year by ``count(*)``; 4 in the case study because
    one of the top 3 has no published fine."""
    return top_items_per_year(t, r.code, n, r, count_nulls=True)


def code_revenue(
    t: DataFrame, fines: DataFrame, n: int = 4, r: Roles = R, fines_rows: int | None = None
) -> DataFrame:
    return revenue(top_codes_by_tickets(t, n, r), fines, r.code, fines_rows=fines_rows)


def code_fines(
    t: DataFrame, fines: DataFrame, n: int = 4, r: Roles = R, fines_rows: int | None = None
) -> DataFrame:
    return fines_join(top_codes_by_tickets(t, n, r), fines, r.code, fines_rows=fines_rows)


def revenue_by_year(
    t: DataFrame, fines: DataFrame, n: int = 4, r: Roles = R, fines_rows: int | None = None
) -> DataFrame:
    return revenue_rollup(code_revenue(t, fines, n, r, fines_rows), r.year, r.code)


def best_revenue_code(
    t: DataFrame, fines: DataFrame, n: int = 4, r: Roles = R, fines_rows: int | None = None
) -> DataFrame:
    return top_revenue_code(code_revenue(t, fines, n, r, fines_rows), r.year, r.code)


def revenue_change(
    t: DataFrame, fines: DataFrame, n: int = 4, r: Roles = R, fines_rows: int | None = None
) -> DataFrame:
    return yoy(yearly_revenue(code_revenue(t, fines, n, r, fines_rows), r.year), "total_revenue", r.year)


def tickets_change(t: DataFrame, r: Roles = R) -> DataFrame:
    return yoy(tickets_per_year(t, r), "n_tickets", r.year)


# --- side-by-side and chart tables ----------------------------------------------


def codes_by_year(t: DataFrame, years: Sequence[int] | None = None, r: Roles = R) -> DataFrame:
    return pivot_years(t, r.code, r.year, years)


def chart_top_codes(t: DataFrame, n: int = 5, r: Roles = R) -> DataFrame:
    top = top_items_per_year(t, r.code, n, r)
    return facet_frame(top, x=r.code, y="frequency", fill=r.code, facet_col=r.year)
