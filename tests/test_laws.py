"""Consistency laws between questions, checked on the driver's tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SMALL_SF
from ticketlens.plans import questions as q
from ticketlens.plans.catalog import mapping_fines
from ticketlens.operators import dedupe, duplicate_report
from ticketlens.sources.tables import raw_tickets, ticket_times, tickets


@pytest.fixture(scope="module")
def t(spark):
    df = tickets(spark, SMALL_SF).cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def tt(spark):
    df = ticket_times(spark, SMALL_SF).cache()
    yield df
    df.unpersist()


def test_seasons_add_up_to_year(t):
    seasons = {}
    for r in q.tickets_per_season(t).collect():
        seasons[r.fiscal_year] = seasons.get(r.fiscal_year, 0) + r.frequency
    years = {r.fiscal_year: r.n_tickets for r in q.tickets_per_year(t).collect()}
    assert seasons == years


def test_bin_tables_agree_on_shared_cells(tt):
    by_bin = {(r.fiscal_year, r.time_of_day, r.violation_code): r.frequency for r in q.top_codes_per_bin(tt).collect()}
    by_code = {(r.fiscal_year, r.time_of_day, r.violation_code): r.frequency for r in q.top_bins_per_code(tt).collect()}
    shared = set(by_bin) & set(by_code)
    assert shared
    assert all(by_bin[k] == by_code[k] for k in shared)


def test_revenue_is_frequency_times_fine(spark, t):
    fines, n = mapping_fines(spark)
    rev = q.code_revenue(t, fines, 4, fines_rows=n).collect()
    for r in rev:
        fine = 0 if r.violation_code == 36 else 2 * r.violation_code + 5
        assert r.revenue == r.frequency * fine
    totals = {r.fiscal_year: r.revenue for r in q.revenue_by_year(t, fines, 4, fines_rows=n).collect() if r.level == 1}
    sums = {}
    for r in rev:
        sums[r.fiscal_year] = sums.get(r.fiscal_year, 0) + r.revenue
    assert totals == sums


def test_two_column_missing_at_least_three_column(t):
    three = {r.fiscal_year: r.n_missing for r in q.missing_address(t).collect()}
    two = {r.fiscal_year: r.n_missing for r in q.missing_address(t, columns=["house_number", "street_name"]).collect()}
    assert all(two.get(y, 0) >= n for y, n in three.items())


def test_binned_counts_within_yearly_totals(tt):
    binned = {}
    for r in q.freq_bin_code(tt).collect():
        binned[(r.fiscal_year, r.violation_code)] = binned.get((r.fiscal_year, r.violation_code), 0) + r.frequency
    totals = {(r.fiscal_year, r.violation_code): r.frequency for r in q.item_frequency(tt, "violation_code", count_nulls=True).collect()}
    assert all(binned[k] <= totals[k] for k in binned)
    missing = q.missing_time_count(tt).collect()[0].n_missing
    assert sum(totals.values()) - sum(binned.values()) == missing


def test_distinct_at_most_rows_and_filter_only_drops(spark):
    raw = raw_tickets(spark, SMALL_SF)
    rep = duplicate_report(raw).collect()[0]
    assert rep.distinct_rows <= rep.n_rows and rep.duplicates == rep.n_rows - rep.distinct_rows
    assert dedupe(raw).count() == rep.distinct_rows
    from ticketlens.operators import clean_year

    cleaned = clean_year(raw, "file_year", keep=["summons_number", "issue_date"])
    assert cleaned.count() <= rep.distinct_rows


def test_clock_mode_hour_matches_timestamp(tt):
    df = q.with_clock(tt).where(F.col("event_id") % 97 != 0).where(F.col("event_id") % 89 != 0)
    bad = df.where(F.floor(F.col("minute_of_day") / 60) != F.hour("ts")).count()
    assert bad == 0


def test_additive_mode_moves_noon_to_midnight(tt):
    df = q.with_clock(tt, mode="additive").where(F.col("violation_time").startswith("12") & F.col("violation_time").endswith("P"))
    hours = {r[0] for r in df.select(F.floor(F.col("minute_of_day") / 60)).distinct().collect()}
    assert hours <= {0}
