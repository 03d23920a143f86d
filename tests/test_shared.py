"""The shared-scan answers equal the question-by-question answers."""

import pytest

from conftest import SMALL_SF
from ticketlens.plans.catalog import GIVEN_EVENT_CODES, PIVOT_YEARS, mapping_fines
from ticketlens.plans.report import case_study
from ticketlens.sources.tables import ticket_times, tickets


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr), cols


@pytest.fixture(scope="module")
def both(spark):
    t = tickets(spark, SMALL_SF)
    tt = ticket_times(spark, SMALL_SF)
    fines, n = mapping_fines(spark)
    kw = dict(times=tt, fines=fines, fines_rows=n, given_codes=GIVEN_EVENT_CODES, years=PIVOT_YEARS)
    return case_study(t, **kw), case_study(t, shared_scan=True, **kw)


def test_same_questions(both):
    direct, shared = both
    assert set(direct) == set(shared)


@pytest.mark.parametrize(
    "name",
    [
        "tickets_per_year", "unique_states", "missing_address_3", "missing_address_2", "top5_code", "top5_body",
        "top5_make", "top5_viol_precinct", "top5_issuer_precinct", "global_top_precincts", "precinct_code_freq",
        "top5_code_per_precinct", "common_codes", "precinct_code_lift", "rank_list_precinct", "missing_time_count",
        "top3_code_per_bin", "bins_for_codes", "top5_bin_per_code", "rank_list_bin", "rank_list_code",
        "common_codes_bins", "tickets_per_season", "top3_code_per_season", "rank_list_season",
        "common_codes_seasons", "top4_code", "yoy_tickets", "pivot_years", "facet_frame", "fines_join", "revenue",
        "revenue_rollup", "top_revenue_code", "yoy_revenue",
    ],
)
def test_shared_equals_direct(both, name):
    direct, shared = both
    d_rows, d_cols = _rows(direct[name])
    s_rows, s_cols = _rows(shared[name])
    assert s_cols == d_cols
    assert s_rows == d_rows


def test_shared_scan_reads_each_table_once(spark):
    from ticketlens.plans.shared import ticket_cube

    t = tickets(spark, SMALL_SF)
    from conftest import plan_text

    plan = plan_text(ticket_cube(t).df)
    assert plan.count("lineitem.parquet") == 1
    assert "Expand" in plan


def test_chart_tables_cover_every_chart(both):
    from ticketlens.plans.report import chart_tables

    direct, _ = both
    charts = chart_tables(direct)
    assert len(charts) == 11
    for name, df in charts.items():
        assert {"x", "y", "fill", "facet_col"} <= set(df.columns), name
        assert dict(df.dtypes)["x"] == "string"
    row = charts["codes_per_bin"].collect()[0]
    assert row.facet_row is not None and row.facet_col is not None


def test_rows_enter_the_ticket_cube_six_times(spark):
    """Ten sets, four of them summed from finer ones: one scan, six copies of a row before the partial aggregate."""
    from conftest import SMALL_SF, plan_text

    from ticketlens.plans.shared import ticket_cube
    from ticketlens.sources.sink import materialize
    from ticketlens.sources.tables import tickets

    clean = materialize(tickets(spark, SMALL_SF), "tickets_cube_plan")
    cube = ticket_cube(clean).df
    cube.collect()
    final = plan_text(cube).split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1
    projections = next(line for line in plan_text(cube, "extended").splitlines() if "Expand [" in line)
    assert projections.count("], [") == 6  # six lists and the output
    assert spark.createDataFrame([], clean.schema).transform(lambda e: ticket_cube(e).df).collect() == []
