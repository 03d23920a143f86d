"""The questions follow the Roles they are given, not fixed column names."""

from pyspark.sql import functions as F

from conftest import SMALL_SF
from ticketlens.plans import questions as q
from ticketlens.roles import Roles
from ticketlens.sources.tables import tickets


def test_questions_on_renamed_columns(spark):
    t = tickets(spark, SMALL_SF)
    renamed = t.select([F.col(c).alias(f"x_{c}") for c in t.columns])
    r = Roles(
        year="x_fiscal_year",
        date="x_issue_date",
        summons="x_summons_number",
        state="x_registration_state",
        code="x_violation_code",
        body="x_vehicle_body_type",
        make="x_vehicle_make",
        violation_precinct="x_violation_precinct",
        issuer_precinct="x_issuer_precinct",
        address=("x_house_number", "x_street_name", "x_intersecting_street"),
        street_address=("x_house_number", "x_street_name"),
    )
    pairs = [
        (q.tickets_per_year(t), q.tickets_per_year(renamed, r)),
        (q.unique_states(t), q.unique_states(renamed, r)),
        (q.missing_address(t), q.missing_address(renamed, r)),
        (q.top_items_per_year(t, "violation_code", 5), q.top_items_per_year(renamed, "x_violation_code", 5, r)),
        (q.rank_list_precinct(t), q.rank_list_precinct(renamed, r=r)),
        (q.top_codes_per_season(t), q.top_codes_per_season(renamed, r=r)),
    ]
    for a, b in pairs:
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
