"""Column roles.

Every operator takes column names, never positions, so the same code runs on
the raw ticket CSVs (snake_case after load) and on any other table that plays
the same roles.  ``Roles`` bundles the names the questions need.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Roles:
    year: str = "fiscal_year"
    date: str = "issue_date"
    summons: str = "summons_number"
    state: str = "registration_state"
    code: str = "violation_code"
    body: str = "vehicle_body_type"
    make: str = "vehicle_make"
    violation_precinct: str = "violation_precinct"
    issuer_precinct: str = "issuer_precinct"
    address: tuple[str, ...] = ("house_number", "street_name", "intersecting_street")
    street_address: tuple[str, ...] = ("house_number", "street_name")
    time: str = "violation_time"
    from_hours: str = "from_hours_in_effect"
    minute_of_day: str = "minute_of_day"
    time_of_day: str = "time_of_day"
    season: str = "season"


DEFAULT_ROLES = Roles()
