"""Sources and sinks: raw yearly CSVs, the driver's parquet tables, cleaned Parquet."""

from ticketlens.sources.csv import RAW_COLUMNS, kept_names, raw_schema, read_year, read_years, snake_case
from ticketlens.sources.sink import materialize, read_clean, write_clean, write_profiled
from ticketlens.sources.tables import raw_tickets, read_table, ticket_times, tickets

__all__ = [
    "RAW_COLUMNS",
    "kept_names",
    "materialize",
    "raw_schema",
    "raw_tickets",
    "read_clean",
    "read_table",
    "read_year",
    "read_years",
    "snake_case",
    "ticket_times",
    "tickets",
    "write_clean",
    "write_profiled",
]
