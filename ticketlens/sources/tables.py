"""The driver's parquet tables, and the ticket-shaped views built from them.

The real ticket files are not available to the test driver, so the questions
run on two projections of its star schema (the same text is in the oracle
SQL):

* ``tickets``: one row per line item, with the roles the counting questions
  need (date, fiscal year, code, precincts, body, make, state, address).
* ``ticket_times``: one row per event, with a clock-text column in the
  ``HHMM`` + ``A``/``P`` shape and dirty values mixed in.
* ``raw_tickets``: text dates, exact duplicate rows, an all-NULL column and
  a "file year" that does not always match the date - the shape of a raw
  yearly file before cleaning.

Only the columns a view needs are selected, so the Parquet scans read just
those (``ReadSchema`` in the plan).
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions.dates import fiscal_year_of
from ticketlens.operators.joins import counted_small_side

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _orders(spark: SparkSession, sf_dir: str, with_state: bool = True) -> DataFrame:
    """orders -> (o_orderkey, o_orderdate, o_orderstatus[, n_name]).

    customer and nation are joined to orders first: the result is
    orders-sized, so lineitem is shuffled only once per join key.  nation is
    broadcast if its counted rows are few; the other sides become broadcast
    joins at run time once AQE has measured their shuffle stage, or stay
    sort-merge joins.
    """
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"
    )
    if not with_state:
        return orders.drop("o_custkey")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = counted_small_side(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    cust_state = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        "c_custkey", "n_name"
    )
    return orders.join(cust_state, orders.o_custkey == cust_state.c_custkey).select(
        "o_orderkey", "o_orderdate", "o_orderstatus", "n_name"
    )


# Columns of the tickets view by the table they come from.
LINE_COLUMNS = (
    "summons_number",
    "issue_date",
    "fiscal_year",
    "violation_code",
    "issuer_precinct",
    "violation_precinct",
    "house_number",
    "street_name",
    "amount",
)
PART_COLUMNS = ("vehicle_body_type", "vehicle_make")
STATE_COLUMNS = ("registration_state",)
ORDER_COLUMNS = ("intersecting_street",)
TICKET_COLUMNS = (
    *LINE_COLUMNS[:6],
    *PART_COLUMNS,
    *STATE_COLUMNS,
    "house_number",
    "street_name",
    *ORDER_COLUMNS,
    "amount",
)


def tickets(spark: SparkSession, sf_dir: str, columns: Sequence[str] = TICKET_COLUMNS) -> DataFrame:
    """Ticket-shaped view over lineitem, orders, customer, nation and part.

    Only the tables that ``columns`` need are joined.  Every line has its
    order, customer, nation and part (the keys are complete), so a join left
    out changes no row.
    """
    wanted = set(columns)
    issue_date = F.col("l_shipdate").cast("date")
    value = {
        "summons_number": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "issue_date": issue_date,
        "fiscal_year": fiscal_year_of(issue_date),
        "violation_code": F.col("l_quantity").cast("int"),
        "issuer_precinct": F.col("l_suppkey") % 25,
        "violation_precinct": F.col("l_partkey") % 78,
        "vehicle_body_type": F.nullif(F.col("p_type"), F.lit("STANDARD")),
        "vehicle_make": F.col("p_brand"),
        "registration_state": F.col("n_name"),
        "house_number": F.nullif(F.col("l_returnflag"), F.lit("R")),
        "street_name": F.nullif(F.col("l_linestatus"), F.lit("O")),
        "intersecting_street": F.nullif(F.col("o_orderstatus"), F.lit("P")),
        "amount": F.col("l_extendedprice"),
    }
    joined = read_table(spark, sf_dir, "lineitem")
    with_state = bool(wanted.intersection(STATE_COLUMNS))
    if with_state or wanted.intersection(ORDER_COLUMNS):
        orders = _orders(spark, sf_dir, with_state)
        joined = joined.join(orders, joined.l_orderkey == orders.o_orderkey)
    if wanted.intersection(PART_COLUMNS):
        part = read_table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
        joined = joined.join(part, joined.l_partkey == part.p_partkey)
    return joined.select(*[value[c].alias(c) for c in columns])


def ticket_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clock-text view over events (dirty values: NULLs and an impossible hour)."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    clock_text = F.concat(
        F.date_format("ts", "hhmm"), F.substring(F.date_format("ts", "a"), 1, 1)
    )
    return ev.select(
        "event_id",
        (F.lit(2015) + F.col("user_id") % 3).cast("int").alias("fiscal_year"),
        F.col("event_type").alias("violation_code"),
        "ts",
        F.when(F.col("event_id") % 97 == 0, F.lit(None).cast("string"))
        .when(F.col("event_id") % 89 == 0, F.lit("8752A"))
        .otherwise(clock_text)
        .alias("violation_time"),
        F.when(F.col("event_id") % 2 == 0, F.lit("ALL"))
        .otherwise(F.lit("0800A"))
        .alias("from_hours_in_effect"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-file-shaped view: one row per line item, but only order-level
    columns plus the line's return flag, so lines of one order repeat as
    exact duplicates.  ``file_year`` is the fiscal year of the ship date;
    ``issue_date`` is the order date as ``MM/dd/yyyy`` text, which may fall
    before that fiscal year (those rows are cut by the fiscal filter)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_returnflag", "l_shipdate")
    orders = _orders(spark, sf_dir)
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return joined.select(
        fiscal_year_of(F.col("l_shipdate").cast("date")).alias("file_year"),
        F.col("o_orderkey").alias("summons_number"),
        F.col("n_name").alias("registration_state"),
        F.col("l_returnflag").alias("plate_type"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("issue_date"),
        F.col("o_orderstatus").alias("street_name"),
        F.lit(None).cast("string").alias("no_standing_or_stopping_violation"),
    )
