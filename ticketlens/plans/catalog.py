"""Registered queries over the driver's tables, each with its DuckDB oracle.

``QUERIES[name](spark, sf_dir)`` returns a lazy DataFrame; ``ORACLE[name]``
is the same question as DuckDB SQL over the raw parquet views.  Column names
and types are aliased identically on both sides (INT years and ranks, BIGINT
counts, DOUBLE money and ratios).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.functions.clock import ADDITIVE, CLOCK, clock_string, clock_timestamp, hour_of
from ticketlens.functions.dates import parse_date
from ticketlens.operators import clean, profile
from ticketlens.operators.compare import facet_frame
from ticketlens.operators.revenue import average_fine, fines_frame
from ticketlens.operators.joins import lookup
from ticketlens.plans import questions as q
from ticketlens.sources.tables import (
    LINE_COLUMNS,
    TICKET_COLUMNS,
    raw_tickets,
    read_table,
    table_path,
    ticket_times,
    tickets,
)

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed values for the test mapping.  The case study's literal precinct list
# and the "three most common" codes it pasted into its SQL; for the event
# view the given list is three of its event types.
GIVEN_PRECINCTS = (0, 19, 14)
GIVEN_EVENT_CODES = ("click", "error", "view")
PIVOT_YEARS = tuple(range(1995, 2001))  # tickets of other years are counted in fy_other
GIVEN_FISCAL_YEAR = 1997
LINEITEM_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
    "l_returnflag l_linestatus l_shipdate"
).split()
# large enough that some code is common to all seasons (bins) of a year
COMMON_CODES_N = 20
COMMON_TYPES_N = 4
# Fines for the test mapping, built from a rule over codes 1..50:
# high = 2*code + 10, low = 2*code (average 2*code + 5); code 36 has no
# published fine; code 99 has a fine but never occurs.
UNKNOWN_FINE_CODE = 36
ABSENT_FINE_CODE = 99


def mapping_fines(spark: SparkSession) -> tuple[DataFrame, int]:
    rows = [
        (c, None, None) if c == UNKNOWN_FINE_CODE else (c, 2 * c + 10, 2 * c)
        for c in range(1, 51)
    ]
    rows.append((ABSENT_FINE_CODE, 40, 30))
    return fines_frame(spark, rows), len(rows)


def _money(df: DataFrame) -> DataFrame:
    """DECIMAL columns as DOUBLE, the last step of every money answer."""
    decimals = [f.name for f in df.schema.fields if f.dataType.typeName() == "decimal"]
    return df.withColumns({c: F.col(c).cast("double") for c in decimals})


def _years(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    t = tickets(spark, sf, LINE_COLUMNS)
    fy = F.col("fiscal_year")
    return {
        "a": t.where(fy <= 1997),
        "b": t.where((fy >= 1998) & (fy <= 1999)),
        "c": t.where(fy >= 2000).drop("amount"),
    }


def _date_text(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    text = (
        F.when(F.col("l_orderkey") % 101 == 0, F.lit("13/45/1997"))
        .when(
            F.col("l_linenumber") == 3,
            F.concat_ws("/", F.month("l_shipdate"), F.dayofmonth("l_shipdate"), F.year("l_shipdate")),
        )
        .otherwise(F.date_format("l_shipdate", "MM/dd/yyyy"))
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("issue_date_text"))


def _view(spark: SparkSession, sf: str, columns: Sequence[str] = TICKET_COLUMNS) -> str:
    """Register the tickets view under a name of its own (concurrent
    queries in one session must not replace each other's view).  Catalyst
    prunes columns, not joins, so a view names the columns its readers need."""
    name = f"tickets_{uuid.uuid4().hex[:12]}"
    tickets(spark, sf, columns).createOrReplaceTempView(name)
    return name


def _sql_view(spark: SparkSession, sf: str) -> DataFrame:
    view = _view(spark, sf, ("fiscal_year", "summons_number"))
    return spark.sql(
        f"SELECT fiscal_year, count(summons_number) AS n_tickets FROM {view} GROUP BY fiscal_year"
    )


def _month_histogram_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The histogram in SQL text, grouping by the SELECT aliases."""
    view = _view(spark, sf, ("issue_date",))
    return spark.sql(
        "SELECT year(issue_date) AS year, month(issue_date) AS month, count(*) AS n "
        f"FROM {view} GROUP BY year, month ORDER BY year, month"
    )


def _fines_table(spark: SparkSession, sf: str) -> DataFrame:
    """Every code seen in the tickets with its fines row (NULL where the
    table has none): which codes the revenue estimate can price."""
    fines, n_rows = mapping_fines(spark)
    codes = tickets(spark, sf, ("violation_code",)).distinct()
    joined = lookup(codes, fines, codes["violation_code"] == fines["code"], "left", row_bound=n_rows)
    return joined.select(
        "violation_code",
        F.col("fine_high").cast("double").alias("fine_high"),
        F.col("fine_low").cast("double").alias("fine_low"),
    )


def _average_fine(spark: SparkSession, sf: str) -> DataFrame:
    """Top codes with their average fine; a code without a fines row keeps
    a NULL fine (LEFT join), an unknown fine shows ``fine_known`` false."""
    fines, n_rows = mapping_fines(spark)
    avg = average_fine(fines)
    top = q.top_codes_by_tickets(_lines(spark, sf), 4)
    joined = lookup(top, avg, top["violation_code"] == avg["code"], "left", row_bound=n_rows)
    known = F.coalesce(F.col("fine_known"), F.lit(False)).alias("fine_known")
    return _money(joined.drop("code")).withColumn("fine_known", known)


def _ticket_cube(spark: SparkSession, sf: str) -> DataFrame:
    from ticketlens.plans.shared import ticket_cube

    return ticket_cube(tickets(spark, sf)).df.withColumnRenamed("_gid", "set_id")


def _time_cube(spark: SparkSession, sf: str) -> DataFrame:
    from ticketlens.plans.shared import time_cube

    return time_cube(ticket_times(spark, sf)).df.withColumnRenamed("_gid", "set_id")


def _scratch_path(spark: SparkSession, kind: str) -> str:
    import os

    from ticketlens.session import ensure_checkpoint_dir

    return os.path.join(ensure_checkpoint_dir(spark), "tables", f"{kind}-{uuid.uuid4().hex[:12]}")


def _write_raw(df: DataFrame, path: str) -> None:
    """Raw CSV part files with a header row, gzipped; a part is read by one task, so its rows are bounded."""
    df.write.option("header", "true").option("compression", "gzip").option("maxRecordsPerFile", RAW_FILE_ROWS).csv(path)


RAW_FILE_ROWS = 500_000
# Ticket columns written into the raw CSV layouts by ``csv_scan``; every other
# column is filled from the summons number by a rule.
CSV_COLUMNS = (
    "summons_number registration_state issue_date violation_code vehicle_body_type vehicle_make "
    "violation_precinct issuer_precinct house_number street_name intersecting_street"
).split()
SHORT_LAYOUT = 43


def _csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """The CSV reader on data derived from the driver's tables: tickets of
    even fiscal years are written with all 51 raw columns, those of odd years
    with 43 in another order (header rows, dates as ``MM/dd/yyyy`` text), and
    both are read in one go, each file by its own header."""
    from ticketlens.sources.csv import RAW_COLUMNS, column_type, read_year, snake_case

    t = tickets(spark, sf).withColumn("issue_date", F.date_format("issue_date", "MM/dd/yyyy"))

    def field(i: int, name: str):
        own = snake_case(name)
        if own in CSV_COLUMNS:
            return F.col(own).cast("string").alias(name)
        rest = (F.col("summons_number") % (i + 2)).cast("string")
        return (rest if column_type(own).typeName() == "integer" else F.concat(F.lit("v"), rest)).alias(name)

    full = [field(i, name) for i, (name, _) in enumerate(RAW_COLUMNS)]
    path = _scratch_path(spark, "csv")
    _write_raw(t.where(F.col("fiscal_year") % 2 == 0).select(*full), f"{path}/even")
    short = full[:SHORT_LAYOUT][::-1]
    _write_raw(t.where(F.col("fiscal_year") % 2 == 1).select(*short), f"{path}/odd")
    return read_year(spark, [f"{path}/even", f"{path}/odd"]).select(*[snake_case(name) for name, _ in RAW_COLUMNS])


SCRIPT_YEARS = (1996, 1997, 1998)


def _whole_script(spark: SparkSession, sf: str) -> DataFrame:
    """The whole analysis, from raw yearly CSV files to the data of its eleven charts.

    Tickets of three fiscal years are written as raw files (the last one with
    43 columns in another order), each with a tenth of its records twice and
    some records of the next fiscal year; then the files are cleaned, every
    question is asked of the cleaned table, and the charts are put together.
    """
    from ticketlens.plans.report import case_study, chart_tables, clean_files
    from ticketlens.sources.csv import RAW_COLUMNS, column_type, snake_case

    number = F.col("summons_number")
    minute = number % 1440
    clock = F.concat(
        F.lpad(F.when(F.floor(minute / 60) % 12 == 0, 12).otherwise(F.floor(minute / 60) % 12).cast("string"), 2, "0"),
        F.lpad((minute % 60).cast("string"), 2, "0"),
        F.when(minute < 720, "A").otherwise("P"),
    )
    own = {
        "issue_date": F.date_format("issue_date", "MM/dd/yyyy"),
        "violation_time": F.when(number % 97 != 0, F.when(number % 89 == 0, "8752A").otherwise(clock)),
        "from_hours_in_effect": F.when(number % 2 == 0, "ALL").otherwise("0800A"),
    }

    def field(i: int, name: str):
        column = snake_case(name)
        if column in own:
            return own[column].alias(name)
        if column in CSV_COLUMNS:
            return F.col(column).cast("string").alias(name)
        rest = (number % (i + 2)).cast("string")
        return (rest if column_type(column).typeName() == "integer" else F.concat(F.lit("v"), rest)).alias(name)

    layout = [field(i, name) for i, (name, _) in enumerate(RAW_COLUMNS)]
    t = tickets(spark, sf)
    paths = {}
    for year in SCRIPT_YEARS:
        late = (F.col("fiscal_year") == year + 1) & (number % 50 == 0)
        rows = t.where((F.col("fiscal_year") == year) | late)
        twice = F.explode(F.array_repeat(F.lit(1), F.when(number % 10 == 0, 2).otherwise(1)))
        fields = layout if year != SCRIPT_YEARS[-1] else layout[:SHORT_LAYOUT][::-1]
        paths[year] = _scratch_path(spark, f"script-{year}")
        _write_raw(rows.select("*", twice.alias("_copy")).select(*fields), paths[year])
    clean_table = clean_files(spark, paths, _scratch_path(spark, "script-clean"), dict.fromkeys(paths, "uniform"))
    fines, n_fines = mapping_fines(spark)
    answers = case_study(clean_table, fines=fines, fines_rows=n_fines, years=SCRIPT_YEARS, shared_scan=True)
    charts = [
        df.select(
            F.lit(name).alias("chart"), "x", F.col("y").cast("double").alias("y"), "fill",
            (F.col("facet_row") if "facet_row" in df.columns else F.lit(None)).cast("string").alias("facet_row"), "facet_col",
        )
        for name, df in chart_tables(answers).items()
    ]
    return reduce(DataFrame.unionByName, charts)


def _drop_empty_columns(spark: SparkSession, sf: str) -> DataFrame:
    """The joins run once: the write counts each column's values, the table is read back without the empty ones."""
    from ticketlens.sources.sink import read_clean, write_profiled

    path = _scratch_path(spark, "profiled")
    profile_of = write_profiled(tickets(spark, sf).withColumn("no_standing_or_stopping_violation", F.lit(None).cast("string")), path)
    return profile.drop_empty_columns(read_clean(spark, path), profile_of)


def _clean_sink(spark: SparkSession, sf: str) -> DataFrame:
    """The Parquet sink partitioned by fiscal year, read back."""
    from ticketlens.sources.sink import read_clean, write_clean

    path = _scratch_path(spark, "clean")
    write_clean(tickets(spark, sf), path, "fiscal_year")
    return read_clean(spark, path)


def _month_histogram_raw(spark: SparkSession, sf: str) -> DataFrame:
    """The check the histogram exists for: months of the parsed issue dates
    per raw file year, before the fiscal filter, so months outside each
    file's fiscal year show up."""
    raw = raw_tickets(spark, sf).select("file_year", parse_date("issue_date").alias("issue_date"))
    return (
        raw.groupBy("file_year", F.year("issue_date").alias("year"), F.month("issue_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("file_year", "year", "month")
    )


def _late(spark: SparkSession, sf: str) -> DataFrame:
    """The event view with some clock texts in 24-hour form (hours above 12,
    with and without the letter), which only the additive arithmetic reads."""
    t = ticket_times(spark, sf)
    hour24 = F.date_format("ts", "HHmm")
    return t.withColumn(
        "violation_time",
        F.when(F.col("event_id") % 11 == 0, hour24)
        .when(F.col("event_id") % 13 == 0, F.concat(hour24, F.lit("A")))
        .otherwise(F.col("violation_time")),
    )


def _tt(spark: SparkSession, sf: str) -> DataFrame:
    return ticket_times(spark, sf)


T = tickets


def _lines(spark: SparkSession, sf: str) -> DataFrame:
    """The tickets view's columns that lineitem alone holds: one scan, no join."""
    return tickets(spark, sf, LINE_COLUMNS)


def _with_column(name: str):
    return lambda s, d: tickets(s, d, (*LINE_COLUMNS, name))


L = _lines


def _gapped(spark: SparkSession, sf: str) -> DataFrame:
    """The line columns with codes and dates missing in some rows, as in real ticket files."""
    missing = lambda column, every: F.when(F.col("summons_number") % every != 0, F.col(column))
    return _lines(spark, sf).withColumns({"violation_code": missing("violation_code", 7), "issue_date": missing("issue_date", 11)})


G = _gapped

QUERIES: dict[str, QueryFn] = {
    # profiling
    "row_count": lambda s, d: profile.row_count(L(s, d)),
    "duplicate_report": lambda s, d: profile.duplicate_report(raw_tickets(s, d)),
    "dedupe": lambda s, d: clean.dedupe(raw_tickets(s, d)),
    "null_profile": lambda s, d: profile.null_profile(T(s, d)),
    "whole_script": _whole_script,
    "stored_profile": lambda s, d: profile.stored_profile(s, table_path(d, "lineitem")),
    "drop_empty_columns": _drop_empty_columns,
    "first_columns": lambda s, d: clean.first_columns(L(s, d), 5),
    "month_histogram": lambda s, d: profile.month_histogram(L(s, d), "issue_date"),
    "parse_issue_date": lambda s, d: _date_text(s, d).withColumn(
        "issue_date", parse_date("issue_date_text")
    ),
    "fiscal_year_label": lambda s, d: clean.label_fiscal_year(
        read_table(s, d, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("summons_number"),
            F.col("l_shipdate").cast("date").alias("issue_date"),
        )
    ),
    "fiscal_filter": lambda s, d: clean.fiscal_filter(
        raw_tickets(s, d).select(
            F.col("file_year").alias("fiscal_year"),
            "summons_number",
            parse_date("issue_date").alias("issue_date"),
        )
    ),
    "fiscal_filter_range": lambda s, d: clean.fiscal_filter(
        read_table(s, d, "lineitem").select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("summons_number"),
            F.col("l_shipdate").cast("date").alias("issue_date"),
        ),
        year=GIVEN_FISCAL_YEAR,
    ),
    "clean_year": lambda s, d: clean.clean_year(
        raw_tickets(s, d),
        "file_year",
        keep=["summons_number", "registration_state", "plate_type", "issue_date", "street_name"],
    ),
    "combine_years": lambda s, d: clean.combine_years(_years(s, d)),
    "csv_scan": _csv_scan,
    "clean_sink": _clean_sink,
    "view_sql": _sql_view,
    "month_histogram_sql": _month_histogram_sql,
    "month_histogram_raw": _month_histogram_raw,
    # examine the data
    "tickets_per_year": lambda s, d: q.tickets_per_year(L(s, d)),
    "unique_states": lambda s, d: q.unique_states(_with_column("registration_state")(s, d)),
    "missing_address_3": lambda s, d: q.missing_address(_with_column("intersecting_street")(s, d)),
    "missing_address_2": lambda s, d: q.missing_address(L(s, d), columns=q.R.street_address),
    # frequencies
    "freq_code": lambda s, d: q.item_frequency(L(s, d), "violation_code"),
    # a NULL item scores 0 where items are counted and its rows where rows are
    "freq_code_gaps": lambda s, d: q.item_frequency(G(s, d), "violation_code"),
    "freq_code_star_gaps": lambda s, d: q.item_frequency(G(s, d), "violation_code", count_nulls=True),
    "top5_code_gaps": lambda s, d: q.top_items_per_year(G(s, d), "violation_code", 5),
    "freq_body": lambda s, d: q.item_frequency(_with_column("vehicle_body_type")(s, d), "vehicle_body_type"),
    "freq_make": lambda s, d: q.item_frequency(_with_column("vehicle_make")(s, d), "vehicle_make"),
    "freq_viol_precinct": lambda s, d: q.item_frequency(L(s, d), "violation_precinct"),
    "freq_issuer_precinct": lambda s, d: q.item_frequency(L(s, d), "issuer_precinct"),
    "freq_code_star": lambda s, d: q.item_frequency(L(s, d), "violation_code", count_nulls=True),
    "top5_code": lambda s, d: q.top_items_per_year(L(s, d), "violation_code", 5),
    "top5_body": lambda s, d: q.top_items_per_year(_with_column("vehicle_body_type")(s, d), "vehicle_body_type", 5),
    "top5_make": lambda s, d: q.top_items_per_year(_with_column("vehicle_make")(s, d), "vehicle_make", 5),
    "top5_viol_precinct": lambda s, d: q.top_items_per_year(L(s, d), "violation_precinct", 5),
    "top5_issuer_precinct": lambda s, d: q.top_items_per_year(L(s, d), "issuer_precinct", 5),
    "top4_code": lambda s, d: q.top_codes_by_tickets(L(s, d), 4),
    # busy precincts
    "global_top_precincts": lambda s, d: q.busiest_precincts(L(s, d), 3),
    "precinct_code_freq": lambda s, d: q.precinct_code_freq(L(s, d), GIVEN_PRECINCTS),
    "precinct_code_freq_derived": lambda s, d: q.precinct_code_freq_derived(L(s, d), 3),
    "top5_code_per_precinct": lambda s, d: q.top_codes_per_precinct(L(s, d), 5, 3),
    "common_codes": lambda s, d: q.common_codes_precincts(L(s, d), 5, 3),
    "precinct_code_lift": lambda s, d: q.precinct_code_lift(L(s, d), 3),
    "rank_list_precinct": lambda s, d: q.rank_list_precinct(L(s, d), 5, 3),
    # seasons
    "season_label": lambda s, d: q.with_season(L(s, d)).select("summons_number", "issue_date", "season"),
    "tickets_per_season": lambda s, d: q.tickets_per_season(L(s, d)),
    "tickets_per_season_gaps": lambda s, d: q.tickets_per_season(G(s, d)),
    "fiscal_filter_gaps": lambda s, d: clean.fiscal_filter(G(s, d).select("fiscal_year", "summons_number", "issue_date")),
    "freq_season_code": lambda s, d: q.freq_season_code(L(s, d)),
    "top3_code_per_season": lambda s, d: q.top_codes_per_season(L(s, d), 3),
    "rank_list_season": lambda s, d: q.rank_list_season(L(s, d), 3),
    "common_codes_seasons": lambda s, d: q.common_codes_seasons(L(s, d), COMMON_CODES_N),
    # fines and revenue
    "fines_table": _fines_table,
    "average_fine": lambda s, d: _average_fine(s, d),
    "fines_join": lambda s, d: _money(q.code_fines(L(s, d), *_fines_args(s))),
    "revenue": lambda s, d: _money(q.code_revenue(L(s, d), *_fines_args(s))),
    "revenue_rollup": lambda s, d: _money(q.revenue_by_year(L(s, d), *_fines_args(s))),
    "top_revenue_code": lambda s, d: _money(q.best_revenue_code(L(s, d), *_fines_args(s))),
    "yoy_revenue": lambda s, d: _money(q.revenue_change(L(s, d), *_fines_args(s))),
    "yoy_tickets": lambda s, d: q.tickets_change(L(s, d)),
    "pivot_years": lambda s, d: q.codes_by_year(L(s, d), PIVOT_YEARS),
    "facet_frame": lambda s, d: q.chart_top_codes(L(s, d), 5),
    # clock time (event view)
    "fill_time": lambda s, d: q.with_clock(_tt(s, d)).select("event_id", "violation_time"),
    "parse_clock_time": lambda s, d: q.with_clock(_tt(s, d), mode=CLOCK).select(
        "event_id", "violation_time", "minute_of_day"
    ),
    "parse_clock_time_additive": lambda s, d: q.with_clock(_tt(s, d), mode=ADDITIVE).select(
        "event_id", "violation_time", "minute_of_day"
    ),
    "clock_string": lambda s, d: q.with_clock(_tt(s, d)).select(
        "event_id", clock_string("violation_time").alias("clock_string")
    ),
    "clock_timestamp": lambda s, d: q.with_clock(_tt(s, d)).select(
        "event_id", clock_timestamp("minute_of_day").alias("clock_ts")
    ),
    "missing_time_count": lambda s, d: q.missing_time_count(_tt(s, d)),
    "drop_missing_time": lambda s, d: q.drop_missing_time(_tt(s, d)).select(
        "event_id", "fiscal_year", "violation_code", "violation_time", "minute_of_day"
    ),
    "time_bin": lambda s, d: q.binned(_tt(s, d)).select(
        "event_id", hour_of("minute_of_day").alias("hour"), "time_of_day"
    ),
    "freq_bin_code": lambda s, d: q.freq_bin_code(_tt(s, d)),
    "top3_code_per_bin": lambda s, d: q.top_codes_per_bin(_tt(s, d), 3),
    "bins_for_codes": lambda s, d: q.bins_for_codes(_tt(s, d), GIVEN_EVENT_CODES),
    "bins_for_top_codes": lambda s, d: q.bins_for_top_codes(_tt(s, d), 3),
    "top5_bin_per_code": lambda s, d: q.top_bins_per_code(_tt(s, d), 5, 3),
    "rank_list_bin": lambda s, d: q.rank_list_bin(_tt(s, d), 3),
    "rank_list_code": lambda s, d: q.rank_list_code(_tt(s, d), 5, 3),
    "common_codes_bins": lambda s, d: q.common_codes_bins(_tt(s, d), COMMON_TYPES_N),
    # the same questions with the additive clock arithmetic (hours above 12 kept)
    "missing_time_count_additive": lambda s, d: q.missing_time_count(_late(s, d), mode=ADDITIVE),
    "time_bin_additive": lambda s, d: q.binned(_late(s, d), mode=ADDITIVE).select(
        "event_id", hour_of("minute_of_day").alias("hour"), "time_of_day"
    ),
    "freq_bin_code_additive": lambda s, d: q.freq_bin_code(_late(s, d), mode=ADDITIVE),
    "top3_code_per_bin_additive": lambda s, d: q.top_codes_per_bin(_late(s, d), 3, mode=ADDITIVE),
    "top5_bin_per_code_additive": lambda s, d: q.top_bins_per_code(_late(s, d), 5, 3, mode=ADDITIVE),
    "rank_list_bin_additive": lambda s, d: q.rank_list_bin(_late(s, d), 3, mode=ADDITIVE),
    "rank_list_code_additive": lambda s, d: q.rank_list_code(_late(s, d), 5, 3, mode=ADDITIVE),
    # shared scan: every count from one GROUPING SETS aggregate per table
    "ticket_cube": _ticket_cube,
    "time_cube": _time_cube,
    "sample_rows": lambda s, d: profile.sample_rows(L(s, d), 0.01, key="summons_number"),
    "schema_profile": lambda s, d: profile.schema_profile(T(s, d), examples=True),
    "schema_diff": lambda s, d: profile.schema_diff(_years(s, d), with_counts=True),
}


def _fines_args(spark: SparkSession) -> tuple:
    fines, n = mapping_fines(spark)
    return fines, 4, q.R, n


# --------------------------------------------------------------------------
# DuckDB oracle
# --------------------------------------------------------------------------

_FY = "CAST(year({d}) + CASE WHEN month({d}) >= 7 THEN 1 ELSE 0 END AS INT)"

TICKETS_CTE = f"""tickets AS (
  SELECT l.l_orderkey * 10 + l.l_linenumber AS summons_number,
         CAST(l.l_shipdate AS DATE) AS issue_date,
         {_FY.format(d='l.l_shipdate')} AS fiscal_year,
         CAST(l.l_quantity AS INT) AS violation_code,
         l.l_suppkey % 25 AS issuer_precinct,
         l.l_partkey % 78 AS violation_precinct,
         nullif(p.p_type, 'STANDARD') AS vehicle_body_type,
         p.p_brand AS vehicle_make,
         n.n_name AS registration_state,
         nullif(l.l_returnflag, 'R') AS house_number,
         nullif(l.l_linestatus, 'O') AS street_name,
         nullif(o.o_orderstatus, 'P') AS intersecting_street,
         l.l_extendedprice AS amount
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""

_BIN_SQL = " ".join(
    ["CASE"]
    + [
        f"WHEN floor(minute_of_day / 60) >= {lo} AND floor(minute_of_day / 60) < {lo + 4} THEN '{label}'"
        for lo, label in ((2, "Early Morning"), (6, "Morning"), (10, "Afternoon"), (14, "Evening"), (18, "Night"))
    ]
    + ["ELSE 'Late Night' END"]
)

_CLOCK_MINUTES = (
    "CASE WHEN regexp_full_match(violation_time, '[0-9]{4}[AP]') AND hh <= 12 AND mm <= 59 "
    "THEN CAST(((hh % 12) + CASE WHEN ap = 'P' THEN 12 ELSE 0 END) * 60 + mm AS INT) END"
)
_ADDITIVE_MINUTES = (
    "CASE WHEN regexp_full_match(violation_time, '[0-9]{4}[AP]?') AND hh <= 23 AND mm <= 59 "
    "THEN CAST(((hh + CASE WHEN ap = 'P' THEN 12 ELSE 0 END) % 24) * 60 + mm AS INT) END"
)
_LATE_TEXT = (
    "WHEN event_id % 11 = 0 THEN strftime(ts, '%H%M') "
    "WHEN event_id % 13 = 0 THEN concat(strftime(ts, '%H%M'), 'A') "
)


def _times_cte(minutes: str, late: str = "") -> str:
    return f"""raw_times AS (
  SELECT event_id, CAST(2015 + user_id % 3 AS INT) AS fiscal_year, event_type AS violation_code, ts,
         CASE {late}WHEN event_id % 97 = 0 THEN NULL
              WHEN event_id % 89 = 0 THEN '8752A'
              ELSE concat(strftime(ts, '%I%M'), substr(strftime(ts, '%p'), 1, 1)) END AS violation_time,
         CASE WHEN event_id % 2 = 0 THEN 'ALL' ELSE '0800A' END AS from_hours_in_effect
  FROM events
),
filled AS (
  SELECT * REPLACE (CASE WHEN violation_time IS NULL AND from_hours_in_effect != 'ALL'
                         THEN from_hours_in_effect ELSE violation_time END AS violation_time)
  FROM raw_times
),
pieces AS (
  SELECT *, TRY_CAST(substr(violation_time, 1, 2) AS INT) AS hh,
            TRY_CAST(substr(violation_time, 3, 2) AS INT) AS mm,
            substr(violation_time, 5, 1) AS ap
  FROM filled
),
clocked AS (
  SELECT event_id, fiscal_year, violation_code, ts, violation_time, from_hours_in_effect,
         {minutes} AS minute_of_day, {_ADDITIVE_MINUTES} AS minute_of_day_additive
  FROM pieces
),
binned AS (
  SELECT *, CAST(floor(minute_of_day / 60) AS INT) AS hour,
         {_BIN_SQL} AS time_of_day
  FROM clocked WHERE minute_of_day IS NOT NULL
)"""


TIMES_CTE = _times_cte(_CLOCK_MINUTES)
LATE_CTE = _times_cte(_ADDITIVE_MINUTES, _LATE_TEXT)

RAW_CTE = f"""raw AS (
  SELECT {_FY.format(d='l.l_shipdate')} AS file_year,
         o.o_orderkey AS summons_number,
         n.n_name AS registration_state,
         l.l_returnflag AS plate_type,
         strftime(o.o_orderdate, '%m/%d/%Y') AS issue_date,
         o.o_orderstatus AS street_name,
         CAST(NULL AS VARCHAR) AS no_standing_or_stopping_violation
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

FINES_CTE = f"""fines AS (
  SELECT CAST(range AS INT) AS code,
         CASE WHEN range = {UNKNOWN_FINE_CODE} THEN NULL ELSE CAST(2 * range + 10 AS DECIMAL(10,2)) END AS fine_high,
         CASE WHEN range = {UNKNOWN_FINE_CODE} THEN NULL ELSE CAST(2 * range AS DECIMAL(10,2)) END AS fine_low
  FROM range(1, 51)
  UNION ALL SELECT {ABSENT_FINE_CODE}, CAST(40 AS DECIMAL(10,2)), CAST(30 AS DECIMAL(10,2))
),
avg_fines AS (
  SELECT code, CAST((fine_high + fine_low) / 2 AS DECIMAL(12,2)) AS average_fine,
         (fine_high + fine_low) IS NOT NULL AS fine_known
  FROM fines
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


TW = _with(TICKETS_CTE)
XW = _with(TIMES_CTE)
AW = _with(LATE_CTE)


def _freq_sql(item: str, star: bool = False, where: str = "") -> str:
    cnt = "count(*)" if star else f"count({item})"
    return (
        f"SELECT fiscal_year, {item}, {cnt} AS frequency FROM tickets {where} "
        f"GROUP BY fiscal_year, {item}"
    )


GAPS_CTE = (
    "gapped AS (SELECT * REPLACE (CASE WHEN summons_number % 7 <> 0 THEN violation_code END AS violation_code, "
    "CASE WHEN summons_number % 11 <> 0 THEN issue_date END AS issue_date) FROM tickets)"
)
GW = _with(TICKETS_CTE, GAPS_CTE)


def _on_gaps(sql: str) -> str:
    return GW + sql.replace("FROM tickets", "FROM gapped")


def _top_sql(inner: str, by: str, n: int) -> str:
    return (
        f"SELECT * FROM (SELECT *, CAST(dense_rank() OVER (PARTITION BY {by} ORDER BY frequency DESC) AS INT) AS rnk "
        f"FROM ({inner}) f) r WHERE rnk <= {n}"
    )


_TOP3_PRECINCTS = (
    "SELECT issuer_precinct FROM (SELECT issuer_precinct, count(issuer_precinct) AS frequency FROM tickets "
    "GROUP BY issuer_precinct ORDER BY frequency DESC, issuer_precinct LIMIT 3)"
)
_PRECINCT_FREQ_DERIVED = (
    "SELECT fiscal_year, issuer_precinct, violation_code, count(violation_code) AS frequency FROM tickets "
    f"WHERE issuer_precinct IN ({_TOP3_PRECINCTS}) GROUP BY fiscal_year, issuer_precinct, violation_code"
)
_TOP5_PER_PRECINCT = _top_sql(_PRECINCT_FREQ_DERIVED, "fiscal_year, issuer_precinct", 5)

_SEASON = (
    "CASE WHEN month(issue_date) >= 3 AND month(issue_date) < 6 THEN 'Spring' "
    "WHEN month(issue_date) >= 6 AND month(issue_date) < 9 THEN 'Summer' "
    "WHEN month(issue_date) >= 9 AND month(issue_date) < 12 THEN 'Autumn' ELSE 'Winter' END"
)
_SEASON_FREQ = (
    f"SELECT fiscal_year, season, violation_code, count(*) AS frequency FROM "
    f"(SELECT *, {_SEASON} AS season FROM tickets) GROUP BY fiscal_year, season, violation_code"
)
_TOP3_PER_SEASON = _top_sql(_SEASON_FREQ, "fiscal_year, season", 3)

_TOP4_CODE = _top_sql(_freq_sql("violation_code", star=True), "fiscal_year", 4)
_FINES_JOIN = (
    f"SELECT t.fiscal_year, t.violation_code, t.frequency, t.rnk, a.average_fine, a.fine_known "
    f"FROM ({_TOP4_CODE}) t JOIN avg_fines a ON t.violation_code = a.code"
)
_REVENUE = (
    "SELECT fiscal_year, violation_code, frequency, rnk, CAST(average_fine AS DOUBLE) AS average_fine, fine_known, "
    "CAST(frequency * coalesce(average_fine, 0) AS DOUBLE) AS revenue "
    f"FROM ({_FINES_JOIN}) j"
)
RW = _with(TICKETS_CTE, FINES_CTE)

_BIN_FREQ = (
    "SELECT fiscal_year, time_of_day, violation_code, count(*) AS frequency FROM binned "
    "GROUP BY fiscal_year, time_of_day, violation_code"
)
_TOP3_PER_BIN = _top_sql(_BIN_FREQ, "fiscal_year, time_of_day", 3)
_TOP3_CODES = (
    "SELECT violation_code FROM (SELECT violation_code, count(*) AS frequency FROM binned "
    "GROUP BY violation_code ORDER BY frequency DESC, violation_code LIMIT 3)"
)
_BINS_TOP_CODES = (
    "SELECT fiscal_year, violation_code, time_of_day, count(*) AS frequency FROM binned "
    f"WHERE violation_code IN ({_TOP3_CODES}) GROUP BY fiscal_year, violation_code, time_of_day"
)
_TOP5_BIN_PER_CODE = _top_sql(_BINS_TOP_CODES, "fiscal_year, violation_code", 5)
_INITIALS = (
    "CASE time_of_day WHEN 'Early Morning' THEN 'EM' WHEN 'Morning' THEN 'M' WHEN 'Afternoon' THEN 'A' "
    "WHEN 'Evening' THEN 'E' WHEN 'Night' THEN 'N' WHEN 'Late Night' THEN 'LN' ELSE time_of_day END"
)


def _common_sql(top: str, facet: str) -> str:
    return (
        f"SELECT p.fiscal_year, p.violation_code, p.n_facets FROM "
        f"(SELECT fiscal_year, violation_code, count(DISTINCT {facet}) AS n_facets FROM ({top}) t "
        f"GROUP BY fiscal_year, violation_code) p JOIN "
        f"(SELECT fiscal_year, count(DISTINCT {facet}) AS k FROM ({top}) t GROUP BY fiscal_year) g "
        f"ON p.fiscal_year = g.fiscal_year WHERE p.n_facets = g.k"
    )


def _rank_list_sql(top: str, by: str, label: str) -> str:
    return (
        f"SELECT {by}, string_agg({label}, ',' ORDER BY rnk, {label}) AS rank_list "
        f"FROM ({top}) t GROUP BY {by}"
    )


ORACLE: dict[str, str] = {
    "row_count": TW + "SELECT count(*) AS n_rows FROM tickets",
    "duplicate_report": _with(RAW_CTE)
    + "SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS distinct_rows, "
    "CAST(sum(n) - count(*) AS BIGINT) AS duplicates FROM "
    "(SELECT file_year, summons_number, registration_state, plate_type, issue_date, street_name, "
    "no_standing_or_stopping_violation, count(*) AS n FROM raw GROUP BY ALL) g",
    "dedupe": _with(RAW_CTE) + "SELECT DISTINCT * FROM raw",
    "null_profile": TW
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, count(*) AS n_rows FROM tickets"
        for c in TICKET_COLUMNS
    ),
    "stored_profile": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS n_null, count(*) AS n_rows FROM lineitem"
        for c in LINEITEM_COLUMNS
    ),
    "drop_empty_columns": TW + "SELECT * FROM tickets",
    "first_columns": TW
    + "SELECT summons_number, issue_date, fiscal_year, violation_code, issuer_precinct FROM tickets",
    "month_histogram": TW
    + "SELECT CAST(year(issue_date) AS INT) AS year, CAST(month(issue_date) AS INT) AS month, count(*) AS n "
    "FROM tickets GROUP BY 1, 2 ORDER BY 1, 2",
    "parse_issue_date": (
        "SELECT l_orderkey, l_linenumber, issue_date_text, "
        "CAST(try_strptime(issue_date_text, '%m/%d/%Y') AS DATE) AS issue_date FROM ("
        "SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 101 = 0 THEN '13/45/1997' "
        "WHEN l_linenumber = 3 THEN concat_ws('/', month(l_shipdate), day(l_shipdate), year(l_shipdate)) "
        "ELSE strftime(l_shipdate, '%m/%d/%Y') END AS issue_date_text FROM lineitem) x"
    ),
    "fiscal_year_label": (
        "SELECT l_orderkey * 10 + l_linenumber AS summons_number, CAST(l_shipdate AS DATE) AS issue_date, "
        f"{_FY.format(d='l_shipdate')} AS fiscal_year FROM lineitem"
    ),
    "fiscal_filter": _with(RAW_CTE)
    + "SELECT fiscal_year, summons_number, issue_date FROM (SELECT file_year AS fiscal_year, summons_number, "
    "CAST(try_strptime(issue_date, '%m/%d/%Y') AS DATE) AS issue_date FROM raw) x "
    "WHERE issue_date >= make_date(fiscal_year - 1, 7, 1) AND issue_date < make_date(fiscal_year, 7, 1)",
    "fiscal_filter_range": (
        "SELECT l_orderkey * 10 + l_linenumber AS summons_number, CAST(l_shipdate AS DATE) AS issue_date FROM lineitem "
        f"WHERE l_shipdate >= DATE '{GIVEN_FISCAL_YEAR - 1}-07-01' AND l_shipdate < DATE '{GIVEN_FISCAL_YEAR}-07-01'"
    ),
    "clean_year": _with(RAW_CTE)
    + "SELECT summons_number, registration_state, plate_type, issue_date, street_name, fiscal_year FROM ("
    "SELECT summons_number, registration_state, plate_type, "
    "CAST(try_strptime(issue_date, '%m/%d/%Y') AS DATE) AS issue_date, street_name, file_year AS fiscal_year "
    "FROM (SELECT DISTINCT * FROM raw) d) x "
    "WHERE issue_date >= make_date(fiscal_year - 1, 7, 1) AND issue_date < make_date(fiscal_year, 7, 1)",
    "combine_years": TW
    + f"SELECT {', '.join(LINE_COLUMNS[:-1])}, CASE WHEN fiscal_year >= 2000 THEN NULL ELSE amount END AS amount FROM tickets",
    "view_sql": TW
    + "SELECT fiscal_year, count(summons_number) AS n_tickets FROM tickets GROUP BY fiscal_year",
    "month_histogram_sql": TW
    + "SELECT CAST(year(issue_date) AS INT) AS year, CAST(month(issue_date) AS INT) AS month, count(*) AS n "
    "FROM tickets GROUP BY 1, 2 ORDER BY 1, 2",
    "tickets_per_year": TW
    + "SELECT fiscal_year, count(summons_number) AS n_tickets FROM tickets GROUP BY fiscal_year ORDER BY fiscal_year",
    "unique_states": TW
    + "SELECT fiscal_year, count(DISTINCT registration_state) AS n_states FROM tickets GROUP BY fiscal_year ORDER BY fiscal_year",
    "missing_address_3": TW
    + "SELECT fiscal_year, count(fiscal_year) AS n_missing FROM tickets WHERE house_number IS NULL "
    "AND street_name IS NULL AND intersecting_street IS NULL GROUP BY fiscal_year ORDER BY fiscal_year",
    "missing_address_2": TW
    + "SELECT fiscal_year, count(fiscal_year) AS n_missing FROM tickets WHERE house_number IS NULL "
    "AND street_name IS NULL GROUP BY fiscal_year ORDER BY fiscal_year",
    "freq_code": TW + _freq_sql("violation_code"),
    "freq_body": TW + _freq_sql("vehicle_body_type"),
    "freq_make": TW + _freq_sql("vehicle_make"),
    "freq_viol_precinct": TW + _freq_sql("violation_precinct"),
    "freq_issuer_precinct": TW + _freq_sql("issuer_precinct"),
    "freq_code_star": TW + _freq_sql("violation_code", star=True),
    "freq_code_gaps": _on_gaps(_freq_sql("violation_code")),
    "freq_code_star_gaps": _on_gaps(_freq_sql("violation_code", star=True)),
    "top5_code_gaps": _on_gaps(_top_sql(_freq_sql("violation_code"), "fiscal_year", 5)),
    "tickets_per_season_gaps": _on_gaps(
        "SELECT fiscal_year, season, count(*) AS frequency FROM "
        f"(SELECT *, CASE WHEN issue_date IS NOT NULL THEN {_SEASON} END AS season FROM tickets) "
        "GROUP BY fiscal_year, season ORDER BY frequency DESC"
    ),
    "fiscal_filter_gaps": _on_gaps(
        "SELECT fiscal_year, summons_number, issue_date FROM tickets WHERE issue_date IS NOT NULL "
        "AND year(issue_date) + CASE WHEN month(issue_date) >= 7 THEN 1 ELSE 0 END = fiscal_year"
    ),
    "top5_code": TW + _top_sql(_freq_sql("violation_code"), "fiscal_year", 5),
    "top5_body": TW + _top_sql(_freq_sql("vehicle_body_type"), "fiscal_year", 5),
    "top5_make": TW + _top_sql(_freq_sql("vehicle_make"), "fiscal_year", 5),
    "top5_viol_precinct": TW + _top_sql(_freq_sql("violation_precinct"), "fiscal_year", 5),
    "top5_issuer_precinct": TW + _top_sql(_freq_sql("issuer_precinct"), "fiscal_year", 5),
    "top4_code": TW + _TOP4_CODE,
    "global_top_precincts": TW
    + "SELECT issuer_precinct, count(issuer_precinct) AS frequency FROM tickets GROUP BY issuer_precinct "
    "ORDER BY frequency DESC, issuer_precinct LIMIT 3",
    "precinct_code_freq": TW
    + "SELECT fiscal_year, issuer_precinct, violation_code, count(violation_code) AS frequency FROM tickets "
    f"WHERE issuer_precinct IN ({', '.join(map(str, GIVEN_PRECINCTS))}) "
    "GROUP BY fiscal_year, issuer_precinct, violation_code",
    "precinct_code_freq_derived": TW + _PRECINCT_FREQ_DERIVED,
    "top5_code_per_precinct": TW + _TOP5_PER_PRECINCT,
    "common_codes": TW + _common_sql(_TOP5_PER_PRECINCT, "issuer_precinct"),
    "precinct_code_lift": TW
    + "SELECT f.fiscal_year, f.issuer_precinct, f.violation_code, f.frequency, "
    "round(CAST(f.frequency AS DOUBLE) / CAST(g.gt AS DOUBLE), 6) AS share, "
    "round(CAST(i.it AS DOUBLE) / CAST(y.yt AS DOUBLE), 6) AS overall_share, "
    "round((CAST(f.frequency AS DOUBLE) / CAST(g.gt AS DOUBLE)) / (CAST(i.it AS DOUBLE) / CAST(y.yt AS DOUBLE)), 6) AS lift "
    "FROM (SELECT fiscal_year, issuer_precinct, violation_code, count(violation_code) AS frequency FROM tickets "
    "GROUP BY ALL) f "
    "JOIN (SELECT fiscal_year, issuer_precinct, sum(frequency) AS gt FROM (SELECT fiscal_year, issuer_precinct, "
    "violation_code, count(violation_code) AS frequency FROM tickets GROUP BY ALL) GROUP BY ALL) g "
    "ON f.fiscal_year = g.fiscal_year AND f.issuer_precinct = g.issuer_precinct "
    "JOIN (SELECT fiscal_year, violation_code, count(violation_code) AS it FROM tickets GROUP BY ALL) i "
    "ON f.fiscal_year = i.fiscal_year AND f.violation_code = i.violation_code "
    "JOIN (SELECT fiscal_year, count(violation_code) AS yt FROM tickets GROUP BY ALL) y "
    "ON f.fiscal_year = y.fiscal_year "
    f"WHERE f.issuer_precinct IN ({_TOP3_PRECINCTS})",
    "rank_list_precinct": TW
    + _rank_list_sql(
        _TOP5_PER_PRECINCT, "fiscal_year, issuer_precinct", "CASE WHEN length(CAST(violation_code AS VARCHAR)) < 2 THEN lpad(CAST(violation_code AS VARCHAR), 2, '0') ELSE CAST(violation_code AS VARCHAR) END"
    ),
    "season_label": TW + f"SELECT summons_number, issue_date, {_SEASON} AS season FROM tickets",
    "tickets_per_season": TW
    + f"SELECT fiscal_year, season, count(*) AS frequency FROM (SELECT *, {_SEASON} AS season FROM tickets) "
    "GROUP BY fiscal_year, season ORDER BY frequency DESC",
    "freq_season_code": TW + _SEASON_FREQ,
    "top3_code_per_season": TW + _TOP3_PER_SEASON,
    "rank_list_season": TW
    + _rank_list_sql(_TOP3_PER_SEASON, "fiscal_year, season", "CASE WHEN length(CAST(violation_code AS VARCHAR)) < 2 THEN lpad(CAST(violation_code AS VARCHAR), 2, '0') ELSE CAST(violation_code AS VARCHAR) END"),
    "common_codes_seasons": TW + _common_sql(_top_sql(_SEASON_FREQ, "fiscal_year, season", COMMON_CODES_N), "season"),
    "fines_table": RW
    + "SELECT c.violation_code, CAST(f.fine_high AS DOUBLE) AS fine_high, CAST(f.fine_low AS DOUBLE) AS fine_low "
    "FROM (SELECT DISTINCT violation_code FROM tickets) c LEFT JOIN fines f ON c.violation_code = f.code",
    "average_fine": RW
    + "SELECT t.fiscal_year, t.violation_code, t.frequency, t.rnk, CAST(a.average_fine AS DOUBLE) AS average_fine, "
    f"coalesce(a.fine_known, false) AS fine_known FROM ({_TOP4_CODE}) t LEFT JOIN avg_fines a ON t.violation_code = a.code",
    "fines_join": RW
    + "SELECT fiscal_year, violation_code, frequency, rnk, CAST(average_fine AS DOUBLE) AS average_fine, fine_known "
    f"FROM ({_FINES_JOIN}) j",
    "revenue": RW + _REVENUE,
    "revenue_rollup": RW
    + "SELECT fiscal_year, violation_code, sum(revenue) AS revenue, "
    "CAST(GROUPING(fiscal_year, violation_code) AS INT) AS level "
    f"FROM ({_REVENUE}) r GROUP BY ROLLUP (fiscal_year, violation_code)",
    "top_revenue_code": RW
    + "SELECT fiscal_year, violation_code AS top_code, revenue AS top_revenue FROM ("
    "SELECT *, row_number() OVER (PARTITION BY fiscal_year ORDER BY revenue DESC, violation_code) AS rn "
    f"FROM ({_REVENUE}) r) x WHERE rn = 1",
    "yoy_revenue": RW
    + "SELECT fiscal_year, total_revenue, prev_total_revenue, total_revenue - prev_total_revenue AS change_total_revenue, "
    "round((total_revenue - prev_total_revenue) * 100.0 / prev_total_revenue, 6) AS pct_change_total_revenue FROM ("
    "SELECT fiscal_year, total_revenue, CASE WHEN lag(fiscal_year) OVER (ORDER BY fiscal_year) = fiscal_year - 1 THEN lag(total_revenue) OVER (ORDER BY fiscal_year) END AS prev_total_revenue FROM ("
    f"SELECT fiscal_year, sum(revenue) AS total_revenue FROM ({_REVENUE}) r GROUP BY fiscal_year) y) z",
    "yoy_tickets": TW
    + "SELECT fiscal_year, n_tickets, prev_n_tickets, n_tickets - prev_n_tickets AS change_n_tickets, "
    "round(CAST(n_tickets - prev_n_tickets AS DOUBLE) * 100.0 / CAST(prev_n_tickets AS DOUBLE), 6) AS pct_change_n_tickets FROM ("
    "SELECT fiscal_year, n_tickets, CASE WHEN lag(fiscal_year) OVER (ORDER BY fiscal_year) = fiscal_year - 1 THEN lag(n_tickets) OVER (ORDER BY fiscal_year) END AS prev_n_tickets FROM ("
    "SELECT fiscal_year, count(summons_number) AS n_tickets FROM tickets GROUP BY fiscal_year) y) z",
    "pivot_years": TW
    + "SELECT violation_code, "
    + ", ".join(f"count(*) FILTER (WHERE fiscal_year = {y}) AS fy_{y}" for y in PIVOT_YEARS)
    + f", count(*) FILTER (WHERE fiscal_year IS NULL OR fiscal_year NOT IN ({', '.join(map(str, PIVOT_YEARS))})) AS fy_other"
    + " FROM tickets GROUP BY violation_code",
    "facet_frame": TW
    + "SELECT CAST(violation_code AS VARCHAR) AS x, frequency AS y, CAST(violation_code AS VARCHAR) AS fill, "
    "fiscal_year AS facet_col FROM ("
    + _top_sql(_freq_sql("violation_code"), "fiscal_year", 5)
    + ") t",
    "fill_time": XW + "SELECT event_id, violation_time FROM filled",
    "parse_clock_time": XW + "SELECT event_id, violation_time, minute_of_day FROM clocked",
    "parse_clock_time_additive": XW
    + "SELECT event_id, violation_time, minute_of_day_additive AS minute_of_day FROM clocked",
    "clock_string": XW
    + "SELECT event_id, concat_ws(':', substr(violation_time, 1, 2), substr(violation_time, 3, 2)) AS clock_string "
    "FROM filled",
    "clock_timestamp": XW
    + "SELECT event_id, make_timestamp(1970, 1, 1, CAST(floor(minute_of_day / 60) AS INT), minute_of_day % 60, 0) "
    "AS clock_ts FROM clocked",
    "missing_time_count": XW + "SELECT count(*) AS n_missing FROM clocked WHERE minute_of_day IS NULL",
    "drop_missing_time": XW
    + "SELECT event_id, fiscal_year, violation_code, violation_time, minute_of_day FROM clocked "
    "WHERE minute_of_day IS NOT NULL",
    "time_bin": XW + "SELECT event_id, hour, time_of_day FROM binned",
    "freq_bin_code": XW + _BIN_FREQ,
    "top3_code_per_bin": XW + _TOP3_PER_BIN,
    "bins_for_codes": XW
    + "SELECT fiscal_year, violation_code, time_of_day, count(*) AS frequency FROM binned "
    f"WHERE violation_code IN ({', '.join(repr(c) for c in GIVEN_EVENT_CODES)}) "
    "GROUP BY fiscal_year, violation_code, time_of_day",
    "bins_for_top_codes": XW + _BINS_TOP_CODES,
    "top5_bin_per_code": XW + _TOP5_BIN_PER_CODE,
    "rank_list_bin": XW + _rank_list_sql(_TOP3_PER_BIN, "fiscal_year, time_of_day", "violation_code"),
    "rank_list_code": XW
    + _rank_list_sql(
        f"SELECT *, {_INITIALS} AS initials FROM ({_TOP5_BIN_PER_CODE}) b", "fiscal_year, violation_code", "initials"
    ),
    "common_codes_bins": XW + _common_sql(_top_sql(_BIN_FREQ, "fiscal_year, time_of_day", COMMON_TYPES_N), "time_of_day"),
}

for _name, _sql in {
    "missing_time_count_additive": ORACLE["missing_time_count"],
    "time_bin_additive": ORACLE["time_bin"],
    "freq_bin_code_additive": ORACLE["freq_bin_code"],
    "top3_code_per_bin_additive": ORACLE["top3_code_per_bin"],
    "top5_bin_per_code_additive": ORACLE["top5_bin_per_code"],
    "rank_list_bin_additive": ORACLE["rank_list_bin"],
    "rank_list_code_additive": ORACLE["rank_list_code"],
}.items():
    ORACLE[_name] = AW + _sql.removeprefix(XW)

ORACLE["sample_rows"] = TW + (
    f"SELECT {', '.join(LINE_COLUMNS)} FROM tickets "
    f"WHERE substr(md5('42|' || CAST(summons_number AS VARCHAR)), 1, 8) < '{int(0.01 * 2**32):08x}'"
)

ORACLE["ticket_cube"] = TW + (
    "SELECT fiscal_year, registration_state, violation_code, vehicle_body_type, vehicle_make, violation_precinct, "
    "issuer_precinct, season, count(*) AS n_rows, count(summons_number) AS n_summons, "
    "count(*) FILTER (WHERE house_number IS NULL AND street_name IS NULL AND intersecting_street IS NULL) AS n_missing_3, "
    "count(*) FILTER (WHERE house_number IS NULL AND street_name IS NULL) AS n_missing_2, "
    "CAST(GROUPING(fiscal_year, registration_state, violation_code, vehicle_body_type, vehicle_make, "
    "violation_precinct, issuer_precinct, season) AS BIGINT) AS set_id "
    f"FROM (SELECT *, {_SEASON} AS season FROM tickets) t GROUP BY GROUPING SETS ("
    "(fiscal_year), (fiscal_year, registration_state), (fiscal_year, violation_code), "
    "(fiscal_year, vehicle_body_type), (fiscal_year, vehicle_make), (fiscal_year, violation_precinct), "
    "(fiscal_year, issuer_precinct), (issuer_precinct), (fiscal_year, issuer_precinct, violation_code), "
    "(fiscal_year, season, violation_code))"
)
ORACLE["time_cube"] = XW + (
    "SELECT violation_code, fiscal_year, time_of_day, count(*) FILTER (WHERE minute_of_day IS NOT NULL) AS n_rows, "
    "count(*) FILTER (WHERE minute_of_day IS NULL) AS n_missing_time, "
    "CAST(GROUPING(violation_code, fiscal_year, time_of_day) AS BIGINT) AS set_id FROM ("
    f"SELECT *, CASE WHEN minute_of_day IS NOT NULL THEN {_BIN_SQL} END AS time_of_day FROM clocked) c "
    "GROUP BY GROUPING SETS ((), (violation_code), (fiscal_year, time_of_day, violation_code))"
)

ORACLE["month_histogram_raw"] = _with(RAW_CTE) + (
    "SELECT file_year, CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, count(*) AS n FROM "
    "(SELECT file_year, CAST(try_strptime(issue_date, '%m/%d/%Y') AS DATE) AS d FROM raw) x "
    "GROUP BY 1, 2, 3 ORDER BY 1, 2, 3"
)


def _csv_sql() -> str:
    from ticketlens.sources.csv import RAW_COLUMNS, column_type, snake_case

    cells = []
    for i, (name, _) in enumerate(RAW_COLUMNS):
        own = snake_case(name)
        integer = column_type(own).typeName() == "integer"
        if own == "issue_date":
            value = "strftime(issue_date, '%m/%d/%Y')"
        elif own in CSV_COLUMNS:
            value = f"CAST({own} AS INT)" if integer else own
        else:
            value = f"CAST(summons_number % {i + 2} AS INT)" if integer else f"concat('v', summons_number % {i + 2})"
        if i >= SHORT_LAYOUT:
            value = f"CASE WHEN fiscal_year % 2 = 0 THEN {value} END"
        cells.append(f"{value} AS {own}")
    return TW + f"SELECT {', '.join(cells)} FROM tickets"


ORACLE["csv_scan"] = _csv_sql()
ORACLE["clean_sink"] = TW + "SELECT * FROM tickets"

_YEAR_FRAMES = {"a": "fiscal_year <= 1997", "b": "fiscal_year >= 1998 AND fiscal_year <= 1999", "c": "fiscal_year >= 2000"}
ORACLE["schema_diff"] = TW + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INT) AS position, '{c}' AS column_name, "
    + ", ".join(f"{'false' if (k == 'c' and c == 'amount') else 'true'} AS in_{k}" for k in _YEAR_FRAMES)
    + ", "
    + ", ".join(
        (f"CAST(NULL AS BIGINT) AS n_{k}" if (k == "c" and c == "amount") else f"count({c}) FILTER (WHERE {cond}) AS n_{k}")
        for k, cond in _YEAR_FRAMES.items()
    )
    + " FROM tickets"
    for i, c in enumerate(LINE_COLUMNS)
)

# Spark type names of the tickets view's columns (what ``schema_profile``
# must report); the example is each column's smallest value as text.
_TICKET_TYPES = dict(
    summons_number="bigint", issue_date="date", fiscal_year="int", violation_code="int",
    issuer_precinct="bigint", violation_precinct="bigint", vehicle_body_type="string", vehicle_make="string",
    registration_state="string", house_number="string", street_name="string", intersecting_street="string",
    amount="double",
)
ORACLE["schema_profile"] = TW + " UNION ALL ".join(
    f"SELECT CAST({i + 1} AS INT) AS position, '{c}' AS column_name, '{_TICKET_TYPES[c]}' AS data_type, "
    f"true AS nullable, CAST(min({c}) AS VARCHAR) AS example FROM tickets"
    for i, c in enumerate(TICKET_COLUMNS)
)

ROWS_ONLY: tuple[str, ...] = ()

# The data behind the eleven charts: (question, x, y, facet row).
CHARTS = {
    "chart_codes": ("top5_code", "violation_code", "frequency", None),
    "chart_body_types": ("top5_body", "vehicle_body_type", "frequency", None),
    "chart_makes": ("top5_make", "vehicle_make", "frequency", None),
    "chart_violation_precincts": ("top5_viol_precinct", "violation_precinct", "frequency", None),
    "chart_issuer_precincts": ("top5_issuer_precinct", "issuer_precinct", "frequency", None),
    "chart_codes_per_precinct": ("top5_code_per_precinct", "violation_code", "frequency", "issuer_precinct"),
    "chart_codes_per_bin": ("top3_code_per_bin", "violation_code", "frequency", "time_of_day"),
    "chart_bins_per_code": ("top5_bin_per_code", "time_of_day", "frequency", "violation_code"),
    "chart_seasons": ("tickets_per_season", "season", "frequency", None),
    "chart_codes_per_season": ("top3_code_per_season", "violation_code", "frequency", "season"),
    "chart_revenue": ("revenue", "violation_code", "revenue", None),
}


def _chart(question: str, x: str, y: str, row: str | None) -> QueryFn:
    fn = QUERIES[question]
    return lambda s, d: facet_frame(fn(s, d), x=x, y=y, fill=x, facet_row=row, facet_col="fiscal_year")


def _chart_sql(question: str, x: str, y: str, row: str | None) -> str:
    facet = f"{row} AS facet_row, " if row else ""
    return (
        f"SELECT CAST({x} AS VARCHAR) AS x, {y} AS y, CAST({x} AS VARCHAR) AS fill, {facet}fiscal_year AS facet_col "
        f"FROM (\n{ORACLE[question]}\n) t"
    )


# the whole script: the same charts over the distinct records of three years, clock times by a rule on the number
_SCRIPT_CTE = (
    f"script AS (SELECT DISTINCT fiscal_year, {', '.join(CSV_COLUMNS)}, "
    "CASE WHEN summons_number % 97 = 0 THEN CASE WHEN summons_number % 2 = 1 THEN 480 END "
    "WHEN summons_number % 89 <> 0 THEN summons_number % 1440 END AS minute_of_day "
    f"FROM tickets WHERE fiscal_year IN {SCRIPT_YEARS})"
)
_SCRIPT_BINS = f"binned AS (SELECT *, {_BIN_SQL} AS time_of_day FROM script WHERE minute_of_day IS NOT NULL)"
_SCRIPT_CHARTS = {
    "codes": (_top_sql(_freq_sql("violation_code"), "fiscal_year", 5), "violation_code", "frequency", None),
    "body_types": (_top_sql(_freq_sql("vehicle_body_type"), "fiscal_year", 5), "vehicle_body_type", "frequency", None),
    "makes": (_top_sql(_freq_sql("vehicle_make"), "fiscal_year", 5), "vehicle_make", "frequency", None),
    "violation_precincts": (_top_sql(_freq_sql("violation_precinct"), "fiscal_year", 5), "violation_precinct", "frequency", None),
    "issuer_precincts": (_top_sql(_freq_sql("issuer_precinct"), "fiscal_year", 5), "issuer_precinct", "frequency", None),
    "codes_per_precinct": (_TOP5_PER_PRECINCT, "violation_code", "frequency", "issuer_precinct"),
    "codes_per_bin": (_TOP3_PER_BIN, "violation_code", "frequency", "time_of_day"),
    "bins_per_code": (_TOP5_BIN_PER_CODE, "time_of_day", "frequency", "violation_code"),
    "seasons": (
        f"SELECT fiscal_year, season, count(*) AS frequency FROM (SELECT *, {_SEASON} AS season FROM tickets) GROUP BY fiscal_year, season",
        "season", "frequency", None,
    ),
    "codes_per_season": (_TOP3_PER_SEASON, "violation_code", "frequency", "season"),
    "revenue": (_REVENUE, "violation_code", "revenue", None),
}
ORACLE["whole_script"] = _with(TICKETS_CTE, FINES_CTE, _SCRIPT_CTE, _SCRIPT_BINS) + " UNION ALL ".join(
    f"SELECT '{name}' AS chart, CAST({x} AS VARCHAR) AS x, CAST({y} AS DOUBLE) AS y, CAST({x} AS VARCHAR) AS fill, "
    f"CAST({row or 'NULL'} AS VARCHAR) AS facet_row, fiscal_year AS facet_col FROM ({sql.replace('FROM tickets', 'FROM script')}) c"
    for name, (sql, x, y, row) in _SCRIPT_CHARTS.items()
)

for _name, _spec in CHARTS.items():
    QUERIES[_name] = _chart(*_spec)
    ORACLE[_name] = _chart_sql(*_spec)

# --------------------------------------------------------------------------
# Portable output columns
# --------------------------------------------------------------------------
# Result tables travel to a comparison harness through pandas or Arrow.  Two
# column kinds convert differently on the two engines' pandas paths: DATE
# (Python dates vs datetime64) and integers holding NULLs (float64 vs a
# nullable integer type).  In the registered outputs such columns are given
# one representation on both sides - dates as ISO ``yyyy-MM-dd`` text,
# NULL-holding integers as DOUBLE.  The library functions keep their types.
DATE_COLUMNS = {
    "drop_empty_columns": ["issue_date"],
    "first_columns": ["issue_date"],
    "parse_issue_date": ["issue_date"],
    "fiscal_year_label": ["issue_date"],
    "fiscal_filter": ["issue_date"],
    "clean_year": ["issue_date"],
    "combine_years": ["issue_date"],
    "season_label": ["issue_date"],
    "fiscal_filter_range": ["issue_date"],
    "sample_rows": ["issue_date"],
    "clean_sink": ["issue_date"],
    "fiscal_filter_gaps": ["issue_date"],
}
NULLABLE_INT_COLUMNS = {
    "freq_code_gaps": ["violation_code"],
    "freq_code_star_gaps": ["violation_code"],
    "top5_code_gaps": ["violation_code"],
    "revenue_rollup": ["fiscal_year", "violation_code"],
    "yoy_tickets": ["prev_n_tickets", "change_n_tickets"],
    "parse_clock_time": ["minute_of_day"],
    "parse_clock_time_additive": ["minute_of_day"],
    "ticket_cube": ["fiscal_year", "violation_code", "violation_precinct", "issuer_precinct"],
    "time_cube": ["fiscal_year"],
    "schema_diff": ["n_c"],
}


def _portable_df(name: str, fn: QueryFn) -> QueryFn:
    dates = DATE_COLUMNS.get(name, [])
    doubles = NULLABLE_INT_COLUMNS.get(name, [])
    if not dates and not doubles:
        return fn

    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = fn(spark, sf)
        cols = {c: F.date_format(c, "yyyy-MM-dd") for c in dates}
        cols.update({c: F.col(c).cast("double") for c in doubles})
        return df.withColumns(cols)

    run.__name__ = name
    return run


def _portable_sql(name: str, sql: str) -> str:
    parts = [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in DATE_COLUMNS.get(name, [])]
    parts += [f"CAST({c} AS DOUBLE) AS {c}" for c in NULLABLE_INT_COLUMNS.get(name, [])]
    if not parts:
        return sql
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) q"


QUERIES = {name: _portable_df(name, fn) for name, fn in QUERIES.items()}
ORACLE = {name: _portable_sql(name, sql) for name, sql in ORACLE.items()}
