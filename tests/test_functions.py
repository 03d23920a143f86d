"""Scalar functions on tiny literal frames (dates, clock text, labels)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ticketlens.functions import (
    ADDITIVE,
    CLOCK,
    bin_initials,
    clock_string,
    clock_timestamp,
    fill_time,
    fiscal_year_bounds,
    fiscal_year_of,
    hour_of,
    in_fiscal_year,
    minute_of_day,
    parse_date,
    season_label,
    time_bin,
)


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {typ}")


def col_values(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_parse_date_padded_unpadded_bad_null(spark):
    df = one_col(spark, ["06/03/2015", "6/3/2015", "2016-13-45", "13/45/2016", None])
    assert col_values(df, parse_date("v")) == [
        dt.date(2015, 6, 3),
        dt.date(2015, 6, 3),
        None,
        None,
        None,
    ]


def test_fiscal_year_of_and_bounds(spark):
    df = one_col(
        spark,
        [dt.date(2014, 6, 30), dt.date(2014, 7, 1), dt.date(2015, 6, 30), dt.date(2015, 7, 1), None],
        "date",
    )
    assert col_values(df, fiscal_year_of("v")) == [2014, 2015, 2015, 2016, None]
    assert fiscal_year_bounds(2015) == (dt.date(2014, 7, 1), dt.date(2015, 7, 1))
    assert fiscal_year_bounds(2015, start_month=1) == (dt.date(2015, 1, 1), dt.date(2016, 1, 1))


def test_fiscal_edges_keep_middle_two(spark):
    df = one_col(
        spark,
        [dt.date(2014, 6, 30), dt.date(2014, 7, 1), dt.date(2015, 6, 30), dt.date(2015, 7, 1), None],
        "date",
    )
    kept = [r.v for r in df.where(in_fiscal_year("v", 2015)).orderBy("i").collect()]
    assert kept == [dt.date(2014, 7, 1), dt.date(2015, 6, 30)]
    # per-row year column gives the same answer
    labelled = df.withColumn("fy", F.lit(2015))
    kept2 = [r.v for r in labelled.where(in_fiscal_year("v", "fy")).orderBy("i").collect()]
    assert kept2 == kept


def test_clock_mode(spark):
    df = one_col(spark, ["1203A", "0752A", "1230P", "0145P", "0000A", "1159P"])
    assert col_values(df, minute_of_day("v", CLOCK)) == [3, 7 * 60 + 52, 12 * 60 + 30, 13 * 60 + 45, 0, 23 * 60 + 59]


def test_additive_mode(spark):
    df = one_col(spark, ["1230A", "0145P", "1230P", "1330P", "0752"])
    assert col_values(df, minute_of_day("v", ADDITIVE)) == [12 * 60 + 30, 13 * 60 + 45, 30, 60 + 30, 7 * 60 + 52]


@pytest.mark.parametrize("mode", [CLOCK, ADDITIVE])
def test_bad_clock_text_is_null(spark, mode):
    df = one_col(spark, ["8752A", "0799A", "07", "", None, "12:3A", "abcdP"])
    assert col_values(df, minute_of_day("v", mode)) == [None] * 7


def test_clock_mode_rejects_missing_suffix_and_hour_13(spark):
    df = one_col(spark, ["0752", "1352P"])
    assert col_values(df, minute_of_day("v", CLOCK)) == [None, None]


def test_fill_time(spark):
    df = spark.createDataFrame(
        [(0, None, "0800A"), (1, None, "ALL"), (2, None, None), (3, "0100P", "0800A")],
        "i INT, t STRING, f STRING",
    )
    assert col_values(df, fill_time("t", "f")) == ["0800A", None, None, "0100P"]


def test_clock_string_and_timestamp(spark):
    df = one_col(spark, ["0752A", "1230P"])
    assert col_values(df, clock_string("v")) == ["07:52", "12:30"]
    ts = col_values(df, clock_timestamp(minute_of_day("v")))
    assert ts == [dt.datetime(1970, 1, 1, 7, 52), dt.datetime(1970, 1, 1, 12, 30)]


def test_time_bins(spark):
    hours = [0, 1, 2, 5, 6, 9, 10, 13, 14, 17, 18, 21, 22, 23, None]
    df = one_col(spark, hours, "int")
    got = col_values(df, bin_initials(time_bin("v")))
    assert got == ["LN", "LN", "EM", "EM", "M", "M", "A", "A", "E", "E", "N", "N", "LN", "LN", None]


def test_hour_of(spark):
    df = one_col(spark, [0, 59, 60, 1439], "int")
    assert col_values(df, hour_of("v")) == [0, 0, 1, 23]


def test_seasons(spark):
    df = one_col(spark, list(range(1, 13)) + [None], "int")
    got = col_values(df, season_label("v"))
    short = {"Winter": "W", "Spring": "Sp", "Summer": "Su", "Autumn": "Au", None: None}
    assert [short[g] for g in got] == ["W", "W", "Sp", "Sp", "Sp", "Su", "Su", "Su", "Au", "Au", "Au", "W", None]
