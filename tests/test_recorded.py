"""The case study's recorded outputs used as data.

The raw files are not available, but the study pasted several result tables
as comments.  Feeding one table to an operator must give the next recorded
table: frequencies x fines -> recorded revenue, per-group rankings ->
recorded rank lists.
"""

from ticketlens.functions.labels import TIME_BIN_INITIALS
from ticketlens.operators import (
    fines_from_averages,
    rank_list,
    revenue,
    revenue_rollup,
    top_n_per_group,
    top_revenue_code,
    yearly_revenue,
    yoy,
)
from ticketlens.operators.revenue import CASE_STUDY_AVERAGE_FINES
from pyspark.sql import functions as F

# Recorded top-5 violation codes per fiscal year
# (fiscal year, code, frequency).
RECORDED_TOP5_CODES = [
    (2016, 21, 1497269), (2016, 36, 1232952), (2016, 38, 1126835), (2016, 14, 860045), (2016, 37, 677805),
    (2017, 21, 1500396), (2017, 36, 1345237), (2017, 38, 1050418), (2017, 14, 880152), (2017, 20, 609231),
    (2015, 21, 1469228), (2015, 38, 1305007), (2015, 14, 908418), (2015, 36, 747098), (2015, 37, 735600),
]
# Recorded revenue per year and code, and the yearly totals.
RECORDED_REVENUE = {
    (2017, 14): 101217480, (2017, 21): 82521780, (2017, 38): 52520900,
    (2016, 14): 98905175, (2016, 21): 82349795, (2016, 38): 56341750,
    (2015, 14): 104468070, (2015, 21): 80807540, (2015, 38): 65250350,
}
RECORDED_TOTALS = {2015: 250525960, 2016: 237596720, 2017: 236260160}

# Recorded top-5 codes in the three busiest issuer precincts
# (fiscal year, precinct, code, frequency) and the recorded rank lists.
RECORDED_PRECINCT_CODES = [
    (2017, 14, 14, 73007), (2017, 14, 69, 57316), (2017, 14, 31, 39430), (2017, 14, 47, 30200), (2017, 14, 42, 20402),
    (2016, 14, 69, 66874), (2016, 14, 14, 61358), (2016, 14, 31, 35169), (2016, 14, 47, 23985), (2016, 14, 42, 23293),
    (2015, 14, 69, 79330), (2015, 14, 14, 75985), (2015, 14, 31, 40410), (2015, 14, 42, 27755), (2015, 14, 47, 26811),
    (2015, 0, 36, 747098), (2015, 0, 7, 567951), (2015, 0, 21, 173191), (2015, 0, 5, 127153), (2015, 0, 66, 4703),
    (2016, 19, 38, 76178), (2016, 19, 37, 74758), (2016, 19, 46, 71509), (2016, 19, 14, 60856), (2016, 19, 21, 57601),
    (2017, 0, 36, 1345237), (2017, 0, 7, 464690), (2017, 0, 21, 258771), (2017, 0, 5, 130963), (2017, 0, 66, 9281),
    (2015, 19, 38, 89102), (2015, 19, 37, 78716), (2015, 19, 14, 59915), (2015, 19, 16, 55762), (2015, 19, 21, 55296),
    (2017, 19, 46, 84789), (2017, 19, 38, 71631), (2017, 19, 37, 71592), (2017, 19, 14, 56873), (2017, 19, 21, 54033),
    (2016, 0, 36, 1232951), (2016, 0, 7, 457871), (2016, 0, 21, 226687), (2016, 0, 5, 106617), (2016, 0, 66, 7275),
]
RECORDED_PRECINCT_LISTS = {
    (2017, 0): "36,07,21,05,66", (2017, 14): "14,69,31,47,42", (2017, 19): "46,38,37,14,21",
    (2016, 0): "36,07,21,05,66", (2016, 14): "69,14,31,47,42", (2016, 19): "38,37,46,14,21",
    (2015, 0): "36,07,21,05,66", (2015, 14): "69,14,31,42,47", (2015, 19): "38,37,14,16,21",
}

# Recorded top-5 times of day for codes 14, 21 and 38
# (fiscal year, code, time of day, frequency) and the recorded lists.
RECORDED_BINS_PER_CODE = [
    (2017, 14, "Morning", 273567), (2017, 14, "Evening", 235729), (2017, 14, "Afternoon", 201580),
    (2017, 14, "Late Night", 93952), (2017, 14, "Night", 48595),
    (2016, 14, "Morning", 271737), (2016, 14, "Evening", 218313), (2016, 14, "Afternoon", 198623),
    (2016, 14, "Late Night", 96113), (2016, 14, "Night", 46568),
    (2017, 21, "Morning", 844285), (2017, 21, "Afternoon", 436648), (2017, 21, "Late Night", 186348),
    (2017, 21, "Early Morning", 32248), (2017, 21, "Evening", 548),
    (2015, 14, "Morning", 280973), (2015, 14, "Evening", 237059), (2015, 14, "Afternoon", 214853),
    (2015, 14, "Late Night", 99802), (2015, 14, "Night", 49055),
    (2016, 21, "Morning", 843694), (2016, 21, "Afternoon", 453488), (2016, 21, "Late Night", 172421),
    (2016, 21, "Early Morning", 26697), (2016, 21, "Evening", 593),
    (2016, 38, "Evening", 384862), (2016, 38, "Afternoon", 358220), (2016, 38, "Morning", 172527),
    (2016, 38, "Late Night", 124295), (2016, 38, "Night", 86443),
    (2015, 21, "Morning", 817539), (2015, 21, "Afternoon", 456602), (2015, 21, "Late Night", 168867),
    (2015, 21, "Early Morning", 24944), (2015, 21, "Evening", 809),
    (2015, 38, "Evening", 445972), (2015, 38, "Afternoon", 411271), (2015, 38, "Morning", 205162),
    (2015, 38, "Late Night", 141099), (2015, 38, "Night", 100776),
    (2017, 38, "Evening", 379239), (2017, 38, "Afternoon", 330862), (2017, 38, "Morning", 155623),
    (2017, 38, "Late Night", 110884), (2017, 38, "Night", 73387),
]
RECORDED_BIN_LISTS = {
    14: "M,E,A,LN,N",
    21: "M,A,LN,EM,E",
    38: "E,A,M,LN,N",
}


def test_revenue_from_recorded_frequencies(spark):
    freq = spark.createDataFrame(RECORDED_TOP5_CODES, "fiscal_year INT, violation_code INT, frequency BIGINT")
    top4 = top_n_per_group(freq, "fiscal_year", "frequency", 4)
    fines = fines_from_averages(spark, CASE_STUDY_AVERAGE_FINES)
    rev = revenue(top4, fines, fines_rows=len(CASE_STUDY_AVERAGE_FINES))
    got = {(r.fiscal_year, r.violation_code): r.revenue for r in rev.collect() if r.fine_known}
    assert got == {k: float(v) for k, v in RECORDED_REVENUE.items()}
    unknown = [r for r in rev.collect() if not r.fine_known]
    assert {r.violation_code for r in unknown} == {36} and all(r.revenue == 0.0 for r in unknown)

    totals = {r.fiscal_year: r.revenue for r in revenue_rollup(rev).collect() if r.level == 1}
    assert totals == {k: float(v) for k, v in RECORDED_TOTALS.items()}
    best = {r.fiscal_year: r.top_code for r in top_revenue_code(rev).collect()}
    assert best == {2015: 14, 2016: 14, 2017: 14}
    change = yoy(yearly_revenue(rev), "total_revenue").orderBy("fiscal_year").collect()
    assert [r.change_total_revenue < 0 for r in change[1:]] == [True, True]  # falls every year


def test_rank_lists_from_recorded_precinct_table(spark):
    df = spark.createDataFrame(
        RECORDED_PRECINCT_CODES, "fiscal_year INT, issuer_precinct INT, violation_code INT, frequency BIGINT"
    )
    ranked = top_n_per_group(df, ["fiscal_year", "issuer_precinct"], "frequency", 5)
    lists = rank_list(ranked, ["fiscal_year", "issuer_precinct"], "violation_code", pad=2)
    got = {(r.fiscal_year, r.issuer_precinct): r.rank_list for r in lists.collect()}
    assert got == RECORDED_PRECINCT_LISTS


def test_rank_lists_from_recorded_bin_table(spark):
    df = spark.createDataFrame(
        RECORDED_BINS_PER_CODE, "fiscal_year INT, violation_code INT, time_of_day STRING, frequency BIGINT"
    )
    ranked = top_n_per_group(df, ["fiscal_year", "violation_code"], "frequency", 5)
    initials = F.create_map(*[F.lit(x) for kv in TIME_BIN_INITIALS.items() for x in kv])[F.col("time_of_day")]
    lists = rank_list(ranked, ["fiscal_year", "violation_code"], initials)
    got = {(r.fiscal_year, r.violation_code): r.rank_list for r in lists.collect()}
    assert got == {(y, c): RECORDED_BIN_LISTS[c] for y in (2015, 2016, 2017) for c in (14, 21, 38)}


# Recorded top-3 codes per time-of-day bin
# (fiscal year, bin, code, frequency).
RECORDED_CODES_PER_BIN = [
    (2017, "Early Morning", 40, 50460), (2017, "Early Morning", 21, 32248), (2017, "Early Morning", 14, 26719),
    (2017, "Late Night", 36, 204242), (2017, "Late Night", 21, 186348), (2017, "Late Night", 38, 110884),
    (2017, "Evening", 38, 379239), (2017, "Evening", 37, 284663), (2017, "Evening", 14, 235729),
    (2017, "Morning", 21, 844285), (2017, "Morning", 36, 353910), (2017, "Morning", 14, 273567),
    (2015, "Night", 7, 101896), (2015, "Night", 38, 100776), (2015, "Night", 14, 49055),
    (2015, "Early Morning", 40, 40851), (2015, "Early Morning", 14, 26663), (2015, "Early Morning", 21, 24944),
    (2017, "Afternoon", 36, 594090), (2017, "Afternoon", 21, 436648), (2017, "Afternoon", 38, 330862),
    (2016, "Late Night", 21, 172421), (2016, "Late Night", 36, 164171), (2016, "Late Night", 38, 124295),
    (2016, "Evening", 38, 384862), (2016, "Evening", 37, 314841), (2016, "Evening", 36, 256624),
    (2016, "Early Morning", 40, 40224), (2016, "Early Morning", 14, 28674), (2016, "Early Morning", 21, 26697),
    (2016, "Night", 38, 86443), (2016, "Night", 7, 82456), (2016, "Night", 14, 46568),
    (2015, "Evening", 38, 445972), (2015, "Evening", 37, 340951), (2015, "Evening", 14, 237059),
    (2015, "Late Night", 21, 168867), (2015, "Late Night", 38, 141099), (2015, "Late Night", 36, 100871),
    (2016, "Afternoon", 36, 475441), (2016, "Afternoon", 21, 453488), (2016, "Afternoon", 38, 358220),
    (2015, "Morning", 21, 817539), (2015, "Morning", 14, 280973), (2015, "Morning", 36, 215373),
    (2016, "Morning", 21, 843694), (2016, "Morning", 36, 336379), (2016, "Morning", 14, 271737),
    (2017, "Night", 7, 84112), (2017, "Night", 38, 73387), (2017, "Night", 14, 48595),
    (2015, "Afternoon", 21, 456602), (2015, "Afternoon", 38, 411271), (2015, "Afternoon", 36, 289998),
]
# The recorded summary lists of that table.
RECORDED_BIN_CODE_LISTS = {
    (2017, "Morning"): "21,36,14", (2017, "Afternoon"): "36,21,38", (2017, "Evening"): "38,37,14",
    (2017, "Night"): "07,38,14", (2017, "Late Night"): "36,21,38", (2017, "Early Morning"): "40,21,14",
    (2016, "Morning"): "21,36,14", (2016, "Afternoon"): "36,21,38", (2016, "Evening"): "38,37,36",
    (2016, "Night"): "38,07,14", (2016, "Late Night"): "21,36,38", (2016, "Early Morning"): "40,14,21",
    (2015, "Morning"): "21,14,36", (2015, "Afternoon"): "21,38,36", (2015, "Evening"): "38,37,14",
    (2015, "Night"): "07,38,14", (2015, "Late Night"): "21,38,36", (2015, "Early Morning"): "40,14,21",
}


def test_rank_lists_and_common_codes_from_recorded_bin_table(spark):
    from ticketlens.operators import common_items

    df = spark.createDataFrame(
        RECORDED_CODES_PER_BIN, "fiscal_year INT, time_of_day STRING, violation_code INT, frequency BIGINT"
    )
    ranked = top_n_per_group(df, ["fiscal_year", "time_of_day"], "frequency", 3)
    lists = rank_list(ranked, ["fiscal_year", "time_of_day"], "violation_code", pad=2)
    got = {(r.fiscal_year, r.time_of_day): r.rank_list for r in lists.collect()}
    assert got == RECORDED_BIN_CODE_LISTS
    # no code is in the top 3 of every time bin in any year (e.g. 2017 Night
    # is 07,38,14 and 2017 Late Night is 36,21,38)
    assert common_items(ranked, "fiscal_year", "violation_code", "time_of_day").count() == 0


def test_common_codes_from_recorded_precinct_table(spark):
    from ticketlens.operators import common_items

    df = spark.createDataFrame(
        RECORDED_PRECINCT_CODES, "fiscal_year INT, issuer_precinct INT, violation_code INT, frequency BIGINT"
    )
    ranked = top_n_per_group(df, ["fiscal_year", "issuer_precinct"], "frequency", 5)
    # the three busiest precincts share no top-5 code in any year
    assert common_items(ranked, "fiscal_year", "violation_code", "issuer_precinct").count() == 0
    # but codes 14 and 21 are in the top 5 of two of them every year
    two = ranked.groupBy("fiscal_year", "violation_code").count().where("count = 2")
    pairs = {(r.fiscal_year, r.violation_code) for r in two.collect()}
    assert {(y, c) for y in (2015, 2016, 2017) for c in (14, 21)} <= pairs


# Recorded tickets per fiscal year and per season.
RECORDED_TICKETS = {2015: 10598036, 2016: 10396894, 2017: 10539563}
RECORDED_SEASONS = [
    (2017, "Summer", 2353920), (2017, "Autumn", 2829224), (2017, "Winter", 2483036), (2017, "Spring", 2873383),
    (2016, "Summer", 2214536), (2016, "Autumn", 2971672), (2016, "Winter", 2421620), (2016, "Spring", 2789066),
    (2015, "Summer", 2838306), (2015, "Autumn", 2718502), (2015, "Winter", 2180241), (2015, "Spring", 2860987),
]


def test_law_seasons_add_up_to_recorded_years(spark):
    seasons = spark.createDataFrame(RECORDED_SEASONS, "fiscal_year INT, season STRING, frequency BIGINT")
    totals = {r.fiscal_year: r.n for r in seasons.groupBy("fiscal_year").agg(F.sum("frequency").alias("n")).collect()}
    assert totals == RECORDED_TICKETS


def test_law_bin_tables_agree_on_shared_cells(spark):
    by_bin = spark.createDataFrame(
        RECORDED_CODES_PER_BIN, "fiscal_year INT, time_of_day STRING, violation_code INT, frequency BIGINT"
    )
    by_code = spark.createDataFrame(
        RECORDED_BINS_PER_CODE, "fiscal_year INT, violation_code INT, time_of_day STRING, frequency BIGINT"
    )
    keys = ["fiscal_year", "time_of_day", "violation_code"]
    shared = by_bin.alias("a").join(by_code.alias("b"), keys)
    assert shared.count() == 32
    assert shared.where(F.col("a.frequency") != F.col("b.frequency")).count() == 0


# Recorded tickets without an address, 3- and 2-column rules.
RECORDED_MISSING_3 = {2015: 3696, 2016: 2640, 2017: 2418}
RECORDED_MISSING_2 = {2015: 3759, 2016: 2788, 2017: 2553}


def test_law_two_column_missing_at_least_three_column():
    assert all(RECORDED_MISSING_2[y] >= RECORDED_MISSING_3[y] for y in RECORDED_MISSING_3)


def test_law_binned_counts_within_yearly_total(spark):
    """Code 14 in 2017: its five top bins plus its sixth bin (Early Morning,
    from the codes-per-bin table) fall 10 short of its yearly count - the
    tickets whose time could not be read."""
    top5 = spark.createDataFrame(RECORDED_TOP5_CODES, "fiscal_year INT, violation_code INT, frequency BIGINT")
    bins = spark.createDataFrame(
        RECORDED_BINS_PER_CODE, "fiscal_year INT, violation_code INT, time_of_day STRING, frequency BIGINT"
    )
    per_bin = spark.createDataFrame(
        RECORDED_CODES_PER_BIN, "fiscal_year INT, time_of_day STRING, violation_code INT, frequency BIGINT"
    )
    sel = (F.col("fiscal_year") == 2017) & (F.col("violation_code") == 14)
    total = top5.where(sel).collect()[0].frequency
    five = bins.where(sel).agg(F.sum("frequency")).collect()[0][0]
    sixth = per_bin.where(sel & (F.col("time_of_day") == "Early Morning")).collect()[0].frequency
    assert total - five - sixth == 10
