"""Operators on tiny literal frames: NULL groups, ties, dedupe, unions,
profiles, joins, comparisons and revenue."""

import datetime as dt
from decimal import Decimal

import pytest


from conftest import rows
from ticketlens.operators import (
    average_fine,
    clean_year,
    combine_years,
    common_items,
    dedupe,
    drop_empty_columns,
    duplicate_report,
    empty_columns,
    facet_frame,
    fines_frame,
    fines_join,
    first_columns,
    frequency,
    missing_count,
    month_histogram,
    null_profile,
    pivot_years,
    rank_list,
    restrict_to,
    revenue,
    revenue_rollup,
    row_count,
    sample_rows,
    schema_diff,
    schema_profile,
    share_lift,
    top_n,
    top_n_per_group,
    top_revenue_code,
    yoy,
)
from ticketlens.plans import questions as q


def test_null_group_count_col_vs_star(spark):
    df = spark.createDataFrame([(1, "x"), (1, None), (1, None)], "fy INT, item STRING")
    by_col = {r["item"]: r["frequency"] for r in frequency(df, "fy", "item").collect()}
    by_star = {r["item"]: r["frequency"] for r in frequency(df, "fy", "item", count_nulls=True).collect()}
    assert by_col == {"x": 1, None: 0}
    assert by_star == {"x": 1, None: 2}


def test_dense_rank_keeps_ties(spark):
    counts = [5, 5, 4, 3, 3, 2]
    df = spark.createDataFrame([(1, f"i{k}", c) for k, c in enumerate(counts)], "fy INT, item STRING, frequency BIGINT")
    top = top_n_per_group(df, "fy", "frequency", 3)
    assert len(top.collect()) == 5
    assert sorted(r.rnk for r in top.collect()) == [1, 1, 2, 3, 3]
    exact = top_n_per_group(df, "fy", "frequency", 3, ties="row", tiebreak=["item"])
    assert rows(exact, "item") == [("i0",), ("i1",), ("i2",)]


def test_top_n_per_group_partitions(spark):
    df = spark.createDataFrame(
        [(1, "a", 3), (1, "b", 2), (2, "a", 1), (2, "c", 9), (2, "d", 8)], "fy INT, item STRING, frequency BIGINT"
    )
    got = rows(top_n_per_group(df, "fy", "frequency", 1), "fy", "item")
    assert got == [(1, "a"), (2, "c")]


def test_global_top_n_tiebreak(spark):
    df = spark.createDataFrame([(3, 10), (1, 10), (2, 9), (0, 10)], "p INT, frequency BIGINT")
    assert [r.p for r in top_n(df, "frequency", 3, tiebreak=["p"]).collect()] == [0, 1, 3]


def test_missing_address_three_and_two_columns(spark):
    combos = [(a, b, c) for a in (None, "h") for b in (None, "s") for c in (None, "x")]
    df = spark.createDataFrame(
        [(2015, i, *c) for i, c in enumerate(combos)],
        "fiscal_year INT, summons_number INT, house_number STRING, street_name STRING, intersecting_street STRING",
    )
    three = q.missing_address(df).collect()
    two = q.missing_address(df, columns=["house_number", "street_name"]).collect()
    assert [r.n_missing for r in three] == [1]
    assert [r.n_missing for r in two] == [2]


def test_dedupe_and_duplicate_report(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (1, "b")], "x INT, y STRING")
    assert dedupe(df).count() == 2
    rep = duplicate_report(df).collect()[0]
    assert (rep.n_rows, rep.distinct_rows, rep.duplicates) == (4, 2, 2)
    assert dedupe(df, ["x"]).count() == 1


def test_duplicate_report_nulls_compare_equal(spark):
    df = spark.createDataFrame([(None, "a"), (None, "a")], "x INT, y STRING")
    rep = duplicate_report(df).collect()[0]
    assert (rep.n_rows, rep.distinct_rows, rep.duplicates) == (2, 1, 1)


def test_combine_years_fills_missing_columns(spark):
    full = spark.createDataFrame([(1, "a", "lat")], "id INT, v STRING, latitude STRING")
    short = spark.createDataFrame([(2, "b")], "id INT, v STRING")
    out = combine_years({2016: full, 2017: short})
    assert out.columns == ["id", "v", "latitude"]
    assert rows(out) == [(1, "a", "lat"), (2, "b", None)]
    diff = schema_diff({"y2016": full, "y2017": short})
    assert rows(diff, "column_name", "in_y2016", "in_y2017") == [
        ("id", True, True),
        ("latitude", True, False),
        ("v", True, True),
    ]


def test_first_columns_by_count_and_name(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, b INT, c INT")
    assert first_columns(df, 2).columns == ["a", "b"]
    assert first_columns(df, ["c", "a"]).columns == ["c", "a"]


def test_null_profile_and_drop_empty(spark):
    df = spark.createDataFrame([(1, None, None), (None, "x", None)], "a INT, b STRING, c STRING")
    prof = {r.column_name: (r.n_null, r.n_rows) for r in null_profile(df).collect()}
    assert prof == {"a": (1, 2), "b": (1, 2), "c": (2, 2)}
    assert empty_columns(df) == ["c"]
    assert drop_empty_columns(df).columns == ["a", "b"]


def test_profile_counts(spark):
    df = spark.createDataFrame(
        [(dt.date(2015, 1, 3), None), (dt.date(2015, 1, 9), "t"), (dt.date(2016, 2, 1), "t")], "d DATE, t STRING"
    )
    assert row_count(df).collect()[0].n_rows == 3
    assert missing_count(df, "t").collect()[0].n_missing == 1
    hist = [(r.year, r.month, r.n) for r in month_histogram(df, "d").collect()]
    assert hist == [(2015, 1, 2), (2016, 2, 1)]
    prof = schema_profile(df).collect()
    assert [(r.position, r.column_name, r.data_type) for r in prof] == [(1, "d", "date"), (2, "t", "string")]


def test_sample_is_seeded_subset(spark):
    df = spark.range(2000)
    a = {r.id for r in sample_rows(df, 0.05, seed=7).collect()}
    b = {r.id for r in sample_rows(df, 0.05, seed=7).collect()}
    assert a == b and 0 < len(a) < 2000


def test_clean_year_dedupes_parses_labels_filters(spark):
    raw = spark.createDataFrame(
        [
            (1, "06/30/2014", "x", None),  # before FY2015: dropped
            (2, "07/01/2014", "x", None),
            (2, "07/01/2014", "x", None),  # exact copy: dropped
            (3, "6/30/2015", "y", None),
            (4, "07/01/2015", "y", None),  # after FY2015: dropped
            (5, "bad", "z", None),  # unparseable: dropped
        ],
        "summons_number INT, issue_date STRING, plate_type STRING, empty STRING",
    )
    out = clean_year(raw, 2015, keep=3)
    assert out.columns == ["summons_number", "issue_date", "plate_type", "fiscal_year"]
    assert rows(out) == [(2, dt.date(2014, 7, 1), "x", 2015), (3, dt.date(2015, 6, 30), "y", 2015)]


def test_clean_year_per_row_file_year(spark):
    raw = spark.createDataFrame(
        [(2015, 1, "07/01/2014"), (2015, 1, "07/01/2014"), (2016, 1, "07/01/2014"), (2016, 2, "07/01/2015")],
        "file_year INT, summons_number INT, issue_date STRING",
    )
    out = clean_year(raw, "file_year", keep=["summons_number", "issue_date"])
    assert rows(out, "fiscal_year", "summons_number") == [(2015, 1), (2016, 2)]


def test_restrict_to_semi_join(spark):
    facts = spark.createDataFrame([(0, "a"), (19, "b"), (5, "c")], "p INT, v STRING")
    keys = spark.createDataFrame([(0,), (19,), (19,)], "p INT")
    assert rows(restrict_to(facts, keys, "p", row_bound=3)) == [(0, "a"), (19, "b")]


def test_rank_list_orders_by_rank_then_text(spark):
    df = spark.createDataFrame(
        [(2017, 0, 36, 1), (2017, 0, 7, 2), (2017, 0, 21, 3), (2017, 0, 5, 3)], "fy INT, p INT, code INT, rnk INT"
    )
    got = rank_list(df, ["fy", "p"], "code", pad=2).collect()[0].rank_list
    assert got == "36,07,05,21"


def test_common_items_across_facets(spark):
    df = spark.createDataFrame(
        [(1, "A", 14), (1, "A", 21), (1, "B", 14), (1, "B", 38), (2, "A", 21)], "fy INT, facet STRING, code INT"
    )
    got = rows(common_items(df, "fy", "code", "facet"), "fy", "code")
    assert got == [(1, 14), (2, 21)]


def test_share_lift(spark):
    freq = spark.createDataFrame(
        [(1, "p1", "a", 3), (1, "p1", "b", 1), (1, "p2", "a", 1), (1, "p2", "b", 3)],
        "fy INT, p STRING, code STRING, frequency BIGINT",
    )
    got = {(r.p, r.code): (r.share, r.overall_share, r.lift) for r in share_lift(freq, "fy", "p", "code").collect()}
    assert got[("p1", "a")] == (0.75, 0.5, 1.5)
    assert got[("p2", "a")] == (0.25, 0.5, 0.5)


def test_pivot_and_yoy(spark):
    df = spark.createDataFrame([(1, 2015), (1, 2016), (1, 2016), (2, 2017)], "code INT, fy INT")
    piv = {r.code: (r.fy_2015, r.fy_2016, r.fy_2017) for r in pivot_years(df, "code", "fy", [2015, 2016, 2017]).collect()}
    assert piv == {1: (1, 2, 0), 2: (0, 0, 1)}
    totals = spark.createDataFrame([(2015, 100), (2016, 80), (2017, 100)], "fy INT, n BIGINT")
    got = [(r.prev_n, r.change_n, r.pct_change_n) for r in yoy(totals, "n", "fy").orderBy("fy").collect()]
    assert got == [(None, None, None), (100, -20, -20.0), (80, 20, 25.0)]


def test_facet_frame(spark):
    df = spark.createDataFrame([(2015, 21, 10)], "fy INT, code INT, frequency BIGINT")
    r = facet_frame(df, "code", "frequency", facet_col="fy").collect()[0]
    assert (r.x, r.y, r.fill, r.facet_col) == ("21", 10, "21", 2015)


def test_fines_join_revenue_unknown_and_absent(spark):
    fines = fines_frame(spark, [(21, 65, 45), (36, None, None), (99, 10, 10)])
    avg = {r.code: (r.average_fine, r.fine_known) for r in average_fine(fines).collect()}
    assert avg == {21: (Decimal("55.00"), True), 36: (None, False), 99: (Decimal("10.00"), True)}
    freq = spark.createDataFrame([(2015, 21, 10), (2015, 36, 7), (2015, 40, 3)], "fiscal_year INT, violation_code INT, frequency BIGINT")
    joined = fines_join(freq, fines, fines_rows=3)
    assert sorted(r.violation_code for r in joined.collect()) == [21, 36]  # 40 has no row: dropped
    rev = {r.violation_code: (r.revenue, r.fine_known) for r in revenue(freq, fines, fines_rows=3).collect()}
    assert rev == {21: (550.0, True), 36: (0.0, False)}


def test_revenue_rollup_and_top_code_ties(spark):
    rev = spark.createDataFrame(
        [(2015, 14, 10.0), (2015, 21, 10.0), (2016, 14, 5.0), (2016, 38, 7.0)],
        "fiscal_year INT, violation_code INT, revenue DOUBLE",
    )
    roll = {(r.fiscal_year, r.violation_code, r.level): r.revenue for r in revenue_rollup(rev).collect()}
    assert roll[(2015, None, 1)] == 20.0 and roll[(2016, None, 1)] == 12.0 and roll[(None, None, 3)] == 32.0
    top = {r.fiscal_year: (r.top_code, r.top_revenue) for r in top_revenue_code(rev).collect()}
    assert top == {2015: (14, 10.0), 2016: (38, 7.0)}


def test_broadcast_hint_only_with_bound(spark):
    from ticketlens.operators.joins import BROADCAST_MAX_ROWS, small_side

    df = spark.range(3)
    plan_hint = small_side(df, 3)
    plan_none = small_side(df, None)
    plan_big = small_side(df, BROADCAST_MAX_ROWS + 1)
    assert plan_none is df and plan_big is df and plan_hint is not df


def test_exclude_placeholder_values(spark):
    df = spark.createDataFrame([(1, 0), (1, 0), (1, 5), (1, None)], "fy INT, p INT")
    got = {r.p: r.frequency for r in frequency(df, "fy", "p", count_nulls=True, exclude=[0]).collect()}
    assert got == {5: 1, None: 1}
    top = [r.issuer_precinct for r in q.busiest_precincts(df.withColumnRenamed("p", "issuer_precinct"), 1, exclude=[0]).collect()]
    assert top == [5]


def test_unique_states_exact_and_approx(spark):
    df = spark.createDataFrame([(2015, "NY"), (2015, "NJ"), (2015, "NY"), (2016, None)], "fiscal_year INT, registration_state STRING")
    exact = {r.fiscal_year: r.n_states for r in q.unique_states(df).collect()}
    approx = {r.fiscal_year: r.n_states for r in q.unique_states(df, approx_rsd=0.01).collect()}
    assert exact == {2015: 2, 2016: 0} and approx == exact


def test_scale_conf_sizes_partitions():
    from ticketlens.session import MB, scale_conf

    small = scale_conf(64 * MB)
    assert small["spark.sql.shuffle.partitions"] == "8"
    huge = scale_conf(100 * 1024**4)
    assert huge["spark.sql.shuffle.partitions"] == "409600"  # 256 MB each at any size
    assert huge["spark.sql.files.maxPartitionBytes"] == small["spark.sql.files.maxPartitionBytes"]
    mid = scale_conf(1024**4)
    assert mid["spark.sql.shuffle.partitions"] == str(4096)


def test_profiles_take_names_literally(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "`a.b` INT, `Unregistered Vehicle?` STRING")
    prof = {r.column_name: r.n_null for r in null_profile(df).collect()}
    assert prof == {"a.b": 0, "Unregistered Vehicle?": 1}
    rep = duplicate_report(df).collect()[0]
    assert (rep.n_rows, rep.distinct_rows) == (2, 2)
    assert drop_empty_columns(df).columns == ["a.b", "Unregistered Vehicle?"]
    ex = {r.column_name: r.example for r in schema_profile(df, examples=True).collect()}
    assert ex == {"a.b": "1", "Unregistered Vehicle?": "x"}


def test_rank_list_pads_numbers_only_and_never_truncates(spark):
    nums = spark.createDataFrame([(1, 7, 1), (1, 100, 2), (1, 21, 3)], "g INT, code INT, rnk INT")
    assert rank_list(nums, "g", "code", pad=2).collect()[0].rank_list == "07,100,21"
    text = spark.createDataFrame([(1, "view", 1), (1, "a", 2)], "g INT, code STRING, rnk INT")
    assert rank_list(text, "g", "code", pad=2).collect()[0].rank_list == "view,a"


def test_apply_scale_sets_session_values(spark):
    from ticketlens.session import apply_scale

    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    try:
        apply_scale(spark, 1024**4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == "4096"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.initialPartitionNum")
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_yoy_needs_the_year_before(spark):
    df = spark.createDataFrame([(2013, 10), (2015, 20), (2016, 30)], "fiscal_year INT, n INT")
    got = {r["fiscal_year"]: (r["prev_n"], r["pct_change_n"]) for r in yoy(df, "n").collect()}
    assert got == {2013: (None, None), 2015: (None, None), 2016: (20, 50.0)}


def test_common_items_leaves_out_rows_without_a_facet(spark):
    rows = [(1, "a", 21), (1, "b", 21), (1, None, 7), (1, "a", 5)]
    df = spark.createDataFrame(rows, "g INT, facet STRING, code INT")
    assert [r["code"] for r in common_items(df, "g", "code", "facet").collect()] == [21]


def test_pivot_counts_years_outside_the_list(spark):
    rows = [(2, 2018), (2, 2018), (2, None), (1, 2015)]
    df = spark.createDataFrame(rows, "code INT, fiscal_year INT")
    got = {r["code"]: (r["fy_2015"], r["fy_2016"], r["fy_other"]) for r in pivot_years(df, "code", years=[2015, 2016]).collect()}
    assert got == {1: (1, 0, 0), 2: (0, 0, 3)}


def test_frequency_of_two_items_scores_a_null_item_zero(spark):
    df = spark.createDataFrame([(1, "x"), (None, "x"), (None, "x")], "a INT, b STRING")
    assert {r["a"]: r["frequency"] for r in frequency(df, None, ["a", "b"]).collect()} == {1: 1, None: 0}
    assert {r["a"]: r["frequency"] for r in frequency(df, None, ["a", "b"], count_nulls=True).collect()} == {1: 1, None: 2}


def test_sample_does_not_depend_on_partitions(spark):
    from ticketlens.operators.profile import sample_rows

    df = spark.range(5000)
    one, many = ({r["id"] for r in sample_rows(d, 0.1, key="id").collect()} for d in (df.coalesce(1), df.repartition(13)))
    assert one == many and 400 < len(one) < 600
    assert {r["id"] for r in sample_rows(df, 0.1, seed=1, key="id").collect()} != one
    assert sample_rows(df, 0.0).count() == 0 and sample_rows(df, 1.0).count() == 5000


def test_lookup_table_with_a_repeated_key_fails(spark):
    from pyspark.errors import PySparkException

    from ticketlens.operators import fines_frame, fines_join, lookup, with_unique_key

    facts = spark.createDataFrame([(21, 10), (38, 5)], "violation_code int, frequency long")
    twice = spark.createDataFrame([(21, 65.0, 45.0), (21, 75.0, 55.0), (None, 1.0, 1.0), (None, 2.0, 2.0)], "code int, fine_high double, fine_low double")
    with pytest.raises(PySparkException, match="several rows for code = 21"):
        fines_join(facts, twice).collect()
    with pytest.raises(PySparkException, match="code/fine_low"):
        with_unique_key(twice.union(twice), ["code", "fine_low"]).collect()
    with pytest.raises(ValueError, match=r"\[21\]"):
        fines_frame(spark, [(21, 1, 1), (38, 2, 2), (21, 3, 3)])
    # NULL keys join nothing and may repeat; unique keys join as before
    once = twice.where("code IS NULL OR fine_high = 65")
    joined = lookup(facts, once, facts["violation_code"] == once["code"], "left", unique_key="code")
    assert rows(joined, "violation_code", "fine_high") == [(21, 65.0), (38, None)]
