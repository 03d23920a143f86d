"""Physical-plan shape: the properties the scale notes rely on."""

import pytest

from conftest import SMALL_SF, plan_text
from ticketlens.plans import questions as q
from ticketlens.plans.catalog import QUERIES
from ticketlens.sources.sink import materialize
from ticketlens.sources.tables import tickets


def plan_of(df) -> str:
    df.collect()  # afterwards explain() shows the final adaptive plan
    return plan_text(df)


@pytest.fixture(scope="module")
def clean(spark):
    return materialize(tickets(spark, SMALL_SF), "tickets_plans", partition_by="fiscal_year")


def test_top_n_uses_partial_window_group_limit(clean):
    plan = plan_of(q.top_items_per_year(clean, "violation_code", 5))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    assert "partial_count" in plan


def test_year_filter_prunes_partitions_and_pushes_date_range(clean):
    from ticketlens.operators import fiscal_filter

    df = fiscal_filter(clean.where("fiscal_year = 1997"), "issue_date", 1997).groupBy("violation_code").count()
    text = plan_text(df)
    assert "PartitionFilters: [isnotnull(fiscal_year" in text and "= 1997" in text
    assert "GreaterThanOrEqual(issue_date" in text and "LessThan(issue_date" in text


def test_scan_reads_only_needed_columns(clean):
    text = plan_text(q.unique_states(clean))
    assert "ReadSchema: struct<registration_state:string>" in text


def broadcast_subtrees(text: str) -> list[str]:
    """Text of every subtree under a BroadcastExchange node."""
    lines = text.splitlines()
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line or "ReusedExchange" in line:
            continue  # a reused exchange is checked where it first appears
        depth = line.index("BroadcastExchange")
        body = []
        for nxt in lines[i + 1 :]:
            stripped = nxt.lstrip(" :|+-")
            if not stripped or len(nxt) - len(stripped) <= depth:
                break
            body.append(nxt)
        out.append("\n".join(body))
    return out


def _measured_or_bounded(sub: str) -> bool:
    # measured: AQE saw the finished shuffle stage's real size;
    # bounded: a literal table or a limit(k) result
    return any(tag in sub for tag in ("ShuffleQueryStage", "LocalTableScan", "TakeOrderedAndProject"))


def test_broadcasts_are_measured_or_bounded(spark):
    for name in ("row_count", "revenue", "precinct_code_freq_derived", "bins_for_top_codes"):
        text = plan_of(QUERIES[name](spark, SMALL_SF))
        for sub in broadcast_subtrees(text):
            assert _measured_or_bounded(sub), (name, sub)


def test_static_estimate_broadcast_would_be_caught(spark):
    """Negative control: with the planner's file-size guess switched back on,
    a raw scan is broadcast and the check above notices it."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        text = plan_of(QUERIES["unique_states"](spark, SMALL_SF))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert not all(_measured_or_bounded(sub) for sub in broadcast_subtrees(text))


def test_derived_keys_and_counts_share_one_scan(clean, spark):
    """The key list and the counts come from one aggregate: the second use is a reused exchange."""
    for df in (
        q.precinct_code_freq_derived(clean, 3),
        q.precinct_code_lift(clean, 3),
        QUERIES["top5_bin_per_code"](spark, SMALL_SF),
    ):
        final = plan_of(df).split("== Initial Plan ==")[0]
        assert "TakeOrderedAndProject" in final and "limit=3" in final
        assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_ticket_queries_join_only_what_they_read(spark):
    for name in ("tickets_per_year", "top5_code", "top5_viol_precinct", "revenue"):
        text = plan_of(QUERIES[name](spark, SMALL_SF)).split("== Initial Plan ==")[0]
        assert text.count("Scan parquet") == 1 and "SortMergeJoin" not in text
    assert "orders" in plan_of(QUERIES["missing_address_3"](spark, SMALL_SF))


def test_fines_join_broadcasts_the_literal_table(spark):
    text = plan_of(QUERIES["revenue"](spark, SMALL_SF))
    assert "BroadcastHashJoin" in text


def test_fiscal_filter_runs_before_the_dedupe_shuffle(spark, tmp_dir):
    """Dropping out-of-year rows before the whole-row dedupe is the same
    answer (copies share their date) and shrinks the biggest shuffle."""
    from test_sources import make_files
    from ticketlens.operators import clean_year
    from ticketlens.sources.csv import kept_names, read_year

    raw = read_year(spark, make_files(tmp_dir)[2015])
    plan = plan_text(clean_year(raw, 2015, keep=kept_names()), "extended")
    plan = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    lines = plan.splitlines()
    agg = next(i for i, line in enumerate(lines) if "Aggregate" in line)
    filt = next(i for i, line in enumerate(lines) if "Filter" in line and "try_to_date" in line)
    assert filt > agg  # the filter sits below (after, in tree order) the aggregate


@pytest.mark.parametrize(("name", "scans"), [("view_sql", 1), ("month_histogram_sql", 1), ("fines_table", 1), ("average_fine", 1)])
def test_line_questions_scan_lineitem_alone(spark, name, scans):
    text = plan_of(QUERIES[name](spark, SMALL_SF)).split("== Initial Plan ==")[0]
    assert text.count("Scan parquet") == scans and "SortMergeJoin" not in text


def test_dropping_empty_columns_runs_the_joins_once(spark):
    text = plan_of(QUERIES["drop_empty_columns"](spark, SMALL_SF))
    assert text.count("Scan parquet") == 1 and "Join" not in text
