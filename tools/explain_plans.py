"""Write docs/PLANS.md: final (adaptive) physical plans of representative
questions over the cleaned tickets table, for reading the scale claims.

Usage: python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ticketlens.operators import clean_year  # noqa: E402
from ticketlens.plans import questions as q  # noqa: E402
from ticketlens.plans.catalog import mapping_fines  # noqa: E402
from ticketlens.plans.shared import ticket_cube  # noqa: E402
from ticketlens.session import build_session  # noqa: E402
from ticketlens.sources.sink import materialize  # noqa: E402
from ticketlens.sources.tables import raw_tickets, tickets  # noqa: E402

NOTES = {
    "top5_code": "Partial aggregate in the scan stage, partial WindowGroupLimit before the second shuffle.",
    "unique_states": "count(distinct) as a two-level aggregate; the scan reads one column.",
    "precinct_code_freq_derived": "The 3-row top list (TakeOrderedAndProject) is broadcast into a LeftSemi join.",
    "precinct_code_lift": "Windows over one year-clustered exchange of the aggregated counts; no self-joins.",
    "revenue": "The literal fines table (a local relation) is broadcast; counts come from a partial aggregate.",
    "ticket_cube": "One scan, Expand into 10 grouping sets, partial aggregate before the only shuffle.",
    "clean_year": "Fiscal filter below the whole-row dedupe aggregate; the test-mapping joins are sort-merge "
    "unless AQE measured a side as small.",
}


def final_plan(df) -> str:
    import contextlib
    import io

    df.collect()  # every result here is small; collecting runs this DataFrame's own (adaptive) plan
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()  # after execution: the final adaptive plan
    text = buf.getvalue()
    text = re.sub(r"#\d+L?", "", text)
    text = re.sub(r"file:/\S+", "<path>", text)
    return text


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    t = materialize(tickets(spark, sf_dir), "tickets_plans", partition_by="fiscal_year")
    fines, n = mapping_fines(spark)
    plans = {
        "top5_code": q.top_items_per_year(t, "violation_code", 5),
        "unique_states": q.unique_states(t),
        "precinct_code_freq_derived": q.precinct_code_freq_derived(t, 3),
        "precinct_code_lift": q.precinct_code_lift(t, 3),
        "revenue": q.code_revenue(t, fines, 4, fines_rows=n),
        "ticket_cube": ticket_cube(t).df,
        "clean_year": clean_year(raw_tickets(spark, sf_dir), "file_year", keep=["summons_number", "issue_date"]),
    }
    out = [
        "# Physical plans",
        "",
        f"Final adaptive plans (after execution) on `{sf_dir}`, local[8], produced by",
        "`tools/explain_plans.py`.  The cleaned tickets table is Parquet partitioned by",
        "`fiscal_year`; expression ids and paths are removed.",
        "",
    ]
    for name, df in plans.items():
        out += [f"## {name}", "", NOTES[name], "", "```", final_plan(df).rstrip(), "```", ""]
    path = os.path.join(ROOT, "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
