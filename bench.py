"""Benchmark: the case study's questions on the driver's tables.

Step 1 ("build_tables") projects the ticket-shaped views from the star
schema and writes them once as Parquet partitioned by fiscal year (the
cleaned-table sink).  Step 2 ("shared.*") answers every question from one
grouping-sets scan per table (``case_study(shared_scan=True)``); step 3
(plain names) asks every question on its own, one scan each.  Each question
runs to completion with the ``noop`` sink (all rows produced, nothing
collected), three times; the median counts (BENCH_RUNS).

Prints one JSON line:
{"metric": "case_study_total", "value": <build + shared pass>, "unit": "sec",
 "queries": {...}, "direct_total": <build + question-by-question pass>, "sf": ...}

Before timing, the same plans run once, untimed, on the smallest data set
(BENCH_WARMUP_DIR, default /root/testdata/sf0.001): code generation and JIT
happen once per JVM and are not a cost that grows with the data.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from pyspark.sql import functions as F  # noqa: E402

from ticketlens.plans.catalog import GIVEN_EVENT_CODES, PIVOT_YEARS, mapping_fines  # noqa: E402
from ticketlens.plans.report import case_study  # noqa: E402
from ticketlens.session import build_session  # noqa: E402
from ticketlens.sources.sink import materialize  # noqa: E402
from ticketlens.sources.tables import ticket_times, tickets  # noqa: E402


WARMUP_SF_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")


RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def _timed(df) -> float:
    """Median seconds of ``RUNS`` runs of the whole plan."""
    took = []
    for _ in range(RUNS):
        s = time.perf_counter()
        _run(df)
        took.append(time.perf_counter() - s)
    return round(statistics.median(took), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        f"local[{cpus}]",
        app_name="ticketlens-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(cpus, 2))),
        conf={"spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}
    fines, n_fines = mapping_fines(spark)
    common = dict(fines=fines, fines_rows=n_fines, given_codes=GIVEN_EVENT_CODES, years=PIVOT_YEARS)

    # warm-up (not counted): JVM start, code generation and JIT of the scan,
    # join, aggregate and writer paths happen once per JVM; they are paid
    # here, on the same plans over the smallest data set, so the timings
    # below are steady-state costs (the part that grows with the data)
    _run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    if os.path.isdir(WARMUP_SF_DIR) and os.path.abspath(WARMUP_SF_DIR) != os.path.abspath(sf_dir):
        wt = materialize(tickets(spark, WARMUP_SF_DIR), "warmup_tickets", partition_by="fiscal_year")
        wtt = materialize(ticket_times(spark, WARMUP_SF_DIR), "warmup_times", partition_by="fiscal_year")
        for shared in (True, False):
            for df in case_study(wt, times=wtt, shared_scan=shared, **common).values():
                _run(df)

    t0 = time.perf_counter()
    t = materialize(tickets(spark, sf_dir), "tickets", partition_by="fiscal_year")
    times = materialize(ticket_times(spark, sf_dir), "ticket_times", partition_by="fiscal_year")
    timings["build_tables"] = round(time.perf_counter() - t0, 3)

    common["times"] = times

    # 1. the whole report from one grouping-sets scan per table (run first,
    #    so it does not profit from a JVM warmed up by the direct pass)
    s = time.perf_counter()
    shared_plans = case_study(t, shared_scan=True, **common)
    timings["shared.build_cubes"] = round(time.perf_counter() - s, 3)
    for name, df in shared_plans.items():
        timings[f"shared.{name}"] = _timed(df)

    # 2. every question on its own (one scan each), as a user asking one
    for name, df in case_study(t, **common).items():
        timings[name] = _timed(df)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    direct_total = round(sum(v for k, v in timings.items() if not k.startswith("shared.")), 3)
    shared_total = round(
        timings["build_tables"] + sum(v for k, v in timings.items() if k.startswith("shared.")), 3
    )
    print(
        json.dumps(
            {
                "metric": "case_study_total",
                "value": shared_total,
                "unit": "sec",
                "queries": timings,
                "direct_total": direct_total,
                "sf": float(m.group(1)) if m else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
