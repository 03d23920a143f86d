"""Run the whole analysis as one Spark job (``spark-submit`` entry point).

    spark-submit --py-files ticketlens.zip ticketlens/plans/job.py \\
        --year 2015=s3a://bucket/fy2015.csv --year 2016=... --year 2017=... \\
        --header 2017=detect --out s3a://bucket/tickets \\
        --fine 21=55 --fine 36= --fine 38=50 --fine 14=115

Writes ``<out>/clean`` (Parquet partitioned by fiscal year), ``<out>/profile/<name>``
(duplicates, NULL counts, schema difference per raw year) and
``<out>/results/<question>`` for every question and ``<out>/charts/<chart>``
for the data behind each chart.  ``--clean <path>`` skips the
cleaning and runs the questions on an existing cleaned table.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from ticketlens.functions.clock import ADDITIVE, CLOCK
from ticketlens.operators.revenue import fines_from_averages
from ticketlens.plans.report import case_study, chart_tables, clean_files, profile_files
from ticketlens.session import apply_scale, build_session, input_bytes
from ticketlens.sources.csv import read_years
from ticketlens.sources.sink import read_clean


def _pairs(items: Sequence[str], what: str) -> dict[int, str]:
    out: dict[int, str] = {}
    for item in items or []:
        key, sep, value = item.partition("=")
        if not sep:
            raise SystemExit(f"--{what} expects KEY=VALUE, got {item!r}")
        out[int(key)] = value
    return out


def parse_args(argv: Sequence[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ticketlens.plans.job", description=__doc__.splitlines()[0])
    p.add_argument("--year", action="append", default=[], help="FISCAL_YEAR=PATH of a raw CSV file")
    p.add_argument("--header", action="append", default=[], help="FISCAL_YEAR=detect for a file with fewer columns")
    p.add_argument("--clean", help="existing cleaned table (skips reading and cleaning the CSVs)")
    p.add_argument("--out", required=True, help="output folder")
    p.add_argument("--fine", action="append", default=[], help="CODE=AVERAGE_FINE (empty = not published)")
    p.add_argument("--precincts", default="0,19,14", help="given precinct list")
    p.add_argument("--codes", default="14,21,38", help="given violation code list")
    p.add_argument("--clock", choices=[CLOCK, ADDITIVE], default=CLOCK)
    p.add_argument("--exclude-precinct", action="append", type=int, default=[])
    p.add_argument(
        "--skip-profile",
        action="store_true",
        help="skip the raw-file profile (its duplicate report shuffles every raw column once more)",
    )
    p.add_argument("--shared-scan", action="store_true", help="answer all questions from one scan per table")
    p.add_argument("--input-gb", type=float, help="raw input size, if it should not be measured; sizes shuffle partitions")
    return p.parse_args(list(argv))


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    """Run the analysis; return ``{name: output path}``."""
    written: dict[str, str] = {}
    if args.clean:
        t = read_clean(spark, args.clean)
    else:
        paths = _pairs(args.year, "year")
        if not paths:
            raise SystemExit("give --year FY=PATH at least once, or --clean PATH")
        apply_scale(spark, int(args.input_gb * 1024**3) if args.input_gb else input_bytes(spark, paths.values()))
        headers = {k: (v or "detect") for k, v in _pairs(args.header, "header").items()}
        if not args.skip_profile:
            for name, df in profile_files(read_years(spark, paths, headers, as_text=True)).items():
                path = os.path.join(args.out, "profile", name)
                df.write.mode("overwrite").parquet(path)
                written[f"profile/{name}"] = path
        t = clean_files(spark, paths, os.path.join(args.out, "clean"), headers)
        written["clean"] = os.path.join(args.out, "clean")
    averages = {k: (float(v) if v else None) for k, v in _pairs(args.fine, "fine").items()}
    fines = fines_from_averages(spark, averages) if averages else None
    plans = case_study(
        t,
        fines=fines,
        fines_rows=len(averages) if averages else None,
        given_precincts=[int(x) for x in args.precincts.split(",") if x],
        given_codes=[int(x) for x in args.codes.split(",") if x],
        mode=args.clock,
        exclude_precincts=args.exclude_precinct or None,
        shared_scan=args.shared_scan,
    )
    for name, df in plans.items():
        path = os.path.join(args.out, "results", name)
        df.write.mode("overwrite").parquet(path)
        written[f"results/{name}"] = path
    answers = {name: spark.read.parquet(written[f"results/{name}"]) for name in plans}
    for name, df in chart_tables(answers).items():
        path = os.path.join(args.out, "charts", name)
        df.write.mode("overwrite").parquet(path)
        written[f"charts/{name}"] = path
    return written


def main(argv: Sequence[str] | None = None) -> int:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = build_session(app_name="ticketlens-job")
    for name, path in run(spark, args).items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
