"""Run a registered query in Spark and its oracle SQL in DuckDB; compare.

Comparison: same column names, same row count, same multiset of rows
(columns sorted by name, rows sorted, floats compared exactly).  Also
reports the dtypes of both sides.

Usage: python tests/oracle_compare.py [sf_dir] [name ...] [--md out.md]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (1, v)
    if isinstance(v, decimal.Decimal):
        return (1, float(v))
    if isinstance(v, bool):
        return (2, int(v))
    if isinstance(v, int):
        return (1, float(v)) if abs(v) < 2**53 else (1, v)
    if isinstance(v, dt.datetime):
        return (3, v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return (3, v.isoformat())
    return (4, str(v))


def rows_of(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cols = [columns[i] for i in order]
    out = sorted(tuple(_norm(r[i]) for i in order) for r in rows)
    return cols, out


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from ticketlens.plans.catalog import ORACLE, QUERIES

    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols, s_rows = rows_of(sdf.columns, srows)
    result = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 3)}
    if name not in ORACLE:
        result["status"] = "rows-only"
        return result
    con = con or duck(sf_dir)
    rel = con.execute(ORACLE[name])
    d_cols_raw = [c[0] for c in rel.description]
    drows = rel.fetchall()
    d_cols, d_rows = rows_of(d_cols_raw, drows)
    result["oracle_rows"] = len(drows)
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = dict(zip(d_cols_raw, [str(c[1]) for c in rel.description]))
    result["types"] = {c: (s_types.get(c), d_types.get(c)) for c in sorted(set(s_types) | set(d_types))}
    if s_cols != d_cols:
        result["status"] = f"columns differ: spark={s_cols} oracle={d_cols}"
    elif len(s_rows) != len(d_rows):
        result["status"] = "row count differs"
    elif s_rows != d_rows:
        bad = next(i for i, (a, b) in enumerate(zip(s_rows, d_rows)) if a != b)
        result["status"] = f"values differ at sorted row {bad}: spark={s_rows[bad]} oracle={d_rows[bad]}"
    else:
        result["status"] = "match"
    return result


def main(argv: list[str]) -> int:
    from ticketlens.plans.catalog import QUERIES
    from ticketlens.session import build_session

    md = None
    if "--md" in argv:
        i = argv.index("--md")
        md = argv[i + 1]
        argv = argv[:i] + argv[i + 2 :]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(QUERIES)
    lines = [
        "# Oracle comparison",
        "",
        f"Every registered query run in Spark and its oracle SQL in DuckDB on `{sf_dir}`",
        "(`tests/oracle_compare.py`): same column names, same row count, same multiset",
        "of rows with floats compared exactly.  `rows-only` = no oracle SQL.",
        "",
        "| query | Spark rows | DuckDB rows | result | Spark s |",
        "|---|---:|---:|---|---:|",
    ]
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and go on
            r = {"name": n, "status": f"error: {type(e).__name__}: {str(e)[:300]}"}
        ok = r["status"] in ("match", "rows-only")
        bad += not ok
        print(f"{'OK ' if ok else 'BAD'} {n:28s} {r.get('spark_rows', '-')!s:>7} {r.get('oracle_rows', '-')!s:>7} "
              f"{r.get('spark_sec', '-')!s:>6}s  {r['status'] if not ok else ''}")
        if not ok and "types" in r:
            print("     types:", r["types"])
        lines.append(
            f"| `{n}` | {r.get('spark_rows', '-')} | {r.get('oracle_rows', '-')} | {r['status']} | {r.get('spark_sec', '-')} |"
        )
    print(f"{len(names) - bad}/{len(names)} ok")
    if md:
        lines += ["", f"{len(names) - bad} of {len(names)} ok.", ""]
        with open(md, "w") as f:
            f.write("\n".join(lines))
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
