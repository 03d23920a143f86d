"""What one task holds follows the size of a partition, not of the input."""

import datetime as dt
import os

import pytest

from conftest import rows
from ticketlens.session import MB, isolated, size_shuffles

import __spark_entry__ as entry_mod

START, SIZE = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def make_tables(spark, folder, n_orders=40):
    """Orders of three lines each (the first two alike but for their number) in four fiscal years."""
    day = dt.datetime(1995, 8, 1)
    tables = {
        "nation": ([(0, "PERU"), (1, "CHINA")], "n_nationkey int, n_name string"),
        "customer": ([(i, i % 2) for i in range(5)], "c_custkey bigint, c_nationkey int"),
        "orders": (
            [(i, i % 5, "OPF"[i % 3], day + dt.timedelta(days=30 * i)) for i in range(n_orders)],
            "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp",
        ),
        "part": ([(i, ("STANDARD", "SMALL TIN")[i % 2], f"Brand#{i}") for i in range(7)], "p_partkey bigint, p_type string, p_brand string"),
        "lineitem": (
            [
                (i, (i + n) % 7, i % 3, n, float(n + i % 9), 100.0 + i, "AAR"[n], "OF"[n % 2], day + dt.timedelta(days=30 * i + 1))
                for i in range(n_orders) for n in range(3)
            ],
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp",
        ),
    }
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).write.parquet(os.path.join(folder, f"{name}.parquet"))
    return folder


@pytest.mark.parametrize(("partitions", "advisory", "found"), [("12", "64MB", ("256", 8 * MB)), ("12", "2m", ("256", 2 * MB)), ("400", str(64 * MB), ("400", 8 * MB))])
def test_start_partitions_follow_the_input_and_reduce_partitions_stay_small(spark, partitions, advisory, found):
    own = isolated(spark)
    own.conf.set("spark.sql.shuffle.partitions", partitions)
    own.conf.set(SIZE, advisory)
    size_shuffles(own, 1024 * MB)
    assert (own.conf.get(START), int(own.conf.get(SIZE))) == found


def test_dedupe_starts_from_more_partitions_on_a_larger_input(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(entry_mod, "input_bytes", lambda session, paths: 2048 * MB, raising=False)
    before = spark.conf.get(START, None)
    out = entry_mod.queries()["dedupe"](spark, make_tables(spark, tmp_dir))
    assert int(out.sparkSession.conf.get(START)) >= 512 and int(out.sparkSession.conf.get(SIZE)) <= 8 * MB
    assert spark.conf.get(START, None) == before
    assert len(rows(out)) == len(set(rows(out))) == 80


def test_duplicate_report_starts_from_more_partitions_on_a_larger_input(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(entry_mod, "input_bytes", lambda session, paths: 2048 * MB, raising=False)
    out = entry_mod.queries()["duplicate_report"](spark, make_tables(spark, tmp_dir))
    assert int(out.sparkSession.conf.get(START)) >= 512 and int(out.sparkSession.conf.get(SIZE)) <= 8 * MB
    assert [tuple(r) for r in out.collect()] == [(120, 80, 40)]


def test_rebalanced_write_neither_sorts_nor_fetches_much_in_a_task(spark, tmp_dir, monkeypatch):
    """Before, a task fetched up to 256 MB, in the joins before the write too, and sorted all of it by the year."""
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F

    from ticketlens.sources.sink import read_clean, write_clean

    seen, write, writers = [], DataFrameWriter.parquet, "spark.sql.maxConcurrentOutputFileWriters"
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (seen.append((spark.conf.get(SIZE), spark.conf.get(writers))), write(self, path))[1])
    # more years than files kept open: the rest is sorted, no row is lost; a NULL year is a year
    df = spark.range(0, 4000, 1, 3).select("id", F.expr("nullif(1900 + id % 40, 1907)").cast("int").alias("fiscal_year"))
    before = spark.conf.get(SIZE), spark.conf.get(writers)
    path = write_clean(df, os.path.join(tmp_dir, "clean"))
    assert int(seen[0][0]) <= 64 * MB and int(seen[0][1]) > 1
    assert (spark.conf.get(SIZE), spark.conf.get(writers)) == before
    assert rows(read_clean(spark, path), "id", "fiscal_year") == rows(df)


def test_cleaned_years_are_written_without_another_shuffle(spark, tmp_dir, monkeypatch):
    """Every task of a deduped yearly frame holds one year; before, all cleaned rows were shuffled again."""
    from test_sources import make_files
    from ticketlens.plans.report import clean_files

    frame, hints = type(spark.range(1)), []
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda self, name, *args: (hints.append(name), hint(self, name, *args))[1])
    t = clean_files(spark, make_files(tmp_dir), os.path.join(tmp_dir, "clean"), {2017: "detect"})
    assert "rebalance" not in hints
    assert rows(t, "fiscal_year", "summons_number") == [(2015, 1), (2015, 2), (2017, 10), (2017, 11)]
    folder = os.path.join(tmp_dir, "clean", "fiscal_year=2015")
    assert sum(f.endswith(".parquet") for f in os.listdir(folder)) <= spark.sparkContext.defaultParallelism


def test_raw_files_of_csv_scan_are_compressed_and_bounded(spark, tmp_dir, monkeypatch):
    import gzip

    from ticketlens.plans import catalog

    paths, scratch = [], os.path.join(tmp_dir, "scratch")
    monkeypatch.setattr(catalog, "_scratch_path", lambda session, kind: paths.append(kind) or os.path.join(scratch, kind))
    monkeypatch.setattr(catalog, "RAW_FILE_ROWS", 7, raising=False)
    out = catalog.QUERIES["csv_scan"](spark, make_tables(spark, os.path.join(tmp_dir, "tables")))
    files = [os.path.join(d, f) for d, _, names in os.walk(scratch) for f in names if ".csv" in f and not f.startswith(".")]
    assert paths == ["csv"] and files and all(f.endswith(".csv.gz") for f in files)
    sizes = [len(gzip.open(f, "rt").read().splitlines()) - 1 for f in files]
    assert sum(sizes) == 120 and max(sizes) <= 7
    assert rows(out, "summons_number") == sorted(((10 * i + n,) for i in range(40) for n in range(3)), key=repr)
    # years of the short layout lack the last columns
    assert all((r["nta"] is None) == (r["_year"] % 2 == 1) for r in out.selectExpr("nta", "year(add_months(to_date(issue_date, 'MM/dd/yyyy'), 6)) AS _year").collect())
