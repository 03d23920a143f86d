"""Raw yearly ticket CSV files.

The schema is explicit: inferring it costs a full extra read of every file
and lets the yearly files drift apart in type (an integer column in one year,
text in another), which then breaks the union.  Names are turned into
snake_case on load so that later SQL needs no back-quotes.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header setting: every path holds files of one layout.
UNIFORM = "uniform"

# Header of the yearly ticket files, in file order, with the
# type chosen for each column.  Columns 41-51 are empty or missing in some
# years.  "Issue Date" stays text here and is parsed during cleaning.
RAW_COLUMNS: tuple[tuple[str, T.DataType], ...] = (
    ("Summons Number", T.LongType()),
    ("Plate ID", T.StringType()),
    ("Registration State", T.StringType()),
    ("Plate Type", T.StringType()),
    ("Issue Date", T.StringType()),
    ("Violation Code", T.IntegerType()),
    ("Vehicle Body Type", T.StringType()),
    ("Vehicle Make", T.StringType()),
    ("Issuing Agency", T.StringType()),
    ("Street Code1", T.IntegerType()),
    ("Street Code2", T.IntegerType()),
    ("Street Code3", T.IntegerType()),
    ("Vehicle Expiration Date", T.StringType()),
    ("Violation Location", T.StringType()),
    ("Violation Precinct", T.IntegerType()),
    ("Issuer Precinct", T.IntegerType()),
    ("Issuer Code", T.IntegerType()),
    ("Issuer Command", T.StringType()),
    ("Issuer Squad", T.StringType()),
    ("Violation Time", T.StringType()),
    ("Time First Observed", T.StringType()),
    ("Violation County", T.StringType()),
    ("Violation In Front Of Or Opposite", T.StringType()),
    ("House Number", T.StringType()),
    ("Street Name", T.StringType()),
    ("Intersecting Street", T.StringType()),
    ("Date First Observed", T.StringType()),
    ("Law Section", T.StringType()),
    ("Sub Division", T.StringType()),
    ("Violation Legal Code", T.StringType()),
    ("Days Parking In Effect", T.StringType()),
    ("From Hours In Effect", T.StringType()),
    ("To Hours In Effect", T.StringType()),
    ("Vehicle Color", T.StringType()),
    ("Unregistered Vehicle?", T.StringType()),
    ("Vehicle Year", T.IntegerType()),
    ("Meter Number", T.StringType()),
    ("Feet From Curb", T.IntegerType()),
    ("Violation Post Code", T.StringType()),
    ("Violation Description", T.StringType()),
    ("No Standing or Stopping Violation", T.StringType()),
    ("Hydrant Violation", T.StringType()),
    ("Double Parking Violation", T.StringType()),
    ("Latitude", T.StringType()),
    ("Longitude", T.StringType()),
    ("Community Board", T.StringType()),
    ("Community Council", T.StringType()),
    ("Census Tract", T.StringType()),
    ("BIN", T.StringType()),
    ("BBL", T.StringType()),
    ("NTA", T.StringType()),
)

# Number of leading columns that carry data; the rest are empty.
KEPT_COLUMNS = 40


def snake_case(name: str) -> str:
    """``Unregistered Vehicle?`` -> ``unregistered_vehicle``."""
    return re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")


def raw_schema(header: list[str] | None = None) -> T.StructType:
    """Schema for a file with ``header`` (default: all 51 columns).

    Unknown header names are read as text so that a new column never makes
    the read fail.
    """
    known = dict(RAW_COLUMNS)
    names = header if header is not None else [n for n, _ in RAW_COLUMNS]
    return T.StructType([T.StructField(n, known.get(n, T.StringType()), True) for n in names])


def kept_names(n: int = KEPT_COLUMNS) -> list[str]:
    """snake_case names of the first ``n`` columns of the full header."""
    return [snake_case(name) for name, _ in RAW_COLUMNS[:n]]


def column_type(name: str) -> T.DataType:
    """Type of a (snake_case) raw column; text for unknown names."""
    return {snake_case(n): t for n, t in RAW_COLUMNS}.get(name, T.StringType())


def pad_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Add the listed columns a file lacks as typed NULLs, so every year
    keeps the same columns with the same types."""
    missing = [n for n in names if n not in df.columns]
    if not missing:
        return df
    return df.select("*", *[F.lit(None).cast(column_type(n)).alias(n) for n in missing])


def read_year_text(
    spark: SparkSession,
    path: str | Sequence[str],
    header: list[str] | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The CSV files under ``path`` with every field as text, snake_case names.

    Spark maps fields by position, so files are grouped by their own header
    line and each group is read in its own column order; the groups are put
    together by name (a column that a file lacks is NULL there).  Finding the
    headers reads the text once more.  ``header="uniform"`` spares that where
    every path (file or folder) holds files of one layout: it reads one line
    per path, and a file with another header fails the scan instead of being
    misread.  A list gives the columns of all files.  Empty fields read as NULL.
    """
    paths = [path] if isinstance(path, str) else list(path)
    more = {"mode": "PERMISSIVE", **(options or {})}
    if header == UNIFORM:
        frames = [df for df in (_uniform(spark, p, more) for p in paths) if df is not None]
    else:
        frames = []
        for names, files in [(header, paths)] if header is not None else file_layouts(spark, paths):
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            df = spark.read.schema(schema).option("header", "true").options(**more).csv(files)
            frames.append(df.select([F.col(f"`{c}`").alias(snake_case(c)) for c in df.columns]))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in kept_names(len(RAW_COLUMNS))]))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(path, line): the first line of every file under ``paths``, in one job.

    A plain text scan: blocks that do not start a file are filtered out and
    each task keeps one line per file.  Spark has no per-file limit, so the
    text is read through once, unparsed; where all files of a path share one
    layout, ``header="uniform"`` (see ``read_year_text``) reads one line only.
    """
    text = spark.read.option("recursiveFileLookup", "true").text(list(paths))
    lines = text.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("line"), F.monotonically_increasing_id().alias("at")
    )
    return lines.groupBy("path").agg(F.min_by("line", "at").alias("line"))


def file_layouts(spark: SparkSession, paths: Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """(column names, files) of every distinct header among the files.

    As many jobs as for one file: ``first_lines``, grouped by the line in
    Spark; the driver gets one row per distinct line, with the paths it hands
    to the reader.  Names are matched to the known header after trimming
    blanks, which the published files carry in a few names; lines that differ
    in blanks, quotes or case only are one header.  Empty files have none.
    """
    grouped = first_lines(spark, paths).groupBy("line").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(grouped.collect(), key=lambda r: r["paths"][0]):
        names = [_known_name(c) for c in header_names(row["line"])]
        if names:
            files = [unquote(p) for p in row["paths"]]  # the metadata column is URL-encoded
            groups.setdefault(tuple(names), []).extend(files)
    return [(list(names), sorted(files)) for names, files in groups.items()]


def header_names(line: str) -> list[str]:
    """Fields of a header line as they stand."""
    return next(csv.reader([line.lstrip("\ufeff")]), [])


def _known_name(field: str) -> str:
    name = field.strip()
    return {n.lower(): n for n, _ in RAW_COLUMNS}.get(name.lower(), name)


def _uniform(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame | None:
    """The files under ``path`` read by the first one's header, which Spark
    compares with the header of every other file while it scans it."""
    text = spark.read.option("recursiveFileLookup", "true").text(path).where("value <> ''")
    first = text.limit(1).collect()
    if not first:
        return None
    fields = header_names(first[0][0])
    schema = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    reader = spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").options(**options)
    df = reader.option("recursiveFileLookup", "true").csv(path)
    return df.select([F.col("`" + c.replace("`", "``") + "`").alias(snake_case(_known_name(c))) for c in df.columns])


def cast_columns(df: DataFrame) -> DataFrame:
    """Known columns in their types; text that does not parse becomes NULL
    (``unparsed_counts`` tells how many)."""
    return df.select([F.col(c).try_cast(column_type(c)).alias(c) for c in df.columns])


def unparsed_counts(text: DataFrame) -> DataFrame:
    """(column_name, n_unparsed): values of a text frame that their type cannot hold."""
    typed = [c for c in text.columns if column_type(c) != T.StringType()]
    if not typed:
        return text.sparkSession.createDataFrame([], "column_name string, n_unparsed long")
    bad = [F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(column_type(c)).isNull()).alias(c) for c in typed]
    return text.agg(*bad).unpivot([], typed, "column_name", "n_unparsed")


def read_year(
    spark: SparkSession,
    path: str | Sequence[str],
    header: list[str] | str | None = "detect",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One yearly CSV or folder of part files (any Hadoop path), typed.

    ``"detect"`` (default) follows every file's own header line; ``"uniform"``
    follows the first one and has Spark check the others; a list gives the
    columns directly; ``None`` assumes the full 51-column layout.  To
    remove copies of whole records, do so on ``read_year_text`` and type the
    columns afterwards: two different texts may type to the same NULL.
    """
    if header is None:
        header = [n for n, _ in RAW_COLUMNS]
    return cast_columns(read_year_text(spark, path, None if header == "detect" else header, options))


def detect_header(spark: SparkSession, path: str) -> list[str]:
    """Column names of the (first) file under ``path``; all 51 if it has none."""
    layouts = file_layouts(spark, [path])
    return layouts[0][0] if layouts else [n for n, _ in RAW_COLUMNS]


def read_years(
    spark: SparkSession,
    paths: Mapping[int, str],
    headers: Mapping[int, list[str] | str | None] | None = None,
    as_text: bool = False,
) -> dict[int, DataFrame]:
    """``{fiscal_year: path}`` to ``{fiscal_year: DataFrame}`` (headers
    detected unless given per year); ``as_text`` leaves the fields untyped."""
    headers = headers or {}
    out = {}
    for year, path in paths.items():
        df = read_year_text(spark, path, _given(headers.get(year, "detect")))
        out[year] = df if as_text else cast_columns(df)
    return out


def _given(header: list[str] | str | None) -> list[str] | str | None:
    if header == "detect":
        return None
    if header == UNIFORM:
        return header
    return [n for n, _ in RAW_COLUMNS] if header is None else list(header)
