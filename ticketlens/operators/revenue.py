"""Fine revenue: a small fines table joined to code frequencies.

A fine that is not known is NULL (not 0), with ``fine_known`` false; the
revenue of such a code counts as 0 so totals stay sums of known money.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlens.operators.joins import lookup

FINES_SCHEMA = "code INT, fine_high DECIMAL(10,2), fine_low DECIMAL(10,2)"

# Average fines the case study used for its top codes
# (code -> average of the two published fines; None = not published).
CASE_STUDY_AVERAGE_FINES: dict[int, int | None] = {21: 55, 36: None, 38: 50, 14: 115}


def _dec(v) -> Decimal | None:
    return None if v is None else Decimal(str(v))


def _money_sql(v) -> str:
    d = _dec(v)
    return "NULL" if d is None else f"{d}BD"


def fines_frame(spark: SparkSession, rows: Iterable[tuple[int, object, object]]) -> DataFrame:
    """Inline fines table ``(code, fine_high, fine_low)``.

    Built as a SQL ``VALUES`` list, so Spark holds it as a local relation
    whose exact size the planner knows (a parallelized Python list would be
    an RDD of unknown size).  A code listed twice is refused: it would count
    that code's revenue twice."""
    data = [(int(c), _money_sql(h), _money_sql(lo)) for c, h, lo in rows]
    twice = sorted(c for c, n in Counter(c for c, _, _ in data).items() if n > 1)
    if twice:
        raise ValueError(f"fines table lists codes more than once: {twice}")
    if not data:
        return spark.createDataFrame([], FINES_SCHEMA)
    values = ", ".join(f"({c}, {h}, {lo})" for c, h, lo in data)
    return spark.sql(
        "SELECT CAST(code AS INT) AS code, CAST(fine_high AS DECIMAL(10,2)) AS fine_high, "
        f"CAST(fine_low AS DECIMAL(10,2)) AS fine_low FROM VALUES {values} AS fines(code, fine_high, fine_low)"
    )


def fines_from_averages(spark: SparkSession, averages: Mapping[int, object]) -> DataFrame:
    """Fines table when only the average is known (high = low = average)."""
    return fines_frame(spark, [(c, a, a) for c, a in averages.items()])


def average_fine(fines: DataFrame) -> DataFrame:
    """``(code, average_fine, fine_known)``; average = (high + low) / 2."""
    avg = ((F.col("fine_high") + F.col("fine_low")) / 2).cast("decimal(12,2)")
    return fines.select(
        "code",
        avg.alias("average_fine"),
        avg.isNotNull().alias("fine_known"),
    )


def fines_join(
    freq: DataFrame,
    fines: DataFrame,
    code: str = "violation_code",
    fines_rows: int | None = None,
) -> DataFrame:
    """Inner many-to-one join of code counts to average fines; codes
    without a fines row drop out.  ``fines_rows`` (the length of a table built
    by ``fines_frame``) allows the broadcast hint; a fines table from elsewhere
    is checked for repeated codes while it is joined."""
    avg = average_fine(fines)
    key = "code" if fines_rows is None else None
    return lookup(freq, avg, freq[code] == avg["code"], "inner", row_bound=fines_rows, unique_key=key).drop("code")


def revenue(
    freq: DataFrame,
    fines: DataFrame,
    code: str = "violation_code",
    count: str = "frequency",
    fines_rows: int | None = None,
    name: str = "revenue",
) -> DataFrame:
    """Frequency x average fine, as DECIMAL(38,2) (unknown fine -> 0)."""
    joined = fines_join(freq, fines, code, fines_rows)
    money = (F.col(count) * F.coalesce(F.col("average_fine"), F.lit(Decimal("0.00")))).cast("decimal(38,2)")
    return joined.withColumn(name, money)


def revenue_rollup(
    rev: DataFrame,
    year: str = "fiscal_year",
    code: str = "violation_code",
    value: str = "revenue",
) -> DataFrame:
    """Revenue per (year, code), per year and overall in one aggregate
    (``ROLLUP``); ``level`` is 0 for a code row, 1 for a year subtotal and
    3 for the grand total."""
    return rev.rollup(year, code).agg(
        F.sum(value).alias("revenue"),
        F.grouping_id().cast("int").alias("level"),
    )


def top_revenue_code(
    rev: DataFrame,
    year: str = "fiscal_year",
    code: str = "violation_code",
    value: str = "revenue",
) -> DataFrame:
    """Code with the largest revenue per year (ties: smallest code)."""
    key = F.struct(F.col(value), (-F.col(code)).alias("neg_code"))
    return rev.groupBy(year).agg(
        F.max_by(code, key).alias("top_code"),
        F.max(value).alias("top_revenue"),
    )


def yearly_revenue(rev: DataFrame, year: str = "fiscal_year", value: str = "revenue") -> DataFrame:
    return rev.groupBy(year).agg(F.sum(value).alias("total_revenue"))
