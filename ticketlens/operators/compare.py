"""Comparisons across years and groups.

All of these run on aggregated frames (one row per year x item, or per
year), so their shuffles carry counts, not tickets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.operators.freq import _names


def pivot_years(
    df: DataFrame,
    item: str | Sequence[str],
    year: str = "fiscal_year",
    years: Sequence[int] | None = None,
    value: str | None = None,
    prefix: str = "fy_",
) -> DataFrame:
    """One row per item, one column per year (``fy_2015``, ...).

    Without ``value`` the cells are row counts (0 where a year has none);
    with ``value`` they are sums of that column (NULL where absent).  Without
    ``years`` the years are those of the data (Spark runs a job to find
    them); with ``years`` there is no such job, and rows of any other year
    (NULL included) go to one more column, ``<prefix>other``.
    """
    keys = _names(item)
    cell = F.count(F.lit(1)) if value is None else F.sum(value)
    if years is not None:
        inside = F.coalesce(F.col(year).isin(list(years)), F.lit(False))
        cells = [(str(y), F.col(year) == y) for y in years] + [("other", ~inside)]
        one = F.lit(1) if value is None else F.col(value)
        each = [(F.count if value is None else F.sum)(F.when(where, one)).alias(f"{prefix}{n}") for n, where in cells]
        return df.groupBy(*keys).agg(*each)
    wide = df.groupBy(*keys).pivot(year).agg(cell)
    out = wide
    for c in wide.columns:
        if c in keys:
            continue
        filled = F.coalesce(F.col(f"`{c}`"), F.lit(0)) if value is None else F.col(f"`{c}`")
        out = out.withColumn(f"{prefix}{c}", filled).drop(c)
    return out


def yoy(
    df: DataFrame,
    value: str,
    year: str = "fiscal_year",
    partition: str | Sequence[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Change on the year before: ``prev_<value>``, ``change_<value>`` and
    ``pct_change_<value>`` (DOUBLE, percent, 6 decimals); NULL where the year
    before has no row.

    Meant for yearly totals; without ``partition`` the window sees every row
    in one task, which is a handful of years.
    """
    w = Window.partitionBy(*_names(partition)).orderBy(year)
    prev = F.when(F.lag(year).over(w) == F.col(year) - 1, F.lag(value).over(w))
    name = prefix or value
    return (
        df.withColumn(f"prev_{name}", prev)
        .withColumn(f"change_{name}", F.col(value) - F.col(f"prev_{name}"))
        .withColumn(
            f"pct_change_{name}",
            F.round(
                F.try_divide(F.col(f"change_{name}").cast("double") * 100.0, F.col(f"prev_{name}").cast("double")),
                6,
            ),
        )
    )


def common_items(
    ranked: DataFrame,
    by: str | Sequence[str],
    item: str,
    facet: str,
) -> DataFrame:
    """Items present in every facet of their group (an N-way INTERSECT).

    ``ranked`` is typically a top-N table with one row per
    (group, facet, item); the facets counted are those the group has.  Rows
    without a facet (NULL) are in no facet and are left out.
    One exchange on the group keys: the facet count per group comes from a
    dense rank over facets (no self-join, no collected sets), and the
    per-item count reuses that partitioning.
    """
    keys = _names(by)
    w_order = Window.partitionBy(*keys).orderBy(F.col(facet))
    w_all = Window.partitionBy(*keys)
    counted = ranked.where(F.col(facet).isNotNull()).select(*keys, item, facet).withColumn(
        "_facet_no", F.dense_rank().over(w_order)
    ).withColumn("_n_facets", F.max("_facet_no").over(w_all))
    per_item = counted.groupBy(*keys, item).agg(
        F.countDistinct(facet).alias("n_facets"), F.max("_n_facets").alias("_n_facets")
    )
    return per_item.where(F.col("n_facets") == F.col("_n_facets")).drop("_n_facets")


def share_lift(
    freq: DataFrame,
    year: str,
    group: str,
    item: str,
    count: str = "frequency",
) -> DataFrame:
    """Share of an item inside its group and its lift over the item's share
    of the whole year: ``share``, ``overall_share``, ``lift`` (DOUBLE, 6 dp).

    ``freq`` is already aggregated (one row per year x group x item, so its
    size is bounded by the dimensions, not by the tickets).  It is clustered
    by year once; the three totals are window sums inside that clustering,
    with no joins back.
    """
    by_year = freq.repartition(year)
    group_tot = F.sum(count).over(Window.partitionBy(year, group))
    item_tot = F.sum(count).over(Window.partitionBy(year, item))
    year_tot = F.sum(count).over(Window.partitionBy(year))
    share = F.try_divide(F.col(count).cast("double"), group_tot.cast("double"))
    overall = F.try_divide(item_tot.cast("double"), year_tot.cast("double"))
    return by_year.select(
        year,
        group,
        item,
        count,
        F.round(share, 6).alias("share"),
        F.round(overall, 6).alias("overall_share"),
        F.round(F.try_divide(share, overall), 6).alias("lift"),
    )


def facet_frame(
    df: DataFrame,
    x: str,
    y: str,
    fill: str | None = None,
    facet_row: str | None = None,
    facet_col: str | None = None,
) -> DataFrame:
    """Long, chart-ready table: ``x`` as text (a discrete axis), ``y``,
    ``fill`` as text, and up to two facet columns."""
    cols = [F.col(x).cast("string").alias("x"), F.col(y).alias("y")]
    cols.append(F.col(fill or x).cast("string").alias("fill"))
    if facet_row:
        cols.append(F.col(facet_row).alias("facet_row"))
    if facet_col:
        cols.append(F.col(facet_col).alias("facet_col"))
    return df.select(cols)
