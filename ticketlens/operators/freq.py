"""Frequencies, top-N per group and rank lists.

``frequency`` is a grouped count (partial aggregation on the map side, so a
hot key costs one row per map task in the shuffle, not its row count).
``top_n_per_group`` filters a rank window directly; Spark turns
``rank <= n`` into a partial ``WindowGroupLimit`` that runs before the
shuffle, so each task forwards only its own top rows per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DENSE = "dense"
RANK = "rank"
ROW = "row"
_RANKERS = {DENSE: F.dense_rank, RANK: F.rank, ROW: F.row_number}


def _names(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def _none_null(cols: Sequence[str]) -> Column:
    cond = F.col(cols[0]).isNotNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond


def frequency(
    df: DataFrame,
    by: str | Sequence[str] | None,
    item: str | Sequence[str],
    count_nulls: bool = False,
    name: str = "frequency",
    exclude: Sequence | None = None,
) -> DataFrame:
    """Count per ``by + item`` group.

    ``count_nulls=False`` counts the item columns themselves, so a group with
    a NULL item gets frequency 0 (``count(col)``); ``True`` counts rows
    (``count(*)``) and such a group gets its real size.  ``exclude``
    drops placeholder item values (e.g. precinct 0) before counting; the
    filter sits under the aggregate, so it reaches the scan.
    """
    items = _names(item)
    keys = _names(by) + items
    if exclude:
        df = df.where(~F.col(items[0]).isin(list(exclude)) | F.col(items[0]).isNull())
    counter = F.count(F.lit(1)) if count_nulls else F.count_if(_none_null(items)).cast("long")
    return df.groupBy(*keys).agg(counter.alias(name))


def top_n_per_group(
    df: DataFrame,
    by: str | Sequence[str] | None,
    order: str | Column,
    n: int,
    ties: str = DENSE,
    ascending: bool = False,
    tiebreak: Sequence[str | Column] = (),
    rank_col: str | None = "rnk",
) -> DataFrame:
    """Rows whose rank within their ``by`` group is at most ``n``.

    ``ties="dense"`` keeps every row tied with the n-th value (so a group
    may return more than ``n`` rows); ``"row"`` returns exactly ``n`` rows
    and needs a ``tiebreak`` to be deterministic.
    """
    o = F.col(order) if isinstance(order, str) else order
    ordering = [o.asc() if ascending else o.desc()] + [
        F.col(t).asc() if isinstance(t, str) else t for t in tiebreak
    ]
    w = Window.partitionBy(*_names(by)).orderBy(*ordering)
    rname = rank_col or "_rnk"
    ranked = df.withColumn(rname, _RANKERS[ties]().over(w)).where(F.col(rname) <= n)
    return ranked if rank_col else ranked.drop(rname)


def top_n(
    df: DataFrame,
    order: str | Column,
    n: int,
    tiebreak: Sequence[str | Column] = (),
    ascending: bool = False,
) -> DataFrame:
    """Global first ``n`` rows (``ORDER BY .. LIMIT n``).

    Planned as TakeOrderedAndProject: each task keeps its own ``n`` best
    rows, and one task merges ``n`` x tasks rows - the data never passes
    through a global sort.  Give a ``tiebreak`` so the cut is deterministic.
    """
    o = F.col(order) if isinstance(order, str) else order
    ordering = [o.asc() if ascending else o.desc()] + [
        F.col(t).asc() if isinstance(t, str) else t for t in tiebreak
    ]
    return df.orderBy(*ordering).limit(n)


def rank_list(
    ranked: DataFrame,
    by: str | Sequence[str],
    item: str | Column,
    rank_col: str = "rnk",
    sep: str = ",",
    pad: int | None = None,
    name: str = "rank_list",
) -> DataFrame:
    """One text per group listing its items in rank order (``36,07,21``).

    Items of equal rank are listed by their text.  ``pad`` zero-pads numeric
    items to that width (never shortening a longer one); text items are
    listed as they are.  Input is a top-N result, so each group holds the
    rows of ``n`` distinct ranks.
    """
    col = F.col(item) if isinstance(item, str) else item
    label = col.cast("string")
    numeric = isinstance(item, str) and isinstance(ranked.schema[item].dataType, T.NumericType)
    if pad and numeric:
        label = F.when(F.length(label) < pad, F.lpad(label, pad, "0")).otherwise(label)
    pairs = F.sort_array(F.collect_list(F.struct(F.col(rank_col).alias("r"), label.alias("x"))))
    return ranked.groupBy(*_names(by)).agg(
        F.array_join(F.transform(pairs, lambda s: s["x"]), sep).alias(name)
    )
