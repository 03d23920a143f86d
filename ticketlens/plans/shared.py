"""All frequency questions from one scan (GROUPING SETS).

Asked one by one, the questions scan the cleaned table about thirty times,
each time decoding the same few columns.  Here one aggregation with
``GROUPING SETS`` reads every needed column once (each row enters once per
set, so sets that are coarser than another one are summed from it), aggregates
partially in each task (one row per task and group, so hot keys cost nothing extra) and
shuffles only those partial counts.  Its result - one row per group of each
set, bounded by the dimensions, not by the tickets - is small; every
question is then a filter, rank or join on it.

The answers are the same as the direct questions in ``questions.py``
(tests compare them).  ``count(item)`` semantics are recovered from the row
count: the NULL item group scores 0, every other group its row count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticketlens.functions.clock import CLOCK, hour_of
from ticketlens.functions.labels import bin_initials, season_label, time_bin
from ticketlens.operators.compare import common_items, facet_frame, pivot_years, share_lift, yoy
from ticketlens.operators.freq import rank_list, top_n, top_n_per_group
from ticketlens.operators.joins import restrict_to
from ticketlens.operators.revenue import fines_join, revenue, revenue_rollup, top_revenue_code, yearly_revenue
from ticketlens.plans import questions as q
from ticketlens.roles import DEFAULT_ROLES, Roles

R = DEFAULT_ROLES


def _gid(keys: Sequence[str], all_cols: Sequence[str]) -> int:
    """``grouping_id()`` of a set: bit (k-1-i) is 1 when column i is rolled up."""
    k = len(all_cols)
    return sum(1 << (k - 1 - i) for i, c in enumerate(all_cols) if c not in keys)


class Cube:
    """A grouping-sets aggregate plus the bookkeeping to read one set back."""

    def __init__(self, df: DataFrame, sets: Mapping[str, Sequence[str]], cols: Sequence[str]):
        self.df = df
        self.sets = {name: list(keys) for name, keys in sets.items()}
        self.cols = list(cols)

    def set(self, name: str) -> DataFrame:
        keys = self.sets[name]
        rest = [c for c in self.df.columns if c not in self.cols and c != "_gid"]
        return self.df.where(F.col("_gid") == _gid(keys, self.cols)).select(*keys, *rest)

    def materialize(self, name: str) -> "Cube":
        """Write the (small) aggregate under the checkpoint folder and read
        it back, so the questions share one computation and a lost executor
        re-reads files instead of re-scanning the tickets."""
        from ticketlens.sources.sink import materialize

        self.df = materialize(self.df, name)
        return self


def _cube(
    df: DataFrame, sets: Mapping[str, Sequence[str]], aggs: Mapping[str, Column], coarser: Mapping[str, str] | None = None
) -> Cube:
    """The grouping-sets aggregate of ``sets``.

    Every row goes into the aggregate once per set, so a set that is coarser
    than another one (``coarser``: name -> name of a finer set) is summed from
    that set's groups instead; all ``aggs`` are counts.
    """
    coarser = coarser or {}
    cols: list[str] = []
    for keys in sets.values():
        cols.extend(k for k in keys if k not in cols)
    base = {name: keys for name, keys in sets.items() if name not in coarser}
    grouped = df.groupingSets([tuple(k) for k in base.values()], *cols)
    out = grouped.agg(*[c.alias(name) for name, c in aggs.items()], F.grouping_id().alias("_gid"))
    if not coarser:
        return Cube(out, sets, cols)
    # every group is itself and a part of the groups of the coarser sets: one more aggregate, over groups
    types = dict(out.dtypes)

    def place(keys: Sequence[str], gid: Column) -> Column:
        held = [(F.col(c) if c in keys else F.lit(None).cast(types[c])).alias(c) for c in cols]
        return F.struct(*held, gid.cast(types["_gid"]).alias("_gid"))

    parts = [
        F.when(F.col("_gid") == _gid(sets[source], cols), place(sets[name], F.lit(_gid(sets[name], cols)))) for name, source in coarser.items()
    ]
    placed = out.select(F.explode(F.array_compact(F.array(place(cols, F.col("_gid")), *parts))).alias("at"), *aggs)
    whole = placed.select("at.*", *aggs).groupBy(*cols, "_gid").agg(*[F.sum(a).cast(types[a]).alias(a) for a in aggs])
    return Cube(whole.select(*cols, *aggs, "_gid"), sets, cols)


def _all_null(cols: Sequence[str]) -> Column:
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond & F.col(c).isNull()
    return cond


def ticket_cube(t: DataFrame, r: Roles = R) -> Cube:
    """Every count the ticket questions need, from one pass over ``t``."""
    y = r.year
    sets = {
        "year": [y],
        "year_state": [y, r.state],
        "year_code": [y, r.code],
        "year_body": [y, r.body],
        "year_make": [y, r.make],
        "year_vprec": [y, r.violation_precinct],
        "year_iprec": [y, r.issuer_precinct],
        "iprec": [r.issuer_precinct],
        "year_iprec_code": [y, r.issuer_precinct, r.code],
        "year_season_code": [y, r.season, r.code],
    }
    keyed = t.withColumn(r.season, season_label(F.month(r.date)))
    aggs = {
        "n_rows": F.count(F.lit(1)),
        "n_summons": F.count(r.summons),
        "n_missing_3": F.count_if(_all_null(list(r.address))),
        "n_missing_2": F.count_if(_all_null(list(r.street_address))),
    }
    coarser = {"year": "year_vprec", "year_code": "year_season_code", "year_iprec": "year_iprec_code", "iprec": "year_iprec_code"}
    return _cube(keyed, sets, aggs, coarser)


def time_cube(t: DataFrame, r: Roles = R, mode: str = CLOCK) -> Cube:
    """Counts for the time-of-day questions, from one pass.  Rows without a
    usable time fall into the NULL bin, which the questions leave out."""
    clocked = q.with_clock(t, r, mode).withColumn(r.time_of_day, time_bin(hour_of(r.minute_of_day)))
    sets = {
        "all": [],
        "code": [r.code],
        "year_bin_code": [r.year, r.time_of_day, r.code],
    }
    valid = F.col(r.minute_of_day).isNotNull()
    aggs = {"n_rows": F.count_if(valid), "n_missing_time": F.count_if(~valid)}
    return _cube(clocked, sets, aggs, {"code": "year_bin_code"})


# --- reading questions back -----------------------------------------------------


def _freq(cube: Cube, name: str, item: str, count_nulls: bool) -> DataFrame:
    """Frequency frame of one set: ``count(*)`` or ``count(item)``."""
    df = cube.set(name)
    value = F.col("n_rows") if count_nulls else F.when(F.col(item).isNull(), F.lit(0)).otherwise(F.col("n_rows"))
    keys = cube.sets[name]
    return df.select(*keys, value.cast("long").alias("frequency"))


def ticket_questions(
    cube: Cube,
    r: Roles = R,
    fines: DataFrame | None = None,
    fines_rows: int | None = None,
    given_precincts: Sequence[int] = (0, 19, 14),
    years: Sequence[int] | None = None,
    exclude_precincts: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    y = r.year
    year = cube.set("year")
    out: dict[str, DataFrame] = {
        "tickets_per_year": year.select(y, F.col("n_summons").alias("n_tickets")).orderBy(y),
        "unique_states": cube.set("year_state")
        .groupBy(y)
        .agg(F.count(r.state).alias("n_states"))
        .orderBy(y),
        "missing_address_3": _missing(year, y, "n_missing_3"),
        "missing_address_2": _missing(year, y, "n_missing_2"),
    }
    items = {
        "top5_code": ("year_code", r.code),
        "top5_body": ("year_body", r.body),
        "top5_make": ("year_make", r.make),
        "top5_viol_precinct": ("year_vprec", r.violation_precinct),
        "top5_issuer_precinct": ("year_iprec", r.issuer_precinct),
    }
    ex = list(exclude_precincts) if exclude_precincts else None
    for key, (name, item) in items.items():
        freq = _freq(cube, name, item, count_nulls=False)
        if ex and item in (r.violation_precinct, r.issuer_precinct):
            freq = freq.where(~F.col(item).isin(ex) | F.col(item).isNull())
        out[key] = top_n_per_group(freq, y, "frequency", 5)

    prec = _freq(cube, "iprec", r.issuer_precinct, count_nulls=False)
    if ex:
        prec = prec.where(~F.col(r.issuer_precinct).isin(ex) | F.col(r.issuer_precinct).isNull())
    busiest = top_n(prec, "frequency", 3, tiebreak=[r.issuer_precinct])
    out["global_top_precincts"] = busiest
    pc = _freq(cube, "year_iprec_code", r.code, count_nulls=False)
    out["precinct_code_freq"] = pc.where(F.col(r.issuer_precinct).isin(list(given_precincts)))
    keys = busiest.select(r.issuer_precinct)
    derived = restrict_to(pc, keys, r.issuer_precinct, row_bound=3)
    top_pc = top_n_per_group(derived, [y, r.issuer_precinct], "frequency", 5)
    out["top5_code_per_precinct"] = top_pc
    out["common_codes"] = common_items(top_pc, y, r.code, r.issuer_precinct)
    lift = share_lift(pc, y, r.issuer_precinct, r.code)
    out["precinct_code_lift"] = restrict_to(lift, keys, r.issuer_precinct, row_bound=3)
    out["rank_list_precinct"] = rank_list(top_pc, [y, r.issuer_precinct], r.code, pad=2)

    sc = _freq(cube, "year_season_code", r.code, count_nulls=True)
    out["tickets_per_season"] = (
        sc.groupBy(y, r.season).agg(F.sum("frequency").cast("long").alias("frequency"))
        .orderBy(F.col("frequency").desc(), y, r.season)
    )
    top_sc = top_n_per_group(sc, [y, r.season], "frequency", 3)
    out["top3_code_per_season"] = top_sc
    out["rank_list_season"] = rank_list(top_sc, [y, r.season], r.code, pad=2)
    out["common_codes_seasons"] = common_items(top_sc, y, r.code, r.season)

    code_star = _freq(cube, "year_code", r.code, count_nulls=True)
    top4 = top_n_per_group(code_star, y, "frequency", 4)
    out["top4_code"] = top4
    out["yoy_tickets"] = yoy(out["tickets_per_year"], "n_tickets", y)
    wide = pivot_years(code_star, r.code, y, years, value="frequency")
    cells = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in wide.columns if c != r.code]
    out["pivot_years"] = wide.select(r.code, *cells)
    out["facet_frame"] = facet_frame(out["top5_code"], x=r.code, y="frequency", fill=r.code, facet_col=y)
    if fines is not None:
        rev = revenue(top4, fines, r.code, fines_rows=fines_rows)
        out["fines_join"] = fines_join(top4, fines, r.code, fines_rows=fines_rows)
        out["revenue"] = rev
        out["revenue_rollup"] = revenue_rollup(rev, y, r.code)
        out["top_revenue_code"] = top_revenue_code(rev, y, r.code)
        out["yoy_revenue"] = yoy(yearly_revenue(rev, y), "total_revenue", y)
    return out


def _missing(year: DataFrame, y: str, col: str) -> DataFrame:
    # the direct question counts the year column itself, so a NULL year scores 0
    value = F.when(F.col(y).isNull(), F.lit(0)).otherwise(F.col(col))
    return year.where(F.col(col) > 0).select(y, value.cast("long").alias("n_missing")).orderBy(y)


def time_questions(
    cube: Cube, r: Roles = R, given_codes: Sequence = (14, 21, 38)
) -> dict[str, DataFrame]:
    y, tod = r.year, r.time_of_day
    ybc = cube.set("year_bin_code").where(F.col(tod).isNotNull())
    freq = ybc.select(y, tod, r.code, F.col("n_rows").cast("long").alias("frequency"))
    top_bin = top_n_per_group(freq, [y, tod], "frequency", 3)
    by_code = freq.select(y, r.code, tod, "frequency")
    codes_overall = (
        cube.set("code").where((F.col("n_rows") > 0) & F.col(r.code).isNotNull()).select(r.code, F.col("n_rows").cast("long").alias("frequency"))
    )
    top_codes = top_n(codes_overall, "frequency", 3, tiebreak=[r.code]).select(r.code)
    for_top = restrict_to(by_code, top_codes, r.code, row_bound=3)
    top_bins = top_n_per_group(for_top, [y, r.code], "frequency", 5)
    return {
        # a global aggregate: one row even when the table is empty
        "missing_time_count": cube.set("all").agg(
            F.coalesce(F.sum("n_missing_time"), F.lit(0)).cast("long").alias("n_missing")
        ),
        "top3_code_per_bin": top_bin,
        "bins_for_codes": by_code.where(F.col(r.code).isin(list(given_codes))),
        "top5_bin_per_code": top_bins,
        "rank_list_bin": rank_list(top_bin, [y, tod], r.code, pad=2),
        "rank_list_code": rank_list(top_bins, [y, r.code], bin_initials(tod)),
        "common_codes_bins": common_items(top_bin, y, r.code, tod),
    }
