"""Mixing sources to target weights by subset-sum budget fitting.

Sizes are word counts (any length column may be given).  Every source's
target is its weight's share of all words, at most ``repeat_cap`` times the
source's own words; what the cap leaves over is shared again by weight until
no source is above it.  A source is taken whole as often as its target holds
it, and the rest of its budget is fitted: documents are counted by exact
length, each length gives its proportional part, and a bounded-knapsack
dynamic program over the lengths chooses how many more of each, or fewer, come
nearest to the budget.  Which documents of a length are taken is decided
by a seeded hash.

Scale: only counts by (source, length, hash bucket) are aggregated; a source
is fitted on its lengths, never on its documents.  The ranking inside a length
runs per hash bucket, so a length that a third of all rows share is ranked in
``BUCKETS`` parts.

Defined results: a NULL text has size 0, as has an empty one; such documents
are in the result and nothing is taken of them.  A NULL source is a source of
its own, last in the order.  Rows with the same id and text are separate
documents; ties of the hash are broken by the text's hash, and wholly equal
rows are interchangeable.  An empty table gives an empty result.  Input
columns are carried in one struct, so their names clash with nothing.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlens.llm.common import ready_workers, save

WEIGHTS = (5.0, 2.0, 1.0)
REPEAT_CAP = 3
SEED = 17
BUCKETS = 256
DP_WORDS = 50_000
DP_BITS = 1 << 31  # 256 MB


def word_count(text: str) -> Column:
    """Number of runs of characters other than space and U+0009..U+000D (NULL: 0)."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _source_key(source: Column) -> Column:
    """The source as a key that is never NULL."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], repeat_cap: int) -> DataFrame:
    """(source, source_size) -> the same with ``target``; one row per source.

    Sources in code point order (NULL last) take the weights in turn.  The
    shares are those of the level at which sum(min(cap, level * weight)) is
    the whole: sources are put in order of cap / weight, and those before the
    first whose cap exceeds its share of what is left stop at their caps.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1
    s = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn.cast("int")))
    s = s.withColumn("cap", F.col("source_size") * F.lit(repeat_cap))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    before, onward = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    s = s.withColumn("level", left / F.sum("weight").over(onward))
    s = s.withColumn("free", F.col("cap") > F.col("level") * F.col("weight"))
    level = F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), F.col("level")))).over(every)
    target = F.least(F.col("cap").cast("double"), F.coalesce(level["level"] * F.col("weight"), F.col("cap").cast("double")))
    return s.select("source", "source_size", target.alias("target"))


def fit_budget(
    lengths: np.ndarray, counts: np.ndarray, budget: int, seed: int, dp_words: int = DP_WORDS, dp_bits: int = DP_BITS
) -> np.ndarray:
    """How many documents of each length to take so that their words come nearest to ``budget``.

    Equally near sums go to the smaller one.  The proportional part of every
    length leaves less than one document of each; seeded lengths fill that
    down to ``dp_words``.  From there a dynamic program (one bit per reachable
    sum) adds documents and gives documents back, within a window of sums
    around the budget.  The window is doubled until the sum is proven nearest:
    it is off by no more than any multiple of the lengths' common divisor, or
    the window holds all sums.  Beyond ``dp_bits`` bits kept for the way back
    the search ends with the nearest sum found (not met with any table of
    many lengths, whose first window holds an exact sum).
    """
    take = np.zeros(len(lengths), dtype=np.int64)
    total = int((lengths * counts).sum())
    if total == 0 or budget <= 0:
        return take
    if budget >= total:
        return np.where(lengths > 0, counts, 0)
    take = np.array([int(c) * budget // total if n > 0 else 0 for n, c in zip(lengths, counts)], dtype=np.int64)
    left = budget - int((take * lengths).sum())
    order = np.random.RandomState(seed).permutation(len(lengths))
    for i in order:
        if left <= dp_words:
            break
        if lengths[i] > 0 and take[i] < counts[i] and lengths[i] <= left:
            take[i] += 1
            left -= int(lengths[i])
    present = lengths[(lengths > 0) & (counts > 0)]
    divisor = int(np.gcd.reduce(present))
    nearest = min(budget % divisor, -budget % divisor)  # no sum can be nearer
    width = max(2 * left, 2 * int(present.max()), 1)
    while True:
        moved, miss, bits = _near(lengths, counts, take, left, order, min(width, total))
        if miss == nearest and (miss == 0 or int((moved * lengths).sum()) <= budget):
            return moved
        if width >= total or 2 * bits > dp_bits:
            return moved
        width *= 2


def _near(lengths: np.ndarray, counts: np.ndarray, take: np.ndarray, left: int, order: np.ndarray, width: int) -> tuple[np.ndarray, int, int]:
    """(documents per length, words off, bits kept) of the sum nearest to ``left`` words more than ``take``.

    Bit s + width of ``reach`` tells whether a sum of s words more is reached;
    a length's documents go in, and are given back, as 1, 2, 4, ... of them.
    """
    aim, mask = width + left, (1 << (2 * width + 1)) - 1
    reach, steps = 1 << width, []
    for sign in (1, -1):
        for i in order:
            n = int(lengths[i])
            spare = min(int(counts[i] - take[i]) if sign > 0 else int(take[i]), 2 * width // n) if n > 0 else 0
            group = 1
            while spare > 0 and not reach >> aim & 1:
                k = min(group, spare)
                grown = reach | (reach << k * n & mask if sign > 0 else reach >> k * n)
                if grown != reach:
                    steps.append((i, sign * k, reach))
                    reach = grown
                spare, group = spare - k, group * 2
    below = (reach & ((1 << (aim + 1)) - 1)).bit_length() - 1
    above = reach >> (aim + 1)
    over = aim + (above & -above).bit_length() if above else None
    best = over if over is not None and (below < 0 or over - aim < aim - below) else below
    miss = abs(best - aim)
    moved = take.copy()
    for i, k, without in reversed(steps):
        if not without >> best & 1:
            moved[i] += k
            best -= k * int(lengths[i])
    return moved, miss, len(steps) * 2 * width


def _fit_source(seed: int, repeat_cap: int):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("size").reset_index(drop=True)
        size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
        whole = min(int(target // size), repeat_cap) if size else 0
        budget = min(max(int(round(target - whole * size)), 0), size) if whole < repeat_cap else 0
        extra = fit_budget(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), budget, seed)
        return pd.DataFrame({"source": pdf["source"], "size": pdf["size"], "whole": whole, "extra": extra})

    return fit


def mix(
    docs: DataFrame,
    size: Column,
    source_col: str = "source",
    id_col: str = "doc_id",
    tie: Column | None = None,
    weights: tuple[float, ...] = WEIGHTS,
    repeat_cap: int = REPEAT_CAP,
    seed: int = SEED,
) -> DataFrame:
    """Every row of ``docs`` as struct ``row`` with source, size, source_size, target and copies.

    ``copies`` is how often the mix takes the document; ``tie`` orders rows
    whose ids have equal hashes.
    """
    if repeat_cap < 1:
        raise ValueError("repeat_cap must be at least 1")
    ready_workers(docs.sparkSession)
    rank = F.xxhash64(F.lit(seed), F.col(id_col))
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(source_col).cast("string").alias("source"),
        _source_key(F.col(source_col).cast("string")).alias("key"),
        size.alias("size"),
        rank.alias("rank"),
        F.pmod(F.xxhash64(F.lit(seed + 1), rank), F.lit(BUCKETS)).cast("int").alias("bucket"),
        (tie if tie is not None else F.lit(0)).alias("tie"),
    )
    counted = save(rows.groupBy("source", "size", "bucket").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    sizes = counted.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = save(source_targets(sizes, weights, repeat_cap), "mix-targets")
    same_source = F.col("l.source").eqNullSafe(F.col("t.source"))
    lengths = counted.groupBy("source", "size").agg(F.sum("n").alias("n"))
    lengths = lengths.alias("l").join(targets.alias("t"), same_source).select("l.*", "t.source_size", "t.target")
    fitted = lengths.groupBy("source").applyInPandas(_fit_source(seed, repeat_cap), "source string, size long, whole int, extra long")
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quota = (
        counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .alias("c")
        .join(fitted.alias("f"), F.col("c.source").eqNullSafe(F.col("f.source")) & (F.col("c.size") == F.col("f.size")))
        .join(targets.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")))
        .select(
            _source_key(F.col("c.source")).alias("key"), "c.size", "c.bucket", "f.whole", "t.source_size", "t.target",
            F.least(F.greatest(F.col("f.extra") - F.col("c.before"), F.lit(0)), F.col("c.n")).alias("quota"),
        )
    )
    quota = save(quota, "mix-quota")
    # one shuffle of the rows serves the join and the ranking
    joined = rows.join(quota, ["key", "size", "bucket"])
    place = F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("rank", "tie"))
    copies = F.when(F.col("size") > 0, F.col("whole") + (place <= F.col("quota")).cast("int")).otherwise(0)
    return joined.select("row", "source", "size", "source_size", "target", copies.alias("copies"))


def mix_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document; texts are read once."""
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(text_col).alias("size"),
        F.xxhash64(F.col(text_col)).alias("tie"),
    )
    narrow = save(narrow, "mix-sizes")
    mixed = mix(narrow, F.col("size"), tie=F.col("tie"), **options)
    return mixed.select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).cast("long").alias("taken"),
    )


def mixed_rows(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, same columns."""
    mixed = mix(docs, word_count(text_col), tie=F.xxhash64(F.col(text_col)), **options)
    repeated = mixed.where(F.col("copies") > 0).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("row.*")
