"""Connected components of a link table, in logarithmically many rounds.

Alternating large-star and small-star steps (Kiveris et al., 2014): a large
star links every node's larger neighbours to the smallest of its
neighbourhood, a small star its smaller neighbours and itself.  Each step is
one aggregate and one join on the links; no neighbourhood is collected, and
the links of a root that many nodes hang on stay where they are (``join_hot``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticketlens.llm.common import hot_bound, join_hot, save


def _large_star(links: DataFrame, bound: int) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"))
    return join_hot(both, least, "u", "n", bound).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame, bound: int) -> DataFrame:
    # every link is (u, v) with u > v here
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    moved = join_hot(links, least, "u", "n", bound).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(pairs: DataFrame) -> DataFrame:
    """(node, component) of every node of ``pairs(a, b)``; a component's name is its smallest node."""
    links = pairs.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    links = save(links, "links")
    before = _state(links)
    while before[0]:
        bound = hot_bound(2 * before[0])
        links = save(_small_star(save(_large_star(links, bound), "stars"), bound).distinct(), "links")
        after = _state(links)
        if after == before:
            break
        before = after
    nodes = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots)
