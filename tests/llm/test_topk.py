"""Top-k: against a sort of all scores, ties, big numbers, edge rows."""

import math
from fractions import Fraction

import numpy as np
from conftest import plan_text
from pyspark.sql import functions as F

from ticketlens.llm import topk
from ticketlens.llm.topk import Lists, top_k

SCHEMA = "vec_id long, embedding array<double>, rank int, score long, shard string, v string"


def brute(rows, is_query, k=5):
    fit = []
    for i, x, *_ in rows:
        if i is None or not x or any(c is None or not math.isfinite(c) for c in x):
            continue
        fit.append((i, [math.floor(256 * Fraction(c)) for c in x]))
    out = []
    for q in sorted({i for i, _ in fit if is_query(i)}):
        own = [x for i, x in fit if i == q]
        scored = []
        for j, y in fit:  # a candidate row counts once, with its best score
            found = [sum(a * b for a, b in zip(x, y)) for x in own if len(x) == len(y)]
            if j != q and found:
                scored.append((-min(max(max(found), -(2**63)), 2**63 - 1), j))
        out += [(q, r + 1, j, -s) for r, (s, j) in enumerate(sorted(scored)[:k])]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 0, "x", "y") for r in rows], SCHEMA)


def test_against_all_scores_with_small_tiles(spark):
    rs = np.random.RandomState(0)
    rows = [(i, [float(x) for x in rs.randint(-3, 4, 6) / 4]) for i in range(200)]  # many equal scores
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0, query_tile=4, vector_tile=3)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 10 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_unfit_vectors_other_lengths_and_few_candidates(spark):
    rows = [
        (0, [0.1, -0.3]), (1, [0.5, 0.5]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
        (6, []), (7, [0.1, 0.2, 0.3]), (8, [-0.001, 0.0]), (None, [1.0, 1.0]), (10, [0.2, 0.2]), (20, [1.0, 2.0, 3.0]),
    ]
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0)


def test_numbers_too_large_for_floating_point():
    q, v = np.array([[2.0**40, 1.0]]), np.array([[2.0**20 + 1, 5.0], [2.0**20 + 1, 6.0]])
    found = Lists(np.array([0]), q, 1)
    found.add(np.array([1, 2]), np.array([1, 2]), v, 10)
    assert found.vec.tolist() == [2] and found.score.tolist() == [2**40 * (2**20 + 1) + 6]


def test_huge_components_and_scores_beyond_a_long(spark):
    rows = [(0, [3e9, 1.0]), (10, [-3e9, 2.0]), (20, [1e300, -1e300]), (30, [1.7e308, 1.0]), (1, [3e9, 5.0]), (2, [4e9, 0.0]), (3, [1e18, 1e18])]
    rows += [(4, [5e-324, -5e-324]), (5, [-1e308, 7.0]), (6, [0.1, 0.1]), (7, [2.0**53, 1.0])]
    got = top_k(frame(spark, rows), F.col("vec_id") % 10 == 0).collect()
    assert sorted(map(tuple, got)) == brute(rows, lambda i: i % 10 == 0)


def test_rows_that_share_an_id(spark):
    rs = np.random.RandomState(3)
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0])] + [(i, [float(x) for x in rs.randint(-3, 4, 2)]) for i in (1, 2, 3, 4, 5, 6, 2, 2)]
    got = top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0)
    assert len({r["vec_id"] for r in got.collect()}) >= 3


def test_blocks_tiles_and_groups_of_tasks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(topk, "MERGE_GROUP", 2)
    rs = np.random.RandomState(5)
    rows = [(i, [float(x) for x in rs.randint(-9, 9, 3)]) for i in range(300)] + [(i, [1.0, float(i % 7)]) for i in range(300, 360)]
    vectors = frame(spark, rows).repartition(9)
    got = top_k(vectors, F.col("vec_id") % 3 == 0, query_tile=7, vector_tile=16, block_bytes=900)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 3 == 0)


def test_candidates_are_not_shuffled(spark):
    rows = [(i, [float(i), 1.0]) for i in range(100)]
    plan = plan_text(top_k(frame(spark, rows), F.col("vec_id") % 10 == 0))
    below = plan[plan.index("MapInArrow") :]
    assert "Exchange" not in below and "WindowGroupLimit" in plan


def test_empty_and_no_query(spark):
    assert top_k(frame(spark, []), F.col("vec_id") == 0).collect() == []
    assert top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") == 0).collect() == []
