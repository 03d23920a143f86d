"""Shared helpers: rows picked by ids within and beyond the broadcast bound, joins with hot keys."""

import pytest
from conftest import plan_text
from pyspark.sql import functions as F

from ticketlens.llm import common
from ticketlens.llm.common import by_ids, hot_bound, join_hot, save, slices


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_by_ids_within_and_beyond_the_bound(spark, monkeypatch, how):
    rows = spark.createDataFrame([(i % 7 if i % 5 else None, f"t{i}", "x") for i in range(40)], "doc_id long, text string, __id string").drop("__id")
    ids = save(spark.createDataFrame([(1,), (3,), (3,), (99,)], "found long"), "test-ids")
    got = by_ids(rows, ids, "doc_id", how)
    assert "BroadcastHashJoin" in plan_text(got)
    monkeypatch.setattr(common, "BROADCAST_IDS", 0)
    wide = by_ids(rows, ids, "doc_id", how)
    assert "SortMergeJoin" in plan_text(wide)
    want = sorted((tuple(r) for r in rows.collect() if (r["doc_id"] in (1, 3)) == (how == "left_semi")), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, wide.collect()), key=repr) == want


def test_join_hot_with_any_bound(spark):
    left = spark.createDataFrame([(1, "a", i) for i in range(50)] + [(2, "b", i) for i in range(3)] + [(1, "b", 7), (3, "c", 1)], "k long, j string, v long")
    right = left.groupBy("k", "j").agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("top")).where("k < 3")
    want = sorted((r["k"], r["j"], r["v"], {(1, "a"): 49, (2, "b"): 2, (1, "b"): 7}[r["k"], r["j"]]) for r in left.where("k < 3").collect())
    for bound in (0, 3, 10, 1000):
        assert sorted(map(tuple, join_hot(left, right, ["k", "j"], "n", bound).select("k", "j", "v", "top").collect())) == want


def test_hot_keys_are_few():
    for total in (0, 10, 10**6, 10**12):
        assert total // (hot_bound(total) + 1) <= common.HOT_ROWS


def test_slices_hold_every_item_once():
    for sizes in ([], [5], [1] * 10, [100, 1, 1, 100, 3]):
        cuts = list(slices(sizes, 10))
        assert [i for a, b in cuts for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a == 1 or sum(sizes[a:b]) <= 10 for a, b in cuts)
