"""Joins that take no detour where no key is hot: few plans, few broadcasts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from examloom.llm import jaccard
from examloom.llm.common import attach
from tests.helpers import plan


@pytest.mark.parametrize("hot", [False, True])
def test_attach_splits_rows_only_for_hot_keys(spark, conf, hot):
    conf("spark.sql.shuffle.partitions", "4")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    keys = [i % 8 for i in range(80)] + [3] * (200 if hot else 0)
    left = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long")
    groups = spark.createDataFrame([(k, n, f"g{k}") for k, n in Counter(keys).items()], "k long, _n long, g string")
    out = attach(left, groups, "k", "_n")
    assert ("Union" in plan(out)) == hot and ("Broadcast" in plan(out)) == hot
    assert sorted(tuple(r) for r in out.select("k", "i", "g").collect()) == sorted((k, i, f"g{k}") for i, k in enumerate(keys))


def test_attach_nothing(spark):
    none = spark.createDataFrame([], "k long, _n long, g string")
    assert attach(spark.range(3).withColumnRenamed("id", "k"), none, "k", "_n").collect() == []


@pytest.mark.parametrize("share", [1, 1_000])
def test_verified_spreads_only_sets_of_many_pairs(spark, conf, monkeypatch, share):
    conf("spark.sql.shuffle.partitions", "4")
    monkeypatch.setattr(jaccard, "HOT", share)
    names, staged = [], jaccard.staged
    monkeypatch.setattr(jaccard, "staged", lambda df, name: names.append(name) or staged(df, name))
    tokens = {1: [1, 2, 3, 4, 5], 2: [1, 2, 3, 4, 5, 6], 3: [1, 2, 3, 4, 5, 7], 4: [1, 8, 9, 10, 11]}
    whole = spark.createDataFrame([(s, len(t), t, t, t) for s, t in tokens.items()],
                                  "set_id long, n long, tokens array<long>, p2 array<long>, p3 array<long>")
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1), (3, 2)], "u long, v long")
    out = jaccard._verified(pairs, whole, jaccard.Threshold(percent=80, k=5))
    assert sorted(tuple(r) for r in out.collect()) == [(2, 1), (3, 1)]
    assert names == (["pair-counts"] if share == 1 else [])


def test_near_keeps_the_pairs_columns(spark):
    sets = spark.createDataFrame([(1, 300, [0] * 8), (2, 300, [0] * 8), (3, 300, [-1] * 8)], "set_id long, n long, wide array<long>")
    pairs = spark.createDataFrame([(1, 2, 7), (1, 3, 8)], "u long, v long, v_mult long")
    near = jaccard._near(pairs, sets, jaccard.Threshold())
    assert [r.asDict() for r in near.collect()] == [{"u": 1, "v": 2, "v_mult": 7}]
