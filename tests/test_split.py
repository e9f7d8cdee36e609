"""Exact, seeded split."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from examloom.operators.split import assign_split, train_eval_split


def expected_eval(ids, share=0.1, seed=42):
    order = sorted(ids, key=lambda i: hashlib.md5(f"{seed}:{i}".encode()).hexdigest())
    return set(order[:math.ceil(share * len(ids))])


@pytest.mark.parametrize("partitions", [1, 17])
@pytest.mark.parametrize("share", [0.1, 0.37])
def test_split_is_exact_and_independent_of_partitioning(spark, partitions, share):
    df = spark.range(1_003).select(F.concat(F.lit("q-"), "id").alias("id")).repartition(partitions)
    train, evaluation = train_eval_split(df, test_size=share)
    got = {r["id"] for r in evaluation.collect()}
    assert got == expected_eval([f"q-{n}" for n in range(1_003)], share)
    assert {r["id"] for r in train.collect()} == {f"q-{n}" for n in range(1_003)} - got


def test_seed_changes_the_split(spark):
    df = spark.range(500)
    a = {r["id"] for r in train_eval_split(df, seed=1)[1].collect()}
    b = {r["id"] for r in train_eval_split(df, seed=2)[1].collect()}
    assert len(a) == len(b) == 50 and a != b


@pytest.mark.parametrize("share, size", [(0.0, 0), (1.0, 20), (0.001, 1)])
def test_extreme_shares(spark, share, size):
    df = spark.range(20)
    assert assign_split(df, test_size=share).filter("is_eval").count() == size


def test_empty_table(spark):
    assert assign_split(spark.range(0)).count() == 0


def hot(spark, rows, content):
    """A third of all rows share the id that the cut falls on."""
    at_cut = sorted((str(n) for n in range(100)),
                    key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())[0]
    return spark.range(0, rows, numPartitions=7).select(
        F.when(F.col("id") % 3 == 0, at_cut).otherwise(F.concat(F.lit("n"), "id")).alias("id"),
        content.alias("content"))


def test_repeated_id_is_split_by_content(spark):
    df = hot(spark, 900, F.col("id").cast("string"))
    rows = assign_split(df, test_size=0.2).collect()
    again = assign_split(df.repartition(3), test_size=0.2).collect()
    assert len(rows) == 900 and sum(r["is_eval"] for r in rows) == 180
    assert {tuple(r) for r in rows} == {tuple(r) for r in again}


def test_identical_rows_are_counted_exactly(spark):
    df = hot(spark, 900, F.lit("same")).cache()
    for share in (0.1, 0.2, 0.5):
        train, evaluation = train_eval_split(df, test_size=share)
        assert evaluation.count() == math.ceil(share * 900)
        assert train.count() == 900 - math.ceil(share * 900)
        assert sorted(map(tuple, train.union(evaluation).collect())) == sorted(
            map(tuple, df.collect()))
