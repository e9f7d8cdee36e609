"""Block dictionaries of tables larger than memory: sorts that spill, buckets of bounded size, lists one by one."""

from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import fixtures
from examloom.operators import dictionaries, features
from examloom.operators.dictionaries import BlockDictionaries
from examloom.sources.tables import staging
from tests.helpers import plan

SPILL = "spark.shuffle.spill.numElementsForceSpillThreshold"


@pytest.fixture()
def sorts_spill(spark):
    """Sorts write what they hold to disk after a few rows."""
    conf = spark._jvm.org.apache.spark.SparkEnv.get().conf()
    conf.set(SPILL, "40")
    yield
    conf.remove(SPILL)


def numbered(spark, n, tasks):
    rows = [(i, None if i % 17 == 0 else [f"w{(i * j) % 97}" for j in range(i % 9)]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, words array<string>").coalesce(tasks)


@pytest.mark.parametrize("tasks, per_bucket, buckets", [(1, 4, "8"), (3, 1, "3"), (2, 2, "1")])
def test_rows_stay_behind_their_first_when_sorts_spill(spark, conf, monkeypatch, sorts_spill, tasks, per_bucket, buckets):
    conf("spark.sql.shuffle.partitions", buckets)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(dictionaries, "PIECE_ROWS", 5)
    monkeypatch.setattr(dictionaries, "BLOCK_ROWS", 60)
    monkeypatch.setattr(dictionaries, "BUCKET_BLOCKS", per_bucket)
    rows, df = numbered(spark, 1_000, tasks)
    table = spark.createDataFrame([(f"w{i}", i) for i in range(0, 97, 2)], "word string, number int")
    out = BlockDictionaries(df, F.col("words"), "id").replaced(table, "word", "number", "numbers", F.lit(None).cast("int"))
    expected = [(i, None if ws is None else tuple(int(w[1:]) if int(w[1:]) % 2 == 0 else None for w in ws)) for i, ws in rows]
    assert Counter((r["id"], None if r["numbers"] is None else tuple(r["numbers"])) for r in out.collect()) == Counter(expected)


def test_a_task_fills_several_buckets(spark, conf, monkeypatch):
    """A bucket's values are held by one task: a large task of the input must not put all into one."""
    conf("spark.sql.shuffle.partitions", "64")
    monkeypatch.setattr(dictionaries, "PIECE_ROWS", 5)
    monkeypatch.setattr(dictionaries, "BLOCK_ROWS", 10)
    monkeypatch.setattr(dictionaries, "TASK_BUCKETS", 6)
    _, df = numbered(spark, 1_000, 1)
    blocks = BlockDictionaries(df, F.col("words"), "id")
    found = blocks.rows.groupBy("_block").agg(F.count("*").alias("n"), F.collect_set("_bucket").alias("buckets")).collect()
    assert len(found) == 100 and all(r["n"] == 10 and len(r["buckets"]) == 1 for r in found)
    by_bucket = Counter(r["buckets"][0] for r in found)
    assert len(by_bucket) == 6 and max(by_bucket.values()) <= 20


@pytest.mark.parametrize("tasks, buckets", [(6, "51"), (12, "200"), (4, "16")])
def test_buckets_fill_evenly(spark, conf, monkeypatch, tasks, buckets):
    conf("spark.sql.shuffle.partitions", buckets)
    monkeypatch.setattr(dictionaries, "PIECE_ROWS", 5)
    monkeypatch.setattr(dictionaries, "BLOCK_ROWS", 5)
    monkeypatch.setattr(dictionaries, "BUCKET_BLOCKS", 1)
    df = spark.range(0, 5 * 16 * tasks, 1, tasks).select("id", F.array(F.col("id")).alias("ids"))  # 16 blocks a task
    blocks = BlockDictionaries(df, F.col("ids"), "id")
    found = [r["n"] for r in blocks.rows.groupBy("_bucket").agg(F.countDistinct("_block").alias("n")).collect()]
    assert sum(found) == 16 * tasks and max(found) <= 2 * -(-16 * tasks // int(buckets))


def test_one_list_at_a_time(spark, conf, monkeypatch):
    """Lists of many blocks are never held as objects, and their values are exchanged by bucket, once."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    monkeypatch.setattr(dictionaries, "stage", lambda df, name: plans.append(plan(df)) or df)
    _, df = numbered(spark, 20, 1)
    BlockDictionaries(df, F.col("words"), "id").replaced(
        spark.createDataFrame([("w1", 1)], "word string, number int"), "word", "number", "numbers", F.lit(0))
    assert "SortAggregate" in plans[0] and "ObjectHashAggregate" not in plans[0]
    assert sum("Exchange hashpartitioning(_bucket" in line for line in plans[0].splitlines()) == 1


def test_files_of_blocks_go(spark):
    """The encoded rows are removed once their values are replaced: a query with two passes has one of them."""
    folder = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in folder.iterdir()}
    _, df = numbered(spark, 50, 2)
    with staging(spark):
        coded, ids = features.tokenize_with_ids(df.select("id", F.array_join("words", " ").alias("text")), "id")
        text = features.detokenize(coded, ids, "id")
        left = {p.name.split("-")[0] for p in folder.iterdir() if p.name not in before}
        assert text.count() == 50 and "replaced" in left and "blocks" not in left
    assert {p.name for p in folder.iterdir()} == before


def test_large_tables_are_dealt_over_more_tasks(spark, conf, tmp_path):
    """What a task holds does not grow with the table."""
    spark.range(0, 2_000, 1, 1).selectExpr("id AS doc_id", "repeat(sha2(cast(id AS string), 256), 20) AS text").write.parquet(
        str(tmp_path / "documents.parquet"))
    cores = spark.sparkContext.defaultParallelism
    assert fixtures.table(spark, str(tmp_path), "documents").rdd.getNumPartitions() == cores
    conf("spark.sql.files.maxPartitionBytes", "4096")
    assert fixtures.table(spark, str(tmp_path), "documents").rdd.getNumPartitions() > cores
    assert fixtures.table(spark, str(tmp_path), "documents").count() == 2_000
