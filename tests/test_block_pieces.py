"""Blocks of several pieces: one dictionary for all of them, in the block's first row alone."""

from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from examloom.operators import dictionaries
from examloom.operators.dictionaries import BlockDictionaries
from tests.helpers import plan
from tests.test_dictionaries import arrays


@pytest.fixture()
def pieces_of_five(conf, monkeypatch):
    conf("spark.sql.shuffle.partitions", "2")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(dictionaries, "PIECE_ROWS", 5)


def test_a_block_has_one_dictionary(spark, pieces_of_five):
    rows, df = arrays(spark, 200)
    blocks = BlockDictionaries(df.coalesce(1), F.col("words"), "id")
    found = blocks.rows.groupBy("_block").agg(F.count("*").alias("n"), F.sum(F.size("_entries")).alias("entries"),
                                              F.sum((F.size("_entries") > 0).cast("int")).alias("carriers")).collect()
    assert [(r["n"], r["entries"], r["carriers"]) for r in found] == [(200, len({w for _, ws in rows for w in ws or ()}), 1)]


@pytest.mark.parametrize("limit", [("BLOCK_ROWS", 12), ("BLOCK_ELEMENTS", 60), ("BLOCK_BYTES", 400), ("BLOCK_BYTES", 1 << 20)])
@pytest.mark.parametrize("kind", ["int", "string"])
def test_replaced_in_pieces(spark, pieces_of_five, monkeypatch, limit, kind):
    monkeypatch.setattr(dictionaries, *limit)
    rows, df = arrays(spark, 150)
    rows += [(900 + i, []) for i in range(20)] + [(950, None)]  # blocks without elements among them
    df = df.unionByName(spark.createDataFrame(rows[150:], df.schema))
    table = spark.createDataFrame([(f"w{i}", i) for i in range(30)], "word string, number int").withColumn(
        "number", F.col("number").cast(kind))
    out = BlockDictionaries(df, F.col("words"), "id").replaced(table, "word", "number", "numbers", F.lit(-1).cast(kind))
    cast = int if kind == "int" else str
    expected = [(i, None if ws is None else tuple(cast(w[1:] if int(w[1:]) < 30 else -1) for w in ws)) for i, ws in rows]
    assert dict(out.dtypes)["numbers"] == f"array<{kind}>"
    assert Counter((r["id"], None if r["numbers"] is None else tuple(r["numbers"])) for r in out.collect()) == Counter(expected)


def test_rows_do_not_carry_the_values(spark, pieces_of_five, monkeypatch):
    """The values meet first rows only; what replaces codes is handed on in the task."""
    plans = []
    monkeypatch.setattr(dictionaries, "stage", lambda df, name: plans.append(plan(df, "formatted")) or df)
    _, df = arrays(spark)
    BlockDictionaries(df, F.col("words"), "id").replaced(
        spark.createDataFrame([("w1", 1)], "word string, number int"), "word", "number", "numbers", F.lit(0))
    assert "MapInArrow" in plans[0] and "Join condition: (size(_entries" in plans[0]


def test_rows_behind_another_block_fail():
    """Never a wrong value: rows that do not follow their block's first row are an error."""
    batch = pa.RecordBatch.from_arrays([
        pa.array([1, 2]), pa.array([7, 8], pa.int64()), pa.array([[0, 1], [0]], pa.list_(pa.int32())),
        pa.array([[5, 6], None], pa.list_(pa.int32()))], ["id", "_block", "_codes", "_replacements"])
    with pytest.raises(pa.ArrowIndexError):
        list(dictionaries._decode(["id", "_values"], pa.int32())(iter([batch])))
