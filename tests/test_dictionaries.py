"""Block dictionaries: arrays through a table of any size, decoding, token labels, sequence scores."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from examloom.fixed_values import IGNORED, MODEL_TURN
from examloom.functions.labels import completion_labels
from examloom.functions.scoring import sequence_logits
from examloom.operators import dictionaries, features
from examloom.operators.dictionaries import BlockDictionaries
from tests.helpers import evaluate, plan


@pytest.fixture()
def small_blocks(monkeypatch):
    monkeypatch.setattr(dictionaries, "BLOCK_ROWS", 4)
    monkeypatch.setattr(dictionaries, "BLOCK_ELEMENTS", 30)


def arrays(spark, n=60, seed=1):
    rng = random.Random(seed)
    rows = [(i % 50, None if i % 11 == 0 else [f"w{rng.randrange(1, 40)}" for _ in range(rng.choice([0, 1, 5, 40]))])
            for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, words array<string>").repartition(3)


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_replaced(spark, small_blocks, conf, partitions):
    conf("spark.sql.shuffle.partitions", partitions)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows, df = arrays(spark)
    table = spark.createDataFrame([(f"w{i}", i) for i in range(30)], "word string, number int")
    blocks = BlockDictionaries(df, F.col("words"), "id")
    assert {r["entry"]: r["n"] for r in blocks.totals().collect()} == Counter(w for _, ws in rows for w in ws or ())
    out = blocks.replaced(table, "word", "number", "numbers", F.lit(-1))
    expected = [(i, None if ws is None else tuple(int(w[1:]) if int(w[1:]) < 30 else -1 for w in ws)) for i, ws in rows]
    found = [(r["id"], None if r["numbers"] is None else tuple(r["numbers"])) for r in out.collect()]
    assert Counter(found) == Counter(expected)


def test_rows_are_not_shuffled(spark, conf, monkeypatch):
    """The rows' codes and key columns meet the dictionaries without an exchange."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    plans = []
    monkeypatch.setattr(dictionaries, "stage", lambda df, name: plans.append(plan(df)) or df)
    _, df = arrays(spark)
    table = spark.createDataFrame([("w1", 1)], "word string, number int")
    BlockDictionaries(df.withColumn("text", F.lit("t")), F.col("words"), "id", "text").replaced(
        table, "word", "number", "numbers", F.lit(0))
    exchanges = [line for line in plans[0].splitlines() if "Exchange" in line]
    below = plans[0][plans[0].index("ShuffledHashJoin"):]
    left = below.splitlines()[1:]
    assert exchanges and "Bucketed: true" in plans[0]
    assert not any("_codes" in line or "text" in line for line in exchanges)
    # From the join down to the scan of the rows there is neither exchange nor sort.
    upper = "\n".join(left[:next(i for i, line in enumerate(left) if "FileScan" in line) + 1])
    assert "Exchange" not in upper and "Sort" not in upper


def test_one_table_is_left(spark):
    _, df = arrays(spark)
    before = len(spark.catalog.listTables())
    features.tokenize(df.select("id", F.array_join("words", " ").alias("text")), "id").count()
    assert len(spark.catalog.listTables()) == before


def test_detokenize(spark, small_blocks):
    texts = ["The cat sat", "", None, "cat cat dog 한국어", "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    coded, ids = features.tokenize_with_ids(docs, "id")
    padded = coded.select("id", F.when(F.col("input_ids").isNotNull(), F.concat(
        F.array(F.lit(IGNORED), F.lit(0)), "input_ids", F.array(F.lit(99_999), F.lit(0)))).alias("input_ids"))
    out = {r["id"]: r["text"] for r in features.detokenize(padded, ids, "id").collect()}
    assert out == {i: None if t is None else " ".join(re.findall(r"\w{2,}", t.lower())) for i, t in enumerate(texts)}


def brute_labels(ids, marker, pad_id=None):
    if ids is None:
        return None
    ends = [i + len(marker) for i in range(len(ids) - len(marker) + 1) if ids[i:i + len(marker)] == marker]
    end = ends[-1] if ends and marker else len(ids)
    return [x if i >= end and x != pad_id else IGNORED for i, x in enumerate(ids)]


@pytest.mark.parametrize("marker", [[1, 2], [1], [1, 1, 2], [7, 8], []])
@pytest.mark.parametrize("pad_id", [None, 0])
def test_completion_labels(spark, marker, pad_id):
    rng = random.Random(4)
    rows = [None, [], [1], [1, 2], [2, 1, 2, 3, 0, 0], [1, 1, 1, 2], [1, 2, 1, 2, 5, 1]]
    rows += [[rng.randrange(4) for _ in range(rng.randrange(20))] for _ in range(40)]
    found = evaluate(spark, lambda c: completion_labels(c, marker, pad_id), rows, "array<int>")
    assert found == [brute_labels(r, marker, pad_id) for r in rows]


def test_marker_of_no_text_stands_nowhere(spark):
    docs = spark.createDataFrame([("a", "one two"), ("b", f"one {MODEL_TURN} two")], "id string, text string")
    coded, ids = features.tokenize_with_ids(docs, "id")
    rows = {r["id"]: r["labels"] for r in features.add_completion_labels(coded, ids).collect()}
    assert rows["a"] == [IGNORED] * 2 and rows["b"][:3] == [IGNORED] * 3 and rows["b"][3] > 0
    none = features.add_completion_labels(coded, ids, marker=["nowhere", "one"]).collect()
    assert all(set(r["labels"]) == {IGNORED} for r in none)


def test_sequence_logits(spark):
    places = [[10.0 * p + v for v in range(4)] for p in range(5)]
    rows = [([1, 1, 1, 0, 0], 2, 1), ([1, 0, 0, 0, 0], 0, None), ([0] * 5, None, None), ([1] * 5, 4, 3), ([], None, None),
            ([1] * 7, None, None)]
    for from_end, at in ((1, 1), (2, 2)):
        found = evaluate(spark, lambda m: sequence_logits(
            F.array(*[F.array(*map(F.lit, p)) for p in places]), m, F.array(F.lit(1), F.lit(3)), from_end),
            [r[0] for r in rows], "array<int>")
        assert found == [None if r[at] is None else [places[r[at]][1], places[r[at]][3]] for r in rows]


def test_decoded_words_are_staged_as_text(spark, monkeypatch):
    """Neither arrays of words nor a second pass over them."""
    docs = spark.createDataFrame([(0, "one two two"), (1, None), (2, "")], "id int, text string")
    coded, ids = features.tokenize_with_ids(docs, "id")
    schemas, stage = [], dictionaries.stage
    monkeypatch.setattr(dictionaries, "stage", lambda df, name: schemas.append(df.dtypes) or stage(df, name))
    out = features.detokenize(coded, ids, "id")
    assert schemas == [[("id", "int"), ("text", "string")]]
    assert {r["id"]: r["text"] for r in out.collect()} == {0: "one two two", 1: None, 2: ""}
