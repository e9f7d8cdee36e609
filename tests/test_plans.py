"""Compositions on small hand-made tables, and behaviour under skew."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from examloom.operators import joins
from examloom.operators.exam import parse_problems
from examloom.plans import augmenting, labelling, scoring, training
from examloom.schemas import EXAM_RAW, RESPONSES
from tests.helpers import plan

BOLD = "**New Question:** N\n**New Choices:**\n1. a\n\n**New Answer:** 1"
PROBLEM = "{'question': 'Q', 'choices': ['x', 'y', 'z', 'v'], 'answer': 1}"


def exam(spark, *ids):
    return spark.createDataFrame([(i, f"paragraph {i}", PROBLEM, None) for i in ids], EXAM_RAW)


def test_label_exam(spark):
    rows = exam(spark, "q2", "q10", "q1", "none").union(spark.createDataFrame(
        [("q3", "p", "broken", None), ("q4", "p", "{'question': 'Q', 'choices': []}", None)], EXAM_RAW))
    replies = spark.createDataFrame([
        ("q2", "label", 1, "주제: **경제(a)**\n사전지식 필요: 필요 없음"),
        ("q10", "label", 1, ""), ("q1", "label", 2, "주제: x\n사전지식: 필요"),
        ("q1", "label", 1, "주제: 문학\n사전지식: 필요 없음"), ("other", "label", 1, "x"),
        ("none", "bold", 1, "주제: 문학\n사전지식: 필요 없음")], RESPONSES)
    raw, cleaned, rejected = labelling.label_exam(rows, replies)
    assert {r["id"]: r["topic"] for r in raw.collect()} == {
        "q2": "**경제(a)**", "q10": "분류 실패", "q1": "문학"}
    assert [(r["id"], r["topic"], r["prior_knowledge_needed"]) for r in cleaned.collect()] == [
        ("q1", "문학", "필요 없음"), ("q2", "경제", "필요 없음"), ("q10", "ETC", "필요함")]
    assert {r["id"]: r["reason"] for r in rejected.collect()} == {
        "none": "no reply", "q3": "unreadable problem", "q4": "no answer"}


def test_augment_and_merge(spark):
    labelled = spark.createDataFrame(
        [(i, "경제", "필요 없음" if i != "c" else "필요함", f"{i} " * 200, "Q", ["x"], 1, "plus")
         for i in "abc"],
        "id string, topic string, prior_knowledge_needed string, paragraph string, question string, "
        "choices array<string>, answer bigint, question_plus string")
    sources = augmenting.select_sources(labelled)
    assert sources.columns == [
        "id", "topic", "prior_knowledge_needed", "paragraph", "question_plus", "problems"]
    replies = spark.createDataFrame([
        ("a", "bold", 1, "**New Question:** N\n**New Choices:**\n1. a\n\n**New Answer:** 1"),
        ("b", "bold", 1, "nothing"),
        ("b", "bold", 2, "**New Question:** N\n**New Choices:**\n1. a\n\n**New Answer:** 1"),
        ("c", "bold", 1, "**New Question:** N\n**New Choices:**\n1. a\n\n**New Answer:** 1")], RESPONSES)
    new, failed = augmenting.augment(sources, replies, "bold")
    assert [(r["id"], r["problems"]["question"], r["question_plus"]) for r in new.collect()] == [
        ("a_aug", "N", "")]
    assert failed.columns == sources.columns and [r["id"] for r in failed.collect()] == ["b"]
    train = sources.select("id", "paragraph", "problems", "question_plus")
    final = augmenting.build_train_table(train, new, new)
    assert sorted(r["id"] for r in final.collect()) == ["a", "a_aug", "a_aug", "b"]


def test_parsed_train_rows_merge_with_new_rows(spark):
    """The parsed train struct has one more field; it is null in the new rows."""
    train = parse_problems(exam(spark, "a").withColumn("paragraph", F.repeat(F.lit("p"), 300)),
                           into="parsed").select("id", "paragraph", F.col("parsed").alias("problems"))
    new = spark.createDataFrame(
        [("b_aug", "p" * 300, ("N", ["x"], 2), "")],
        "id string, paragraph string, problems struct<question:string,choices:array<string>,answer:bigint>, "
        "question_plus string")
    rows = augmenting.build_train_table(train, new).orderBy("id").collect()
    assert [(r["id"], r["problems"]["question"], r["problems"]["question_plus"], r["question_plus"])
            for r in rows] == [("a", "Q", None, None), ("b_aug", "N", None, "")]


def test_repeated_ids_keep_every_source_row(spark):
    """A third of all source rows share one id; each keeps its row and its reply."""
    sources = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.col("id").cast("string").alias("paragraph"))
    replies = sources.select("id").distinct().select(
        "id", F.lit("bold").alias("source"), F.lit(1).alias("attempt"),
        F.lit("**New Question:** N\n**New Choices:**\n1. a\n\n**New Answer:** 1").alias("text"))
    new, failed = augmenting.augment(sources, replies, "bold")
    assert new.count() == 3_000 and new.filter("id = 'hot_aug'").count() == 1_000
    assert failed.count() == 0


def hot_left(spark):
    return spark.range(0, 30_000, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 5_000).cast("string")).alias("id"),
        F.col("id").alias("n"))


def groups(df):
    return {r["id"]: r["groups"] for r in df.collect()}


def test_hot_keys(spark):
    """Hot is what holds more than an average task; 8 tasks share 30,000 rows here."""
    assert groups(joins.hot_keys(hot_left(spark), "id")) == {"hot": 3}
    assert groups(joins.hot_keys(spark.range(20_000), "id")) == {}
    assert groups(joins.hot_keys(spark.range(0), "id")) == {}


def test_many_hot_keys(spark, conf):
    """No number of hot keys is too many: 2,000 keys hold nearly all rows."""
    conf("spark.sql.shuffle.partitions", "4000")
    conf("spark.sql.adaptive.coalescePartitions.enabled", "true")
    left = spark.range(40_000).select(
        F.when(F.col("id") < 39_000, F.col("id") % 2_000).otherwise(F.col("id")).cast("string").alias("id"))
    assert len(groups(joins.hot_keys(left, "id"))) == 2_000


@pytest.mark.parametrize("inputs", [1, 16])
@pytest.mark.parametrize("hot", ["hot", None])
def test_hot_id_is_spread_over_tasks(spark, conf, hot, inputs):
    """A third of the left rows share one id (or have none), also in one input partition."""
    conf("spark.sql.adaptive.enabled", "false")
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = hot_left(spark).withColumn("id", F.when(F.col("id") == "hot", F.lit(hot)).otherwise(F.col("id")))
    if inputs == 1:  # all rows of the hot id in one input partition
        is_hot = F.col("id").eqNullSafe(F.lit(hot))
        left = left.filter(is_hot).coalesce(1).union(left.filter(~is_hot))
    right = left.select("id").distinct().filter("id <> '7'").withColumn("reply", F.upper("id"))
    salted = joins.join_by_id(left, right)
    assert salted.columns == ["id", "n", "reply"]
    plain = left.join(right, "id", "left")
    assert Counter(map(tuple, salted.collect())) == Counter(map(tuple, plain.collect()))

    def tasks_of_hot_rows(df):
        rows = df.withColumn("task", F.spark_partition_id()).collect()
        return {r["task"] for r in rows if r["id"] == hot}

    assert len(tasks_of_hot_rows(plain)) == 1
    assert len(tasks_of_hot_rows(salted)) > 1


def test_all_variants_take_one_join(spark, conf, tmp_path):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    wide = spark.range(500).select(F.concat(F.lit("q"), "id").alias("id"), F.lit("wide").alias("paragraph"))
    path = str(tmp_path / "wide")
    wide.write.parquet(path)
    replies = spark.createDataFrame([("q1", "bold", 1, BOLD), ("q1", "korean", 1, "x"), ("q2", "korean", 1, "x")], RESPONSES)
    accepted = augmenting.accepted_replies(replies)
    assert accepted.columns == ["id", "_bold", "_korean"]
    text = plan(joins.join_by_id(spark.read.parquet(path), accepted))
    assert text.count("SortMergeJoin") <= 1 + text.count("BroadcastHashJoin")
    made = augmenting.augment_all(spark.read.parquet(path), replies)
    assert {v: (new.count(), failed.count()) for v, (new, failed) in made.items()} == {
        "bold": (1, 499), "korean": (0, 500)}


def test_one_row_of_logits_per_id(spark):
    asked = spark.createDataFrame([("a", 2), ("b", 2), (None, 2)], "id string, len_choices int")
    rows = [("a", [0.0, 1.0]), ("a", [1.0, 0.0]), ("c", [1.0, 0.0])]
    for given in (rows, rows[::-1]):
        logits = spark.createDataFrame(given, "id string, logits array<double>")
        out = Counter(map(tuple, scoring.predict(asked, logits).collect()))
        assert out == Counter([("a", "2"), ("b", None), (None, None)])


def test_build_train_eval(spark):
    flat = spark.range(200).select(
        F.concat(F.lit("q"), "id").alias("id"),
        F.when(F.col("id") < 20, F.repeat(F.lit("word "), 1100)).otherwise("short text").alias("paragraph"),
        F.lit("Q").alias("question"), F.array(F.lit("x")).alias("choices"),
        F.lit(1).alias("answer"), F.lit("").alias("question_plus"))
    rows = training.build_train_eval(training.exam_features(flat))
    assert rows.count() == 180 and rows.filter("is_eval").count() == 18

    def load():
        return lambda texts: [list(range(len(t))) for t in texts]

    coded = training.build_train_eval(flat, load_tokenizer=load)
    assert coded.count() == 180 and "input_ids" in coded.columns
