"""CSV and Parquet edges, staging, and operators on a stream."""

import os
from types import SimpleNamespace
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from examloom.functions import labels, prompts, replies
from examloom.operators import exam as ex
from examloom.operators import messages
from examloom.schemas import CLASSIFIED_CSV, EXAM_RAW
from examloom.sources import tables


def test_read_exam_csv(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text(
        'id,paragraph,problems,question_plus\n'
        'a,"line 1\nline ""2"", end\\","{\'question\': \'Q\', \'choices\': [\'x\']}",\n'
        'b,NA,"{}",""\n', encoding="utf-8")
    rows = tables.read_exam_csv(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [
        ("a", 'line 1\nline "2", end\\', "{'question': 'Q', 'choices': ['x']}", None),
        ("b", "NA", "{}", None)]


def test_wrong_header_is_an_error(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("id,problems,paragraph,question_plus\na,b,c,d\n", encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_exam_csv(spark, str(path)).collect()


NASTY = ["plain", 'a "quoted" word', "new\nline", "comma, here", "back\\slash\\", "\\", '"', "한국어 😀", " lead", "trail ",
         "it's", "tab\there", "a\r\nb", 'end\\"']


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(str(n), t, repr({"question": t, "choices": [t]}), t)
                                for n, t in enumerate(NASTY)], EXAM_RAW)
    tables.write_csv(df, path)
    back = tables.read_exam_csv(spark, path)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_nested_columns_become_literals(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(
        [("a", "P", ("it's", ["x", 'y"\n'], 3), ""), ("b", "P", None, None)],
        "id string, paragraph string, problems struct<question:string,choices:array<string>,answer:int>,"
        "question_plus string")
    tables.write_csv(df, path)
    raw = {r["id"]: r for r in tables.read_exam_csv(spark, path).collect()}
    assert raw["a"]["problems"] == repr({"question": "it's", "choices": ["x", 'y"\n'], "answer": 3})
    assert raw["b"]["problems"] is None and raw["a"]["question_plus"] is None
    flat = ex.flatten_exam(tables.read_exam_csv(spark, path)).first()
    assert (flat["question"], flat["choices"][:2], flat["answer"]) == ("it's", ["x", 'y"\n'], 3)

    tables.write_csv(df, path, nested="json")
    flat = ex.flatten_exam(tables.read_exam_csv(spark, path), form="json").first()
    assert (flat["question"], flat["choices"][:2], flat["answer"]) == ("it's", ["x", 'y"\n'], 3)


def test_labelled_csv_schema(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame(
        [("a", "경제", "필요 없음", "P", "Q", ["x", "y"], 2, None)],
        "id string, topic string, prior_knowledge_needed string, paragraph string, question string, "
        "choices array<string>, answer int, question_plus string")
    tables.write_csv(df, path)
    row = tables.read_exam_csv(spark, path, CLASSIFIED_CSV).first()
    assert (row["choices"], row["answer"], row["question_plus"]) == ("['x', 'y']", 2, None)
    nested = ex.nest_problems(tables.read_exam_csv(spark, path, CLASSIFIED_CSV)).first()
    assert nested["problems"]["choices"] == ["x", "y"]


def test_write_table_overwrites(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (5, 3):
        tables.write_table(spark.range(n), path)
    assert spark.read.parquet(path).count() == 3


def test_stage_uses_the_checkpoint_folder(spark):
    df = spark.range(10).select("id", F.array(F.struct("id")).alias("nested"))
    staged = tables.stage(df)
    folder = spark.conf.get("spark.checkpoint.dir")
    assert all(os.path.realpath(urlparse(f).path).startswith(os.path.realpath(folder))
               for f in staged.inputFiles())
    assert staged.dtypes == df.dtypes and staged.count() == 10


def test_scratch_folder():
    conf = {"spark.sql.warehouse.dir": "hdfs:///warehouse"}
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)),
        sparkContext=SimpleNamespace(getCheckpointDir=lambda: None))
    assert tables.scratch_path(cluster, "x").startswith("hdfs:///warehouse/x-")
    conf["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert tables.scratch_path(cluster, "x").startswith("hdfs:///shared/x-")
    del tables._STAGED[-2:]


def test_staged_tables_go_when_the_results_are_written(spark, tmp_path):
    with tables.staging(spark):
        staged = tables.stage(spark.range(5))
        folder = os.path.dirname(urlparse(staged.inputFiles()[0]).path)
        tables.write_table(staged, str(tmp_path / "t"))
        assert os.path.isdir(folder)
    assert not os.path.exists(folder) and spark.read.parquet(str(tmp_path / "t")).count() == 5


def test_row_operators_run_on_a_stream(spark, tmp_path):
    """Parsing, cleaning and rendering need no state, so a stream works as it is."""
    source = str(tmp_path / "in")
    reply = "질문 : Q\n선택지:\n1. a\n2. b\n3. c\n4. d\n5. e\n정답: 2"
    spark.createDataFrame([("a", "P", reply, "주제: 경제\n사전지식 필요: 필요 없음")],
                          "id string, paragraph string, reply string, label string").write.parquet(source)
    stream = spark.readStream.schema("id string, paragraph string, reply string, label string").parquet(source)
    parsed = stream.select(
        "id", "paragraph", F.lit(None).cast("string").alias("question_plus"),
        F.inline(F.array(replies.parse_korean_reply(F.col("reply")))),
        labels.parse_label_reply(F.col("label"))["topic"].alias("topic"))
    text = messages.train_messages(parsed).withColumn("text", prompts.render_chat(F.col("messages")))
    query = text.select("id", "text").writeStream.format("memory").queryName("chat").start()
    try:
        query.processAllAvailable()
        rows = spark.table("chat").collect()
    finally:
        query.stop()
    assert len(rows) == 1 and rows[0]["text"].endswith("<start_of_turn>model\n2<end_of_turn>\n")


def test_written_csv_files_are_bounded(spark, tmp_path):
    """One task reads a whole file, so a large partition is written as several files."""
    rows = spark.range(0, 12_001, 1, 1).selectExpr(
        "cast(id AS string) AS id", "concat('a\\n\"b\" ', id) AS paragraph", "'{}' AS problems", "'' AS question_plus")
    tables.write_csv(rows, str(tmp_path / "csv"))
    assert len(list((tmp_path / "csv").glob("*.csv"))) == 3
    back = tables.read_exam_csv(spark, str(tmp_path / "csv"))
    assert back.select("id", "paragraph").exceptAll(rows.select("id", "paragraph")).count() == 0
    assert back.count() == 12_001
