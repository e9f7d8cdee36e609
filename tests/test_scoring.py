"""Scores, answers, accuracy and reports."""

import math

import pytest
from pyspark.sql import functions as F

from checks import compare
from checks.registry import ORACLES, QUERIES
from examloom.functions import scoring
from examloom.operators import metrics
from examloom.plans.scoring import predict
from examloom.schemas import METRIC_LOG
from examloom.sources.reports import write_epoch_report
from tests.helpers import evaluate

NAN = float("nan")


def test_softmax(spark):
    rows = evaluate(spark, scoring.softmax, [[1.0, 2.0, 3.0], [1e6, 0.0], [5.0]], "array<double>")
    total = sum(math.exp(x) for x in (1, 2, 3))
    assert [round(p, 12) for p in rows[0]] == [round(math.exp(x) / total, 12) for x in (1, 2, 3)]
    assert rows[1:] == [[1.0, 0.0], [1.0]]


def test_softmax_sums_to_one(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    total = F.aggregate(scoring.softmax(F.col("embedding")), F.lit(0.0), lambda a, x: a + x)
    assert df.filter(F.abs(total - 1) > 1e-12).count() == 0


def test_argmax(spark):
    assert evaluate(spark, scoring.argmax, [[1.0, 3.0, 3.0], [1.0, NAN, 2.0, NAN], [-1.0]],
                    "array<double>") == [1, 1, 0]


def test_option_logits(spark):
    assert evaluate(spark, lambda c: scoring.option_logits(c, 2), [[1.0, 2.0, 3.0], [1.0]],
                    "array<double>") == [[1.0, 2.0], [1.0]]
    picked = evaluate(spark, lambda c: scoring.logits_at(c, F.array(F.lit(2), F.lit(0))),
                      [[1.0, 2.0, 3.0]], "array<double>")
    assert picked == [[3.0, 1.0]]


def test_predict_answer(spark):
    got = evaluate(spark, lambda c: scoring.predict_answer(c, F.lit("q1")), [0, 3, 4, None], "int")
    assert got == ["1", "4", "5", None]
    ids = [f"q{n}" for n in range(400)]
    guesses = evaluate(spark, lambda c: scoring.predict_answer(F.lit(5), c), ids)
    assert guesses == evaluate(spark, lambda c: scoring.predict_answer(F.lit(5), c), ids)
    assert set(guesses) == {"1", "2", "3", "4", "5"}
    assert guesses != evaluate(spark, lambda c: scoring.predict_answer(F.lit(5), c, 7), ids)


def test_predict_keeps_questions_without_logits(spark):
    questions = spark.createDataFrame([("a", 5), ("b", 6), ("c", 5)], "id string, len_choices int")
    logits = spark.createDataFrame(
        [("a", [0.0, 1.0, 0.0, 0.0, 0.0, 9.0]), ("b", [0.0, 0.0, 0.0, 2.0, 0.0, 0.0])],
        "id string, logits array<double>")
    assert {r["id"]: r["answer"] for r in predict(questions, logits).collect()} == {
        "a": "2", "b": "4", "c": None}


def test_accuracy(spark):
    df = spark.createDataFrame(
        [("x", 1, 1), ("x", 2, 1), ("y", 3, 3), ("y", None, 3)], "run string, prediction int, label int")
    assert tuple(metrics.accuracy(df).first()) == (0.5, 4)
    by = metrics.accuracy(df, "prediction", "label", "run").orderBy("run").collect()
    assert [tuple(r) for r in by] == [("x", 0.5, 2), ("y", 0.5, 2)]


def log(spark, *rows):
    return spark.createDataFrame(list(rows), METRIC_LOG)


def test_epoch_report(spark, tmp_path):
    df = log(
        spark,
        ("r", 1, "evaluate", 0.5, None, 0.9, 0.1),
        ("r", 2, "log", 1.0, 0.5, None, None),
        ("r", 3, "log", 1.0, None, None, None),
        ("r", 4, "evaluate", 1.0, None, 0.25, 0.75),
        ("r", 250_000, "evaluate", 2.9, None, 0.2, 0.8),
        ("r", 250_001, "log", 3.0, 0.125, None, None),
        ("r", 250_002, "evaluate", None, 99.0, 0.1, 0.9),
        ("s", 5, "evaluate", 1.0, None, 0.5, 0.5),
    )
    report = metrics.epoch_report(df)
    assert [tuple(r) for r in report.orderBy("run", "step").collect()] == [
        ("r", 1, "0", None, 0.9, 0.1), ("r", 4, "1", 0.5, 0.25, 0.75),
        ("r", 250_000, "2", 0.5, 0.2, 0.8), ("r", 250_002, "N/A", 0.125, 0.1, 0.9),
        ("s", 5, "1", None, 0.5, 0.5)]

    path = str(tmp_path / "report")
    for _ in range(2):
        write_epoch_report(report.filter("run = 'r' AND step IN (1, 4)"), path, "step")
    lines = [r["value"] for r in spark.read.text(path).collect()]
    block = ["Epoch : 1,", "Training Loss : 0.500000,", "Validation Loss : 0.250000,",
             "Accuracy : 0.750000", "#" * 25]
    assert lines.count("Training Loss : None,") == 2
    assert sum(lines[n:n + 5] == block for n in range(len(lines))) == 2


def test_log_and_evaluation_at_one_step(spark, conf):
    """The log counts first, whatever the order of the input, also over chunk borders."""
    rows = [("r", 1, "log", 1.0, 9.0, None, None), ("r", 2, "evaluate", 1.0, None, 0.5, 0.5),
            ("r", 2, "log", 1.0, 1.25, None, None), ("r", 3, "evaluate", 2.0, None, 0.5, 0.5),
            ("r", None, "evaluate", 0.0, None, 0.5, 0.5), ("r", None, "log", 0.0, 7.0, None, None),
            ("r", 4, "log", 2.0, 3.0, None, None), ("r", 4, "log", 2.0, 2.0, None, None),
            ("r", 4, "evaluate", 2.0, None, 0.5, 0.5)]
    expected = [(None, 7.0), (2, 1.25), (3, 1.25), (4, 3.0)]
    for partitions in ("1", "8"):
        conf("spark.sql.shuffle.partitions", partitions)
        for given in (rows, rows[::-1]):
            report = metrics.epoch_report(log(spark, *given)).orderBy("step")
            assert [(r["step"], r["training_loss"]) for r in report.collect()] == expected


def test_one_run_is_handled_in_chunks(spark, conf):
    """A run that holds all rows is cut into chunks, with the same result."""
    df = spark.range(5_000).select(
        F.lit("r").alias("run"), F.col("id").alias("step"),
        F.when(F.col("id") % 7 == 3, "evaluate").otherwise("log").alias("event"),
        (F.col("id") / 100).alias("epoch"),
        F.when(F.col("id") % 1000 < 40, F.col("id").cast("double")).alias("loss"),
        F.lit(0.5).alias("eval_loss"), F.lit(0.5).alias("eval_accuracy"))
    logged = [n for n in range(5_000) if n % 1000 < 40 and n % 7 != 3]
    expected = [float(max((n for n in logged if n < step), default=-1))
                for step in range(3, 5_000, 7)]

    def losses(report):
        return [r["training_loss"] for r in report.orderBy("step").collect()]

    assert losses(metrics.epoch_report(df)) == expected
    conf("spark.sql.adaptive.enabled", "false")
    for partitions in ("1", "3", "40"):
        conf("spark.sql.shuffle.partitions", partitions)
        report = metrics.epoch_report(df)
        assert losses(report) == expected
    tasks = {r["task"] for r in report.withColumn("task", F.spark_partition_id()).collect()}
    assert len(tasks) > 10


@pytest.mark.parametrize("name", ["m1_option_logits", "m1_sequence_logits", "m1_logits_at"])
def test_tiny_negative_scores(spark, tmp_path, name):
    """A negative score that rounds to nothing keeps its sign, as in the query's SQL."""
    odd = [-3e-7, -0.0, 0.0, 3e-7, -4e-7, .0078125, -.0078125, 1.5, -2.25, -1e-8, -3e-7, -5e-7]
    rows = [(i, odd[i % 12:] + odd[:i % 12], i % 5) for i in range(24)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label long").coalesce(1).write.parquet(
        str(tmp_path / "new"))
    (path,) = (tmp_path / "new").glob("*.parquet")
    path.rename(tmp_path / "embeddings.parquet")
    import checks.queries  # noqa: F401  (registers on import)
    result = QUERIES[name](spark, str(tmp_path))
    con = compare.connect(str(tmp_path))
    assert compare.difference(result, con, ORACLES[name]) is None
    expected = con.execute(ORACLES[name] + " ORDER BY vec_id").fetchall()
    assert list(map(repr, expected)) == [repr(tuple(r)) for r in result.orderBy("vec_id").collect()]
