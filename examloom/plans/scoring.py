"""Score test questions from a table of option scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.fixed_values import SEED
from examloom.functions.scoring import argmax, option_logits, predict_answer, softmax
from examloom.operators.joins import join_by_id
from examloom.operators.messages import render_chat, test_messages
from examloom.sources.tables import stage


def predict(questions: DataFrame, logits: DataFrame, seed: int = SEED) -> DataFrame:
    """id, answer for test questions (`test_messages` output) with logits by id.

    A question without logits keeps its row with a null answer.  An id with several
    rows of logits is scored by the least of them, element by element, whatever their
    order; they are reduced on the map side.  Ids and option counts are staged, so the
    questions are parsed once although the join looks at the ids twice.
    """
    asked = stage(questions.select("id", "len_choices"), "questions")
    scored = join_by_id(asked, logits.groupBy("id").agg(F.min("logits").alias("logits")))
    best = argmax(softmax(option_logits(F.col("logits"), F.col("len_choices"))))
    return scored.select("id", predict_answer(best, F.col("id"), seed).alias("answer"))


def test_chat(exam: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """id, chat text that asks for the answer, len_choices: what a model is given to get
    the logits of `predict`."""
    return render_chat(test_messages(exam, templates)).select("id", "text", "len_choices")


def score_test(exam: DataFrame, logits: DataFrame, seed: int = SEED) -> DataFrame:
    """id, answer straight from the flat test questions."""
    return predict(test_messages(exam), logits, seed)
