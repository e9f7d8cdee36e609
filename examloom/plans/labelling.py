"""Label exam questions from model replies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions.labels import clean_topic, normalize_prior_knowledge, parse_label_reply
from examloom.operators.exam import parse_problems, quarantine, sort_by_id_number
from examloom.operators.joins import join_by_id
from examloom.operators.replies import first_by_attempt
from examloom.sources.tables import stage


LABEL_SOURCE = "label"  # value of `source` in the table of replies


def reply_labels(responses: DataFrame) -> DataFrame:
    """id, topic and prior_knowledge_needed as each id's first label reply states them.

    Replies shrink to their two labels before the shuffle, and to one row per id
    on the map side.
    """
    replies = responses.filter((F.col("source") == LABEL_SOURCE) & F.col("text").isNotNull())
    parsed = replies.select(
        "id", "attempt", F.inline(F.array(parse_label_reply(F.col("text")))))
    return first_by_attempt(parsed, "topic", "prior_knowledge_needed").drop("attempt")


def flag_labels(exam: DataFrame, responses: DataFrame, form: str = "python") -> DataFrame:
    """Raw exam rows with raw labels and the `reason` a row is unusable, if any.

    The exam is read and parsed once, into a staged table; its ids are counted there.
    """
    parsed = stage(parse_problems(exam, form=form).select("id", "paragraph", "p", "question_plus"), "parsed")
    joined = join_by_id(parsed, reply_labels(responses))
    reason = (
        F.when(F.col("p").isNull(), F.lit("unreadable problem"))
        .when(F.col("p.answer").isNull(), F.lit("no answer"))
        .when(F.col("topic").isNull(), F.lit("no reply"))
    )
    return joined.select(
        "id", "topic", "prior_knowledge_needed", "paragraph",
        "p.question", "p.choices", "p.answer", "question_plus", reason.alias("reason"),
    )


def label_exam(exam: DataFrame, responses: DataFrame, form: str = "python",
               ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(raw labels, cleaned labels in id order, rejected rows).

    Each of them joins the staged questions with the labels; used in one query, they share
    the shuffle of that join.
    """
    flagged = flag_labels(exam, responses, form)
    usable, rejected = quarantine(flagged)
    return usable, clean_labels(usable), rejected.select("id", "paragraph", "reason")


def clean_labels(raw: DataFrame) -> DataFrame:
    cleaned = raw.withColumns({
        "topic": clean_topic(F.col("topic")),
        "prior_knowledge_needed": normalize_prior_knowledge(F.col("prior_knowledge_needed")),
    })
    return sort_by_id_number(cleaned)
