"""Tables of model replies.  DataFrame -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.fixed_values import MAX_ATTEMPTS, OPTION_COUNT
from examloom.functions.labels import decode_label
from examloom.functions.replies import parse_bold_reply, parse_korean_reply, valid_generation
from examloom.functions.text import once


def parse_generation_bold(df: DataFrame, text: str = "text", into: str = "parsed") -> DataFrame:
    return df.select("*", once(parse_bold_reply(F.col(text))).alias(into))


def parse_generation_ko(df: DataFrame, text: str = "text", into: str = "parsed",
                        strip_label: bool = False) -> DataFrame:
    return df.select("*", once(parse_korean_reply(F.col(text), strip_label)).alias(into))


def decode_labels(df: DataFrame, text: str = "text", into: str = "option",
                  ) -> tuple[DataFrame, DataFrame]:
    """(rows with their option index, rows whose label is not one of the options)."""
    decoded = df.select("*", once(decode_label(F.col(text))).alias(into))
    return decoded.filter(F.col(into).isNotNull()), decoded.filter(F.col(into).isNull()).drop(into)


def first_by_attempt(rows: DataFrame, *columns: str) -> DataFrame:
    """id, attempt and the columns of each id's lowest attempt; ties by content.

    Reduced on the map side first, so a hot id costs one row per task.
    """
    first = F.min(F.struct("attempt", *columns))
    return rows.groupBy("id").agg(first.alias("first")).select("id", "first.*")


def first_valid_attempt(responses: DataFrame, parse=parse_korean_reply,
                        exact_choices: int | None = OPTION_COUNT,
                        max_attempts: int = MAX_ATTEMPTS, text: str = "text") -> DataFrame:
    """id, attempt, question, choices, answer of each id's first usable reply.

    Unusable replies and the reply texts disappear before the shuffle.
    """
    return first_by_attempt(usable_replies(responses, parse, exact_choices, max_attempts, text),
                            "question", "choices", "answer")


def usable_replies(responses: DataFrame, parse=parse_korean_reply,
                   exact_choices: int | None = OPTION_COUNT,
                   max_attempts: int = MAX_ATTEMPTS, text: str = "text") -> DataFrame:
    """id, attempt, question, choices, answer of every usable reply."""
    # The generator takes the expression itself: each reply is parsed once (`once`).
    usable = F.filter(
        F.array(parse(F.col(text))), lambda p: valid_generation(p, exact_choices))
    return responses.filter(F.col("attempt") <= max_attempts).select(
        "id", "attempt", F.inline(usable))
