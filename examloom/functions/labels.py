"""Label replies and ids, Column -> Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.fixed_values import (
    IGNORED,
    LABEL_FAILED,
    MODEL_TURN,
    OPTION_COUNT,
    OTHER_TOPIC,
    PRIOR_KNOWLEDGE_NEEDED,
    PRIOR_KNOWLEDGE_NOT_NEEDED,
    TOPICS,
    TURN_END,
)
from examloom.functions.text import ascii_digits, last, let, strip


def clean_topic(topic) -> Column:
    """First known topic named outside brackets, else `ETC`."""
    # (?d): only \n ends a line, so brackets around U+2028 are still removed.
    bare = F.btrim(F.regexp_replace(topic, r"(?d)\(.*?\)", ""), F.lit("*"))
    return let(bare, lambda t: F.coalesce(
        *[F.when(F.contains(t, F.lit(name)), F.lit(name)) for name in TOPICS],
        F.lit(OTHER_TOPIC),
    ))


def normalize_prior_knowledge(value) -> Column:
    known = F.lit(PRIOR_KNOWLEDGE_NOT_NEEDED)
    return F.when(F.contains(value, known), known).otherwise(F.lit(PRIOR_KNOWLEDGE_NEEDED))


def id_digits(id_col) -> Column:
    """First run of digits in an id, empty when there is none."""
    return F.regexp_extract(ascii_digits(id_col), "[0-9]+", 0)


def id_number(id_col) -> Column:
    """First number in an id as double; infinity when there is none."""
    digits = id_digits(id_col)
    return F.when(digits == "", F.lit(float("inf"))).otherwise(digits.cast("double"))


def parse_label_reply(text) -> Column:
    """struct<topic, prior_knowledge_needed> from the first two reply lines.

    Each value is what stands between the first and second `: ` of its line.  If
    either is missing both are marked as failed.
    """
    def value(lines, n):
        return F.get(F.split(F.get(lines, F.lit(n)), ": "), F.lit(1))

    def labels(lines):
        topic, prior = value(lines, 0), value(lines, 1)
        complete = topic.isNotNull() & prior.isNotNull()
        failed = F.lit(LABEL_FAILED)
        return F.struct(
            F.when(complete, topic).otherwise(failed).alias("topic"),
            F.when(complete, prior).otherwise(failed).alias("prior_knowledge_needed"),
        )

    return let(F.split(text, "\n"), labels)


def completion_text(text, marker: str = MODEL_TURN) -> Column:
    """Training target: the text behind the last marker, null without one."""
    return F.when(F.contains(text, F.lit(marker)), F.substring_index(text, marker, -1))


def decode_label(text) -> Column:
    """Option index 0..4 from a decoded label; null for anything but 1..5."""
    answer = strip(F.substring_index(text, TURN_END, 1))
    options = [str(n) for n in range(1, OPTION_COUNT + 1)]
    return F.when(answer.isin(*options), answer.try_cast("int") - 1)


def completion_labels(input_ids, marker: list[int], pad_id: int | None = None) -> Column:
    """Training labels of a row of token ids: array of the same length.

    IGNORED up to the end of the last place where the ids of `marker` stand, then the ids
    themselves; all IGNORED without the marker.  Padding (`pad_id`) is ignored as well.  An
    empty marker ends nowhere.  Null ids give null labels.
    """
    if not marker:
        return F.transform(input_ids, lambda x: F.lit(IGNORED))
    ignored = F.lit(IGNORED)

    def stands_at(ids, at):
        here = F.get(ids, at) == F.lit(marker[0])
        for offset, token in enumerate(marker[1:], 1):
            here = here & (F.get(ids, at + offset) == F.lit(token))
        return here

    def end_in(ids):
        starts = F.when(
            F.size(ids) >= len(marker),
            F.filter(F.sequence(F.lit(0), F.size(ids) - len(marker)), lambda at: stands_at(ids, at)))
        return F.coalesce(last(starts) + len(marker), F.size(ids))

    def labels(ids):
        def label(token, at, end):
            trained = (at >= end) if pad_id is None else (at >= end) & (token != F.lit(pad_id))
            return F.when(trained, token).otherwise(ignored)

        return let(end_in(ids), lambda end: F.transform(ids, lambda token, at: label(token, at, end)))

    return F.when(input_ids.isNotNull(), let(input_ids, labels))
