"""Option scores to answers, Column -> Column."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.fixed_values import OPTION_COUNT, SEED
from examloom.functions.text import let


def option_logits(logits, count) -> Column:
    """Scores of the first `count` options (int or Column)."""
    return F.slice(logits, F.lit(1), F.lit(count) if isinstance(count, int) else count)


def logits_at(logits, positions) -> Column:
    """Scores at the given 0-based vocabulary positions (array column)."""
    return F.transform(positions, lambda p: F.get(logits, p))


def sequence_position(attention_mask, from_end: int = 1) -> Column:
    """0-based place of the last attended token of a right-padded row, or of the one `from_end - 1`
    places before it; null where the row has no such token."""
    ends = F.size(attention_mask) - F.array_position(F.reverse(attention_mask), F.lit(1)).cast("int")
    place = F.when(F.array_contains(attention_mask, F.lit(1)), ends - (from_end - 1))
    return F.when(place >= 0, place)


def sequence_logits(logits, attention_mask, options, from_end: int = 1) -> Column:
    """Scores of the option tokens (0-based vocabulary places) from scores per place and vocabulary.

    `from_end` 1 reads the last attended token, as scoring a prompt does; 2 the one before, as
    evaluation does while training, where the turn's end follows the answer.  A row that is too
    short, or has no scores at that place, gives null.
    """
    place = sequence_position(attention_mask, from_end)
    return let(F.get(logits, place), lambda scores: F.when(scores.isNotNull(), logits_at(scores, options)))


def softmax(scores) -> Column:
    """Probabilities over an array of scores, shifted by the maximum."""
    def normalised(exps):
        total = F.aggregate(exps, F.lit(0.0), lambda a, x: a + x)
        return let(total, lambda s: F.transform(exps, lambda x: x / s))

    return let(
        scores.cast("array<double>"),
        lambda xs: let(
            F.array_max(xs),
            lambda top: let(F.transform(xs, lambda x: F.exp(x - top)), normalised)))


def argmax(values) -> Column:
    """0-based index of the first maximum; NaN counts as the largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def seeded_option(id_col, seed: int = SEED) -> Column:
    """Pseudo-random option `1`..`5` that depends on the id and seed alone."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), id_col))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return (number % OPTION_COUNT + 1).cast("string")


def predict_answer(index, id_col, seed: int = SEED) -> Column:
    """Answer text of an option index; the sentinel option becomes a seeded guess."""
    return (
        F.when(index < OPTION_COUNT, (index + 1).cast("string"))
        .when(index == OPTION_COUNT, seeded_option(id_col, seed))
    )
