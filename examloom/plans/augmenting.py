"""New questions from model replies, and the merged training table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.fixed_values import MAX_ATTEMPTS, OPTION_COUNT
from examloom.functions.replies import parse_bold_reply, parse_korean_reply
from examloom.operators.exam import (
    drop_problem_parts,
    filter_min_length,
    filter_no_prior_knowledge,
    make_augmented_rows,
    merge_sources,
    nest_problems,
)
from examloom.operators.joins import join_by_id
from examloom.operators.replies import usable_replies
from examloom.sources.tables import stage

# `source` in the table of replies -> how these replies are read and accepted.
VARIANTS = {
    "bold": dict(parse=parse_bold_reply, exact_choices=None, max_attempts=1),
    "korean": dict(parse=parse_korean_reply, exact_choices=OPTION_COUNT,
                   max_attempts=MAX_ATTEMPTS),
}


def select_sources(labelled: DataFrame) -> DataFrame:
    """Labelled questions that need no prior knowledge, re-nested."""
    return drop_problem_parts(nest_problems(filter_no_prior_knowledge(labelled)))


def accepted_replies(responses: DataFrame, variants: tuple[str, ...] = tuple(VARIANTS)) -> DataFrame:
    """id and, per variant, a struct of the first usable reply: one row per id.

    Each reply is parsed as its variant asks, before the only shuffle, and reduced on
    the map side.
    """
    usable = [usable_replies(responses.filter(F.col("source") == v), **VARIANTS[v]).withColumn("variant", F.lit(v))
              for v in variants]
    reply = F.struct("attempt", "question", "choices", "answer")
    return reduce(DataFrame.unionByName, usable).groupBy("id").agg(
        *[F.min(F.when(F.col("variant") == v, reply)).alias(f"_{v}") for v in variants])


def augment_all(sources: DataFrame, responses: DataFrame, variants: tuple[str, ...] = tuple(VARIANTS),
                ) -> dict[str, tuple[DataFrame, DataFrame]]:
    """Per variant: (new exam rows, source rows without a usable reply).

    The wide source rows are joined with the replies of all variants at once and
    staged once.
    """
    matched = stage(join_by_id(sources, accepted_replies(responses, variants)), "augmented")
    out = {}
    for v in variants:
        new = matched.filter(F.col(f"_{v}").isNotNull()).select(*sources.columns, f"_{v}.*")
        failed = matched.filter(F.col(f"_{v}").isNull()).select(*sources.columns)
        out[v] = make_augmented_rows(new), failed
    return out


def augment(sources: DataFrame, responses: DataFrame, variant: str) -> tuple[DataFrame, DataFrame]:
    """(new exam rows, source rows without a usable reply) of one variant."""
    return augment_all(sources, responses, (variant,))[variant]


def build_train_table(train: DataFrame, *augmented: DataFrame) -> DataFrame:
    """All sources by column name, long enough paragraphs only.

    `problems` must have one type in all of them.
    """
    return filter_min_length(merge_sources(train, *augmented))
