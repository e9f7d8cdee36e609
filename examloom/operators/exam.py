"""Exam tables: parse, flatten, nest, filter, order, merge.  DataFrame -> DataFrame."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.fixed_values import (
    AUGMENTED_ID_SUFFIX,
    MAX_TOKENS,
    MIN_PARAGRAPH_CHARS,
    NO_ANSWER_CHOICE,
    PRIOR_KNOWLEDGE_NOT_NEEDED,
)
from examloom.functions.labels import id_digits
from examloom.functions.literals import (
    parse_list_literal,
    parse_problem_json,
    parse_problem_literal,
)
from examloom.functions.text import once

PROBLEM_PARTS = ("question", "choices", "answer")


# --- projections --------------------------------------------------------------

def parse_problems(df: DataFrame, text: str = "problems", into: str = "p",
                   form: str = "python") -> DataFrame:
    """Add the parsed problem struct; null where the text is not usable."""
    parse = {"python": parse_problem_literal, "json": parse_problem_json}[form]
    return df.select("*", once(parse(F.col(text))).alias(into))


def append_sentinel_choice(df: DataFrame, choices: str = "choices") -> DataFrame:
    """Add "no answer" as the last option of every question."""
    return df.withColumn(choices, F.array_append(choices, F.lit(NO_ANSWER_CHOICE)))


def flatten_exam(df: DataFrame, coalesce_outer: bool = False, form: str = "python") -> DataFrame:
    """Raw exam rows -> id, paragraph, question, choices, answer, question_plus.

    Extra material comes from the nested dict; `coalesce_outer=True` falls back to
    the table's own `question_plus` column.  Rows whose problem text cannot be read
    are left out; `unreadable_exam` returns exactly those.
    """
    parsed = parse_problems(df, form=form).filter(F.col("p").isNotNull())
    nested = F.col("p.question_plus")
    extra = F.coalesce(nested, F.col("question_plus")) if coalesce_outer else nested
    flat = parsed.select(
        "id", "paragraph", "p.question", "p.choices", "p.answer", extra.alias("question_plus"))
    return append_sentinel_choice(flat)


def unreadable_exam(df: DataFrame, form: str = "python") -> DataFrame:
    """Raw rows whose problem text cannot be read, unchanged."""
    return parse_problems(df, form=form).filter(F.col("p").isNull()).drop("p")


def nest_problems(df: DataFrame) -> DataFrame:
    """Add `problems` as a struct of question, choices and answer.

    Choices that come from a CSV as list text are read first.
    """
    if isinstance(df.schema["choices"].dataType, T.StringType):
        df = df.withColumn("choices", parse_list_literal(F.col("choices")))
    return df.withColumn("problems", F.struct(*PROBLEM_PARTS))


def drop_problem_parts(df: DataFrame) -> DataFrame:
    return df.drop(*PROBLEM_PARTS)


def full_question_text(question: Column, question_plus: Column) -> Column:
    return F.concat_ws(" ", question, F.nullif(question_plus, F.lit("")))


def add_full_question(df: DataFrame) -> DataFrame:
    """Question and extra material in one text; missing material becomes ''."""
    return df.withColumns({
        "question_plus": F.coalesce("question_plus", F.lit("")),
        "full_question": full_question_text(F.col("question"), F.col("question_plus")),
    })


def add_question_length(df: DataFrame) -> DataFrame:
    """Length of `full_question` in code points."""
    return df.withColumn("question_length", F.length("full_question"))


def make_augmented_rows(df: DataFrame) -> DataFrame:
    """Accepted generated questions -> exam rows with a struct `problems`."""
    return df.select(
        F.concat("id", F.lit(AUGMENTED_ID_SUFFIX)).alias("id"),
        "paragraph",
        F.struct(*PROBLEM_PARTS).alias("problems"),
        F.lit("").alias("question_plus"),
    )


# --- filters --------------------------------------------------------------------

def filter_no_prior_knowledge(df: DataFrame) -> DataFrame:
    """Questions that can be answered from the paragraph alone."""
    return df.filter(F.col("prior_knowledge_needed") == PRIOR_KNOWLEDGE_NOT_NEEDED)


def filter_min_length(df: DataFrame, column: str = "paragraph",
                      longer_than: int = MIN_PARAGRAPH_CHARS) -> DataFrame:
    return df.filter(F.length(column) > longer_than)


def filter_max_tokens(df: DataFrame, column: str = "token_count",
                      at_most: int = MAX_TOKENS) -> DataFrame:
    """Rows with at most that many tokens; `column` is a count or an id array."""
    is_array = isinstance(df.schema[column].dataType, T.ArrayType)
    return df.filter((F.size(column) if is_array else F.col(column)) <= at_most)


def quarantine(df: DataFrame, reason: Column | str = "reason") -> tuple[DataFrame, DataFrame]:
    """(rows without a reason, rows with their `reason`).

    Together the two hold every input row.  Write the flagged table once before
    using both sides if it is costly to compute.
    """
    flagged = df.withColumn("reason", F.col(reason) if isinstance(reason, str) else reason)
    return (flagged.filter(F.col("reason").isNull()).drop("reason"),
            flagged.filter(F.col("reason").isNotNull()))


# --- order, limit, union -----------------------------------------------------------

def sort_by_id_number(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Ascending by the first number in the id; ids without a number last.

    Digits compare by length, then by text, so numbers of any size sort exactly.
    Equal numbers are ordered by id and content.  The row position is the final
    key: a third of all rows may share one id, and without it they would all be
    sent to the same range partition.
    """
    digits = F.regexp_replace(id_digits(F.col(id_col)), "^0+(?=.)", "")
    keyed = df.withColumns({
        "_none": digits == "",
        "_length": F.length(digits),
        "_digits": digits,
        "_content": F.xxhash64(*df.columns),
        "_position": F.monotonically_increasing_id(),
    })
    keys = ["_none", "_length", "_digits", id_col, "_content", "_position"]
    return keyed.orderBy(*keys).drop("_none", "_length", "_digits", "_content", "_position")


def preview(df: DataFrame, *order: str, rows: int = 5) -> DataFrame:
    """First rows in a stated order."""
    return df.orderBy(*order).limit(rows)


def merge_sources(*sources: DataFrame, names: list[str] | None = None) -> DataFrame:
    """UNION ALL by column name; missing columns become null, nothing is removed.

    `names` adds a `source` column, which tells rows with the same id apart.
    """
    if names is not None:
        sources = [df.withColumn("source", F.lit(n)) for df, n in zip(sources, names, strict=True)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), sources)
