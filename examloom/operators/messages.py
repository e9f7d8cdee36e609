"""Prompt and chat columns on exam tables.  DataFrame -> DataFrame."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.functions import prompts
from examloom.operators.joins import join_by_id


def _exam_columns():
    return (F.col("paragraph"), F.col("question"), F.col("choices"), F.col("question_plus"))


def render_prompt(df: DataFrame, into: str = "prompt",
                  templates: dict[str, str] | None = None) -> DataFrame:
    """Add the filled prompt; `templates` as `sources.templates.prompt_templates` gives them."""
    return df.withColumn(into, _prompt(templates))


def _prompt(templates: dict[str, str] | None):
    return prompts.render_prompt(*_exam_columns(), **(templates or {}))


def train_messages(df: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """id, messages (system, user, assistant), label."""
    prompt = _prompt(templates)
    return df.select(
        "id",
        prompts.train_messages(prompt, F.col("answer")).alias("messages"),
        F.col("answer").alias("label"),
    )


def test_messages(df: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """id, messages (system, user), label, len_choices."""
    prompt = _prompt(templates)
    return df.select(
        "id",
        prompts.test_messages(prompt).alias("messages"),
        F.col("answer").alias("label"),
        F.size("choices").alias("len_choices"),
    )


def render_chat(df: DataFrame, into: str = "text") -> DataFrame:
    return df.withColumn(into, prompts.render_chat(F.col("messages")))


def render_chat_turns(df: DataFrame, turn: str = "turn", role: str = "role",
                      content: str = "text", conversation: str = "conv_id",
                      first_turn: int | None = None, into: str = "segment") -> DataFrame:
    """Chat text per turn for conversations stored one turn per row.

    The result is one segment per turn; those of a conversation in turn order are its
    chat text, however long it is.  Only a system turn that is first is printed.  The
    first turn of a conversation is its smallest one; where all conversations start at
    one number, `first_turn` says so and no look at the other turns is needed.
    """
    if first_turn is not None:
        first = F.col(turn) == first_turn
        return df.withColumn(into, prompts.turn_text(F.col(role), F.col(content), first))
    starts = df.groupBy(conversation).agg(F.min(turn).alias("_first"))
    joined = join_by_id(df, starts, conversation)
    return joined.withColumn(into, prompts.turn_text(
        F.col(role), F.col(content), F.col(turn) == F.col("_first"))).select(*df.columns, into)


def label_prompt(df: DataFrame, into: str = "label_prompt") -> DataFrame:
    return df.withColumn(into, prompts.label_prompt(*_exam_columns()))


def generation_prompt_en(df: DataFrame, into: str = "generation_prompt") -> DataFrame:
    return df.withColumn(into, prompts.generation_prompt_en(
        F.col("paragraph"), F.col("question"), F.col("choices"), F.col("answer")))


def generation_prompt_ko(df: DataFrame, into: str = "generation_messages") -> DataFrame:
    return df.withColumn(into, prompts.generation_prompt_ko(
        F.col("paragraph"), F.col("question"), F.col("choices"), F.col("answer")))
