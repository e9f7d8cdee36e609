"""Prompts, chat messages and chat text, Column -> Column."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.fixed_values import (
    GENERATION_EXAMPLE,
    GENERATION_PROMPT_EN,
    GENERATION_SYSTEM_KO,
    GENERATION_USER_KO,
    LABEL_SYSTEM_PROMPT,
    LABEL_USER_PROMPT,
    PROMPT_PLAIN,
    PROMPT_WITH_MATERIAL,
    SYSTEM_MESSAGE,
    TURN_END,
    TURN_START,
)
from examloom.functions.literals import python_literal


def fill(template: str, **slots: Column) -> Column:
    """Put columns into the `{slots}` of a template.

    The template is cut at its slots when the plan is built and becomes one
    `concat`, so inserted text is never searched for slots.  Nulls print as
    `None`.
    """
    parts = []
    for text, slot, _, _ in Formatter().parse(template):
        if text:
            parts.append(F.lit(text))
        if slot is not None:
            parts.append(F.coalesce(slots[slot].cast("string"), F.lit("None")))
    return F.concat(*parts)


def number_choices(choices) -> Column:
    """`1 - first\\n2 - second` ..."""
    numbered = F.transform(choices, lambda c, i: F.concat(
        (i + 1).cast("string"), F.lit(" - "), F.coalesce(c, F.lit("None"))))
    return F.array_join(numbered, "\n")


def has_material(question_plus) -> Column:
    return F.coalesce(question_plus, F.lit("")) != ""


def question_template(question_plus, plain=PROMPT_PLAIN, material=PROMPT_WITH_MATERIAL) -> Column:
    """Text of the template a row uses."""
    return F.when(has_material(question_plus), F.lit(material)).otherwise(F.lit(plain))


def render_prompt(paragraph, question, choices, question_plus,
                  plain: str = PROMPT_PLAIN, material: str = PROMPT_WITH_MATERIAL) -> Column:
    slots = {"paragraph": paragraph, "question": question,
             "choices": number_choices(choices), "question_plus": question_plus}
    return F.when(has_material(question_plus), fill(material, **slots)).otherwise(
        fill(plain, **slots))


def message(role: str, content) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def train_messages(prompt, answer) -> Column:
    return F.array(
        message("system", F.lit(SYSTEM_MESSAGE)),
        message("user", prompt),
        message("assistant", F.coalesce(answer.cast("string"), F.lit("None"))),
    )


def test_messages(prompt) -> Column:
    return F.array(message("system", F.lit(SYSTEM_MESSAGE)), message("user", prompt))


def turn_text(role, content, is_first) -> Column:
    """What one chat turn adds to the chat text.  Null content is empty: a turn keeps its marks."""
    content = F.coalesce(content, F.lit(""))
    user = F.concat(
        F.lit(f"{TURN_START}user\n"), content, F.lit(f"{TURN_END}\n{TURN_START}model\n"))
    return (
        F.when(role == "user", user)
        .when(role == "assistant", F.concat(content, F.lit(f"{TURN_END}\n")))
        .when((role == "system") & F.coalesce(is_first, F.lit(False)), content)
        .otherwise(F.lit(""))
    )


def render_chat(messages) -> Column:
    """Chat text of an array of messages; only a leading system turn is printed."""
    turns = F.transform(messages, lambda m, i: turn_text(m["role"], m["content"], i == 0))
    return F.array_join(turns, "")


def choices_literal(choices) -> Column:
    return python_literal(choices, T.ArrayType(T.StringType()))


def label_prompt(paragraph, question, choices, question_plus) -> Column:
    """struct<system, user> asking for topic and prior knowledge.

    Missing extra material prints as `nan`, the text of an empty CSV field there.
    """
    user = fill(LABEL_USER_PROMPT, paragraph=paragraph, question=question,
                choices=choices_literal(choices),
                question_plus=F.coalesce(question_plus, F.lit("nan")))
    return F.struct(F.lit(LABEL_SYSTEM_PROMPT).alias("system"), user.alias("user"))


def generation_prompt_en(paragraph, question, choices, answer) -> Column:
    return fill(GENERATION_PROMPT_EN, example=F.lit(GENERATION_EXAMPLE), paragraph=paragraph,
                question=question, choices=choices_literal(choices), answer=answer)


def generation_prompt_ko(paragraph, question, choices, answer) -> Column:
    """Messages array: system and user."""
    user = fill(GENERATION_USER_KO, paragraph=paragraph, question=question,
                choices=choices_literal(choices), answer=answer)
    return F.array(message("system", F.lit(GENERATION_SYSTEM_KO)), message("user", user))
