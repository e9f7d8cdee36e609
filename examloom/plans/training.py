"""Exam questions to tokenised train and evaluation tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.fixed_values import EVAL_SHARE, MAX_TOKENS, SEED
from examloom.functions.text import once, words
from examloom.operators.exam import (
    add_full_question,
    add_question_length,
    filter_max_tokens,
)
from examloom.operators.features import tokenize, tokenize_with
from examloom.operators.messages import render_chat, train_messages
from examloom.operators.split import assign_split
from examloom.sources.tables import stage


def exam_features(exam: DataFrame) -> DataFrame:
    return add_question_length(add_full_question(exam))


def chat_table(exam: DataFrame) -> DataFrame:
    """id, messages, label and chat text."""
    return render_chat(train_messages(exam))


def build_train_eval(exam: DataFrame, max_tokens: int = MAX_TOKENS,
                     test_size: float = EVAL_SHARE, seed: int = SEED,
                     load_tokenizer: Callable | None = None) -> DataFrame:
    """Chat rows of acceptable length: id, label, text, input_ids, attention_mask, is_eval.

    Ids come from the caller's tokenizer, or are the ranks of the words of all kept rows.
    They are staged, so that the split's passes do not repeat this work: those read nothing
    but the id column.
    """
    chat = chat_table(exam)
    if load_tokenizer is None:
        split = chat.select("*", once(words(F.col("text"))).alias("_words"))
        kept = tokenize(filter_max_tokens(split, "_words", max_tokens), "id", "label", "text", split=F.col("_words"))
    else:
        coded = tokenize_with(chat, load_tokenizer, "id", "label", "text")
        kept = stage(filter_max_tokens(coded, "input_ids", max_tokens), "chat-ids")
    return assign_split(kept, "id", test_size, seed)
