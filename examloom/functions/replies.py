"""Generated questions out of free-text model replies, Column -> Column.

Both parsers return struct<question, choices, answer>.  They work on whole
replies, as expressions over line and block arrays; no row leaves the JVM.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.fixed_values import (
    BOLD_ANSWER,
    BOLD_CHOICES,
    BOLD_QUESTION,
    KO_ANSWER,
    KO_CHOICES,
    KO_QUESTION,
    KO_QUESTION_LABEL,
    OPTION_COUNT,
)
from examloom.functions.text import INLINE_SPACE, after_first, last, let, python_int, strip


def _quoted(marker: str) -> str:
    return r"\Q" + marker + r"\E"


def _lines_with(text, marker: str) -> Column:
    """What follows `marker` on each line that starts with it."""
    return F.regexp_extract_all(text, F.lit(rf"(?md)^{_quoted(marker)}(.*)$"), F.lit(1))


def _without(col, marker: str) -> Column:
    return strip(F.replace(col, F.lit(marker), F.lit("")))


def _last_int(texts) -> Column:
    return last(F.filter(F.transform(texts, python_int), lambda n: n.isNotNull()))


def parse_bold_reply(text) -> Column:
    """Replies with `**New Question:**` style headings.

    Blank lines cut a reply into blocks.  Behind a choices heading the rest of
    its block is the option list; answer lines count only outside such a list.
    The last question line and the last readable answer win.
    """
    blank_line = rf"(?Umd)^{INLINE_SPACE}*+$"
    heading = rf"(?md)^{_quoted(BOLD_CHOICES)}.*$"
    option = rf"(?Umd)^{INLINE_SPACE}*+([1-5].*)$"

    def options(part):
        listed = F.coalesce(F.get(part, F.lit(1)), F.lit(""))
        return F.transform(
            F.regexp_extract_all(listed, F.lit(option), F.lit(1)),
            lambda line: after_first(strip(line), ". "))

    def answers(part):
        return F.transform(
            _lines_with(F.get(part, F.lit(0)), BOLD_ANSWER),
            lambda line: _without(line, BOLD_ANSWER))

    question = F.coalesce(
        _without(last(_lines_with(text, BOLD_QUESTION)), BOLD_QUESTION), F.lit(""))
    blocks = F.transform(F.split(text, blank_line), lambda b: F.split(b, heading, 2))
    return let(blocks, lambda parts: F.struct(
        question.alias("question"),
        F.flatten(F.transform(parts, options)).alias("choices"),
        _last_int(F.flatten(F.transform(parts, answers))).alias("answer"),
    ))


def parse_korean_reply(text, strip_label: bool = False) -> Column:
    """Replies with `질문` / `선택지` / `정답` lines.

    The option list opens at the first choices heading and closes with its fifth
    option; a later heading opens it again for good.  Answer lines count only
    while the list is closed.  `strip_label=True` also removes a `질문:` label
    written without the space, which is otherwise kept as part of the question.
    """
    def at(lines, i):
        return F.get(lines, i)

    def question(lines):
        found = last(F.filter(lines, lambda x: F.startswith(x, F.lit(KO_QUESTION))))
        plain = _without(found, KO_QUESTION_LABEL)
        if strip_label:
            plain = strip(F.regexp_replace(plain, rf"^{KO_QUESTION}\s*:", ""))
        return F.coalesce(plain, F.lit(""))

    def parsed(lines):
        end = F.size(lines)
        index = F.sequence(F.lit(0), end - 1)
        headings = F.filter(index, lambda i: F.startswith(at(lines, i), F.lit(KO_CHOICES)))
        return let(headings, lambda heads: let(
            F.coalesce(F.get(heads, F.lit(0)), end),
            lambda opens: let(
                F.filter(index, lambda i: (i > opens) & F.rlike(at(lines, i), F.lit("^[1-5]"))),
                lambda listed: let(
                    F.coalesce(F.get(listed, F.lit(OPTION_COUNT - 1)), end),
                    lambda closes: let(
                        F.coalesce(F.get(F.filter(heads, lambda h: h > closes), F.lit(0)), end),
                        lambda reopens: _assemble(lines, index, opens, listed, closes, reopens),
                    )))))

    def _assemble(lines, index, opens, listed, closes, reopens):
        kept = F.filter(listed, lambda i: (i <= closes) | (i > reopens))
        free = F.filter(index, lambda i: (
            F.startswith(at(lines, i), F.lit(KO_ANSWER))
            & ((i < opens) | ((i > closes) & (i < reopens)))))
        return F.struct(
            question(lines).alias("question"),
            F.transform(kept, lambda i: after_first(at(lines, i), ". ")).alias("choices"),
            _last_int(F.transform(free, lambda i: after_first(at(lines, i), ":"))).alias("answer"),
        )

    return let(F.transform(F.split(text, "\n"), strip), parsed)


def valid_generation(parsed, exact_choices: int | None = None) -> Column:
    """True when a parsed reply has a question, options and an answer."""
    count = F.size(parsed["choices"])
    enough = count > 0 if exact_choices is None else count == exact_choices
    complete = (parsed["question"] != "") & enough & parsed["answer"].isNotNull()
    return F.coalesce(complete, F.lit(False))
