"""Python-literal text: write it from typed columns, read it back.

The exam files carry nested values as the text of a Python dict or list.  That
format only exists at the CSV edge; inside, columns are typed.
"""

from __future__ import annotations

import ast

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.functions.text import let
from examloom.schemas import PROBLEMS

# Characters Python's repr() does not print as they are, apart from the space.
_UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"


def _escape_unprintable(text: Column) -> Column:
    def code(c):
        n = F.ascii(c)
        digits = F.lower(F.hex(n))
        return (
            F.when(n <= 0xFF, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(n <= 0xFFFF, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
        )

    chars = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    escaped = F.transform(
        chars, lambda c: F.when(F.rlike(c, F.lit(_UNPRINTABLE)), code(c)).otherwise(c))
    return F.when(F.rlike(text, F.lit(_UNPRINTABLE)), F.array_join(escaped, "")).otherwise(text)


def _string_literal(col: Column) -> Column:
    text = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    for raw, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(raw), F.lit(name))
    prefers_double = F.contains(col, F.lit("'")) & ~F.contains(col, F.lit('"'))

    def quoted(body):
        single = F.replace(body, F.lit("'"), F.lit("\\'"))
        return F.when(prefers_double, F.concat(F.lit('"'), body, F.lit('"'))).otherwise(
            F.concat(F.lit("'"), single, F.lit("'")))

    return let(text, lambda t: let(_escape_unprintable(t), quoted))


def python_literal(col: Column, dtype: T.DataType) -> Column:
    """Text Python's repr() gives for a string, int, boolean, list or dict."""
    if isinstance(dtype, T.StructType):
        items = [
            F.concat(F.lit(f"'{f.name}': "), python_literal(col[f.name], f.dataType))
            for f in dtype.fields
        ]
        body = F.concat(F.lit("{"), F.concat_ws(", ", *items), F.lit("}"))
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(col, lambda x: python_literal(x, dtype.elementType))
        body = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.StringType):
        body = _string_literal(col)
    elif isinstance(dtype, T.BooleanType):
        body = F.when(col, F.lit("True")).otherwise(F.lit("False"))
    elif isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        body = col.cast("string")
    else:
        raise TypeError(f"no Python literal form for {dtype.simpleString()}")
    return F.when(col.isNull(), F.lit("None")).otherwise(body)


# The usual shape of a problem dict: the known keys in their usual order, strings
# with no escapes beyond \\ \n \r \t and quotes.  On this shape Python and JSON with
# single quotes agree, so `from_json` reads it without leaving the JVM.  Possessive
# quantifiers keep the match linear and free of recursion.
_PLAIN = (r"""(?:'(?:[^'\\\x00-\x1f]++|\\[\\nrt'"])*+'"""
          r"""|"(?:[^"\\\x00-\x1f]++|\\[\\nrt'"])*+")""")
_PLAIN_ITEMS = r"\[(?:" + _PLAIN + r"(?:, " + _PLAIN + r")*+)?\]"
_PLAIN_LIST = "^" + _PLAIN_ITEMS + r"\z"
_PLAIN_PROBLEM = (
    r"^\{'question': " + _PLAIN + r", 'choices': " + _PLAIN_ITEMS
    + r"(?:, 'answer': (?:0|[1-9][0-9]{0,8}))?"
    + r"(?:, 'question_plus': " + _PLAIN + r")?\}\z"
)
_JSON_OPTIONS = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}


def _literal_reader(keys: tuple[str, ...]):
    """Arrow UDF that reads dict text into the PROBLEMS struct.

    The function is nested so that it is shipped whole: executors need no copy of
    this package.
    """
    def text_of(value):
        if value is None:
            return None
        text = str(value)
        text.encode()  # a lone surrogate is no text: ValueError
        return text

    def whole_of(value):
        if value is None:
            return None
        if isinstance(value, str):
            value = int(value)
        if isinstance(value, bool) or not isinstance(value, int) or not -2**63 <= value < 2**63:
            raise ValueError("no whole number of 64 bits")
        return value

    def read_one(text):
        try:
            value = ast.literal_eval(text)
            question, choices, answer, extra = (value.get(k) for k in keys)
            if not isinstance(choices, (list, tuple)):
                raise ValueError("no list of options")
            return text_of(question), [text_of(c) for c in choices], whole_of(answer), text_of(extra)
        except (ValueError, SyntaxError, TypeError, AttributeError, MemoryError, RecursionError,
                OverflowError):
            return (None,) * len(keys)

    def read(texts: pd.Series) -> pd.DataFrame:
        empty = (None,) * len(keys)
        rows = [empty if t is None else read_one(t) for t in texts]
        out = pd.DataFrame(rows, columns=list(keys), dtype=object)
        return out.assign(answer=out["answer"].astype("Int64"))

    return F.pandas_udf(read, PROBLEMS)


def parse_problem_literal(text) -> Column:
    """struct<question, choices, answer, question_plus> from dict text.

    Null when the text does not parse, lacks question or choices, or when the choices are
    no list or the answer is no whole number of 64 bits.  Only rows outside the usual shape travel to Python (in Arrow batches); the others
    reach it as nulls.
    """
    plain = F.rlike(text, F.lit(_PLAIN_PROBLEM))
    native = F.from_json(text, PROBLEMS, _JSON_OPTIONS)
    other = _literal_reader(tuple(PROBLEMS.fieldNames()))(F.when(~plain, text))
    return F.when(plain, native).when(
        other["question"].isNotNull() & other["choices"].isNotNull(), other)


def parse_problem_json(text) -> Column:
    """The same struct from real JSON text."""
    parsed = F.from_json(text, PROBLEMS)
    return F.when(parsed["question"].isNotNull() & parsed["choices"].isNotNull(), parsed)


def parse_list_literal(text) -> Column:
    """List text -> array<string>, null when it is not a list.

    As with problems, only lists outside the plain shape travel to Python.
    """
    def text_of(value):
        if value is None:
            return None
        text = str(value)
        text.encode()
        return text

    def read_one(text):
        try:
            value = ast.literal_eval(text)
            return [text_of(v) for v in value] if isinstance(value, (list, tuple)) else None
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    def read(texts: pd.Series) -> pd.Series:
        return texts.map(read_one)

    strings = T.ArrayType(T.StringType())
    plain = F.rlike(text, F.lit(_PLAIN_LIST))
    other = F.pandas_udf(read, strings)(F.when(~plain, text))
    return F.when(plain, F.from_json(text, strings, _JSON_OPTIONS)).otherwise(other)
