"""Text helpers, Column -> Column.

Spark's own `trim`, `\\s` and integer casts differ from the Python string rules
the data was produced with; these helpers close the gap with built-in
expressions only, so every one of them stays inside the JVM.
"""

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.fixed_values import WORD_PATTERN

# Every character Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The same set as a Java character class; `INLINE_SPACE` leaves the newline out.
SPACE = r"[\s\x1c-\x1f]"
INLINE_SPACE = r"[\s\x1c-\x1f&&[^\n]]"


# Every decimal digit beyond ASCII, as Python's int() and \\d know them, with its value.
DIGITS = "".join(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
VALUES = "".join(str(unicodedata.digit(c)) for c in DIGITS)


def let(value, body):
    """Evaluate `value` once and hand it to `body(column)`.

    Catalyst substitutes a column's definition wherever it is used; inside a
    lambda that would re-run it per array element.  Binding it to a lambda
    variable keeps it to one evaluation per row.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value) -> Column:
    """Generator column that computes `value` exactly once per row.

    Filters on an ordinary computed column are pushed below it and compute it a
    second time.  They stay above a generator, so costly values are selected as a
    one-element `explode`.
    """
    return F.explode(F.array(value))


def last(array) -> Column:
    """Last element, null for an empty array."""
    return F.try_element_at(array, F.lit(-1))


def strip(col) -> Column:
    return F.btrim(col, F.lit(WHITESPACE))


def python_int(col) -> Column:
    """Integer in `col` under the rules of Python's int(), else null.

    Surrounding whitespace, a sign, single underscores and the digits of every script
    are accepted; `3번` and `3.7` are not.  Values beyond 64 bits are null.
    """
    plain = ascii_digits(strip(col))
    return F.when(
        F.rlike(plain, F.lit(r"^[+-]?[0-9]+(?:_[0-9]+)*\z")),
        F.replace(plain, F.lit("_"), F.lit("")).try_cast("bigint"),
    )


def ascii_digits(col) -> Column:
    """The text with the decimal digits of all scripts as 0-9."""
    return F.when(F.rlike(col, F.lit(r"[^\x00-\x7f]")), F.translate(col, DIGITS, VALUES)).otherwise(col)


def after_first(col, separator: str) -> Column:
    """Text behind the first `separator`; the whole text if there is none."""
    at = F.instr(col, separator)
    return F.when(at > 0, F.substr(col, at + F.lit(len(separator)))).otherwise(col)


def words(col) -> Column:
    """Lower-cased runs of two or more letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(col), F.lit(WORD_PATTERN), F.lit(0))


def word_counts(tokens) -> Column:
    """array<struct<term, tf>> of a token array, ordered by term.

    Sorting puts equal tokens side by side, so a count is the distance between
    two run starts: O(n log n) for the row and no shuffle.
    """
    def runs(t):
        first = F.filter(
            F.sequence(F.lit(0), F.size(t) - 1),
            lambda i: (i == 0) | (F.get(t, i) != F.get(t, i - 1)),
        )
        return let(first, lambda s: F.zip_with(
            s,
            F.array_append(F.slice(s, F.lit(2), F.size(s)), F.size(t)),
            lambda a, b: F.struct(F.get(t, a).alias("term"), (b - a).alias("tf")),
        ))

    empty = F.array().cast("array<struct<term:string,tf:int>>")
    counted = let(F.sort_array(tokens), lambda t: F.when(F.size(t) > 0, runs(t)))
    return F.coalesce(counted, empty)


def bare_text(col) -> Column:
    """Drop Latin-only bracketed remarks and every asterisk."""
    no_remarks = F.regexp_replace(col, rf"(?U)\([A-Za-z{SPACE}]*\)", "")
    return F.replace(no_remarks, F.lit("*"), F.lit(""))
