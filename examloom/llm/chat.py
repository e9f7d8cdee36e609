"""Chat formatting: a state machine over roles, a declarative template, loss flags.

Turns are dealt by conversation and sorted; both passes then stream through the rows of a
partition and hold one turn and a small state, so a conversation may be of any length.  It
is one sequence, hashed from its first to its last turn, and therefore stays in one task.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from examloom.llm.common import partitions

ESCAPE = "\\"


@dataclass(frozen=True)
class Template:
    """Control strings around the text of each role, the roles that bear loss, and the order
    of turns: `turns[state][role]` is the next state, a missing entry makes the conversation
    invalid, and a valid one ends in a state of `final`.

    Roles without an entry are written with their name (`other`); null roles as `nameless`.
    """

    marks: dict = field(default_factory=lambda: {
        "system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"),
        "assistant": ("<s>", "</s>")})
    other: tuple = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
    nameless: tuple = ("[TURN] ", " [/TURN]")
    loss: frozenset = frozenset({"assistant"})
    turns: dict = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"}, "system": {"user": "user"},
        "user": {"assistant": "assistant"}, "assistant": {"user": "user"}})
    final: frozenset = frozenset({"assistant"})

    def controls(self) -> list[str]:
        marks = [m for pair in self.marks.values() for m in pair] + [*self.other, *self.nameless]
        return sorted({m.strip() for m in marks}, key=lambda m: (-len(m), m))

    def control_pattern(self) -> str:
        return "|".join(map(re.escape, self.controls()))


SEGMENTS = T.ArrayType(T.StructType([
    T.StructField("text", T.StringType()), T.StructField("loss", T.BooleanType())]))
FORMATTED = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("position", T.LongType()),
    T.StructField("segments", SEGMENTS), T.StructField("state", T.StringType())])
READ = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("n_turns", T.LongType()),
    T.StructField("turns_sha256", T.StringType()), T.StructField("loss_chars", T.LongType()),
    T.StructField("loss_sha256", T.StringType()), T.StructField("formatted_chars", T.LongType()),
    T.StructField("valid", T.BooleanType())])


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


def escape(text: str, pattern: re.Pattern) -> str:
    """An escape sign before each escape sign and each control string."""
    return pattern.sub(lambda m: ESCAPE + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def _formatter(template: Template):
    pattern = re.compile(re.escape(ESCAPE) + "|" + template.control_pattern())

    def format_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, position = object(), "start", 0
        for batch in batches:
            out = []
            for conv_id, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv_id != conv:
                    conv, state, position = conv_id, "start", 0
                state = template.turns.get(state, {}).get(role, "invalid")
                body = escape(text or "", pattern)
                if role is None:
                    before, after = template.nameless
                elif role in template.marks:
                    before, after = template.marks[role]
                else:
                    opening, middle, after = template.other
                    before = opening + escape(role, pattern) + middle
                segments = [(before, False), (body, role in template.loss), (after, False)]
                out.append((conv_id, position, [{"text": t, "loss": x} for t, x in segments], state))
                position += 1
            yield _batch(out, FORMATTED)

    return format_rows


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn, in order inside its partition: conv_id, position, segments, state.

    The formatted conversation is the text of its segments, joined in order; each segment
    says whether it bears loss.  `state` is the machine's state after the turn, `invalid` from the
    first turn on that is out of order.  Turns are ordered by turn (null first), then role and
    text, so repeated turns have a defined order.  A null conv_id is a conversation of its own;
    null text is empty.  Empty input gives no rows.
    """
    rows = turns.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in
                          (("conv_id", "long"), ("turn", "long"), ("role", "string"), ("text", "string"))])
    dealt = rows.repartition(partitions(turns.sparkSession), "conv_id") \
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_formatter(template), FORMATTED)


def _reader(template: Template):
    token = re.compile(rf"({re.escape(ESCAPE)}.)|({template.control_pattern()})", re.S)
    opening = {b.strip(): (role, b, a) for role, (b, a) in template.marks.items()}
    opening[template.nameless[0].strip()] = (None, *template.nameless)
    other = template.other[0].strip()

    def between(chunk: str, control: str, start: int) -> int:
        """Where the control string, not escaped, next stands."""
        for m in token.finditer(chunk, start):
            if m[2] == control:
                return m.start()
        raise ValueError(f"{control} is missing")

    def turn(chunk: str) -> tuple[str | None, str]:
        """Role and text as they were before formatting."""
        first = token.match(chunk)
        if first[2] == other:
            start, middle, end = template.other
            cut = between(chunk, middle.strip(), len(start)) - (len(middle) - len(middle.lstrip()))
            role, rest = unescape(chunk[len(start):cut]), cut + len(middle)
        else:
            role, start, end = opening[first[2]]
            rest = len(start)
        stop = between(chunk, end.strip(), rest) - (len(end) - len(end.lstrip()))
        if stop + len(end) != len(chunk):
            raise ValueError("text after the end of a turn")
        return role, unescape(chunk[rest:stop])

    def read_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, seen = None, None

        def result():
            n, turns, loss, chars, loss_chars, state = seen
            return (conv, n, turns.hexdigest(), loss_chars, loss.hexdigest(), chars, state in template.final)

        for batch in batches:
            out = []
            for conv_id, position, segments, state in zip(*(
                    batch.column(c).to_pylist() for c in ("conv_id", "position", "segments", "state"))):
                if position == 0:
                    if seen:
                        out.append(result())
                    conv, seen = conv_id, [0, hashlib.sha256(), hashlib.sha256(), 0, 0, ""]
                chunk = "".join(s["text"] for s in segments)
                role, text = turn(chunk)
                seen[0] += 1
                seen[1].update(f"{role or ''}\n{text}\n".encode())
                for s in segments:
                    if s["loss"]:
                        body = unescape(s["text"])
                        seen[2].update(body.encode())
                        seen[4] += len(body)
                seen[3] += len(chunk)
                seen[5] = state
            yield _batch(out, READ)
        if seen:
            yield _batch([result()], READ)

    return read_rows


def read_back(formatted: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the formatted text alone: number and digest of the turns,
    characters and digest of what bears loss, characters of the formatted text, and whether
    the turns were in a valid order.  Takes the rows of `format_chats` as they come."""
    return formatted.mapInArrow(_reader(template), READ)


PROBE = "</s>[INST] ok [/INST]"


def _sql(template: Template = Template()) -> str:
    controls = template.control_pattern().replace("'", "''")
    overhead = " ".join(f"WHEN '{r}' THEN {len(b) + len(a)}" for r, (b, a) in template.marks.items())
    return rf"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{PROBE}' UNION ALL SELECT -1, 1, 'assistant', '{PROBE}'),
e AS (SELECT *, length(text) + len(regexp_extract_all(text, '\\|{controls}'))
         + CASE role {overhead} END AS chars,
       coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn), 'start') AS last_role,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  bool_and((last_role, role) IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
      ('user', 'assistant'), ('assistant', 'user')))
    AND bool_or(back = 1 AND role = 'assistant') AS valid
FROM e GROUP BY conv_id"""


SQL = _sql()
