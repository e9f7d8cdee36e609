"""Fill-in-the-middle rows: a text cut at two line ends and put together in another order.

The ends of a text's units are a set of byte offsets, kept by their upper bits in containers as
Roaring bitmaps are: a sorted array, a bit map, or runs, whichever is smallest.  Running cardinalities lead to
the container that holds the k-th end, a selection inside it gives the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm.common import blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
LOW_BITS = 16
PIECE_BYTES = 1 << 20
NEWLINE = 10


class ArrayContainer:
    """Sorted lower halves: two bytes a member."""

    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.low[k])


class RunContainer:
    """Starts of runs and how many members lie before each: for long runs of members."""

    def __init__(self, starts: np.ndarray, low: np.ndarray):
        self.start, self.before = low[starts].astype(np.uint16), starts.astype(np.uint16)

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.start[run]) + k - int(self.before[run])


class BitmapContainer:
    """One bit for each place, and the number of members before each group of 64 places."""

    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << LOW_BITS, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").reshape(-1, 8)
        self.before = np.concatenate([[0], np.cumsum(bits.reshape(-1, 64).sum(axis=1))[:-1]])

    def select(self, k: int) -> int:
        group = int(np.searchsorted(self.before, k, "right")) - 1
        inside = np.flatnonzero(np.unpackbits(self.words[group], bitorder="little"))
        return group * 64 + int(inside[k - int(self.before[group])])


def _container(low: np.ndarray):
    """The smallest form: 2 bytes a member, 4 bytes a run, or 8 KB of bits and their counts."""
    starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1] + 1]))
    sizes = {ArrayContainer: 2 * len(low), RunContainer: 4 * len(starts), BitmapContainer: (1 << LOW_BITS) >> 3}
    best = min(sizes, key=sizes.get)
    return best(starts, low) if best is RunContainer else best(low)


class BoundarySet:
    """Ends of the lines of a text as byte offsets; `select(k)` is the k-th, `select(0)` is 0."""

    def __init__(self, raw: bytes):
        data = np.frombuffer(raw, np.uint8)
        self.keys, self.containers, counts = [], [], []
        # An end is the place of the last byte of its unit, so that its container is where it stands.
        for begin in range(0, len(data), 1 << LOW_BITS):
            piece = data[begin:begin + (1 << LOW_BITS)]
            low = np.flatnonzero(piece == NEWLINE)
            if begin + len(piece) == len(data) and piece[-1] != NEWLINE:
                low = np.append(low, len(piece) - 1)
            if len(low):
                self.keys.append(begin)
                self.containers.append(_container(low))
                counts.append(len(low))
        self.before = np.cumsum([0, *counts])

    def __len__(self) -> int:
        return int(self.before[-1])

    def select(self, k: int) -> int:
        if k == 0:
            return 0
        at = int(np.searchsorted(self.before, k - 1, "right")) - 1
        return self.keys[at] + self.containers[at].select(k - 1 - int(self.before[at])) + 1


@dataclass(frozen=True)
class Rule:
    seed: int = 7
    percent: int = 100      # of the texts that can be turned are turned
    spm_percent: int = 50   # of those have the suffix first


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four unsigned 32-bit numbers that depend on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[i:i + 8], 16) for i in range(0, 32, 8)]


def transform(raw: bytes, doc_id: int | None, rule: Rule = Rule()) -> tuple[int, str, bytes, int, int]:
    """(units, form, output, start of the middle, start of the suffix), offsets in bytes."""
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    ends = BoundarySet(raw)
    n = len(ends)
    h1, h2, h3, h4 = draws(doc_id, rule.seed)
    if not raw or p in raw or s in raw or m in raw or h3 % 100 >= rule.percent:
        return n, "plain", raw, 0, 0
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends.select(first), ends.select(second)
    if h4 % 100 < rule.spm_percent:
        return n, "spm", b"".join((s, raw[b:], p, raw[:a], m, raw[a:b])), a, b
    return n, "psm", b"".join((p, raw[:a], s, raw[b:], m, raw[a:b])), a, b


def restore(output: bytes, form: str) -> bytes:
    """The text of an output.  A text in a turned form holds no mark, so each mark is found once."""
    if form == "plain":
        return output
    order = (PREFIX, SUFFIX, MIDDLE) if form == "psm" else (SUFFIX, PREFIX, MIDDLE)
    marks = [mark.encode() for mark in order]
    second = output.index(marks[1])
    third = output.index(marks[2], second)
    parts = dict(zip(order, (output[len(marks[0]):second], output[second + len(marks[1]):third],
                             output[third + len(marks[2]):])))
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


def characters(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(raw.decode())


def _work(rule: Rule, row, schema: pa.Schema):
    """Task over (doc_id, text) that gives one `row(doc_id, raw, rule)` a document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop in blocks(batch.column(1), PIECE_BYTES):
                part = batch.slice(start, stop - start)
                rows = [row(i, (t or "").encode(), rule)
                        for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
                columns = [part.column(0), *map(list, zip(*rows))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) if isinstance(c, list) else c for c, f in zip(columns, schema)], schema=schema)

    return work


def _output_row(doc_id, raw: bytes, rule: Rule):
    n, form, output, a, b = transform(raw, doc_id, rule)
    plain = form == "plain"
    return n, form, None if plain else characters(raw[:a]), None if plain else characters(raw[a:b]), output.decode()


def _digest_row(doc_id, raw: bytes, rule: Rule):
    n, form, output, a, b = transform(raw, doc_id, rule)
    plain = form == "plain"
    return (n, form, None if plain else characters(raw[:a]), None if plain else characters(raw[a:b]),
            hashlib.sha256(output).hexdigest(), hashlib.sha256(restore(output, form)).hexdigest())


_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
         ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_HEAD_SQL = "doc_id long, n long, form string, prefix_chars long, middle_chars long"


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"))


def infill(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    A text's units are its lines with their line ends.  `form`: psm (prefix, suffix, middle), spm (suffix
    first), or plain (the text as it is) where the text is empty, holds one of the marks or is left out by
    `percent`; character counts are null then.  Cuts depend on the seed and the id, so rows equal in id
    and text give equal rows; null ids share one draw.  Null texts are empty.  A very long text takes 8 KB of
    boundaries per 64 KB at most.  Other columns are not read; an empty table gives no rows.
    """
    schema = pa.schema([*_HEAD, ("output", pa.string())])
    return _rows(docs).mapInArrow(_work(rule, _output_row, schema), _HEAD_SQL + ", output string")


def digests(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """As `infill`, with digests of the output and of the text restored from output and form."""
    schema = pa.schema([*_HEAD, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
    return _rows(docs).mapInArrow(
        _work(rule, _digest_row, schema), _HEAD_SQL + ", output_sha256 string, restored_sha256 string")


SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
    sha256('7:' || doc_id) AS h FROM documents),
h AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || substr(h, 1, 8))::UBIGINT % (len(u) + 1) AS c1,
    ('0x' || substr(h, 9, 8))::UBIGINT % (len(u) + 1) AS c2, ('0x' || substr(h, 17, 8))::UBIGINT AS h3,
    ('0x' || substr(h, 25, 8))::UBIGINT AS h4 FROM d),
f AS (
  SELECT doc_id, text, n, array_to_string(u[1:least(c1, c2)::INT], '') AS p,
    array_to_string(u[least(c1, c2)::INT + 1:greatest(c1, c2)::INT], '') AS m,
    array_to_string(u[greatest(c1, c2)::INT + 1:], '') AS s,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
         THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM f"""
