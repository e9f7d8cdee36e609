"""Importance resampling towards a target corpus by hashed n-gram features.

Features fall into a fixed number of buckets.  A bucket's gain is the scaled log ratio of
its smoothed shares in the target and in the documents; a document's weight is the mean gain of
its features.  Weights plus seeded Gumbel noise are ranked by a distributed radix sort, and the
highest are drawn without replacement.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm.common import blocks, staged
from examloom.llm.radix import radix_rank

PIECE_BYTES = 1 << 20   # bytes of words held as objects at once
CACHE_BYTES = 1 << 24   # of words whose bucket is remembered in a task
SCALED = "doc_id long, n_features long, n_words long, weight long, score long"
# A-Z lowered; all that is no word character becomes a space.
TABLE = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
              for b in range(256))


@dataclass(frozen=True)
class Rule:
    longest: int = 1        # words of the longest feature
    buckets: int = 10_000   # size of the arrays that go to all tasks
    seed: int = 2024
    percent: int = 10       # of the eligible documents are drawn
    least_words: int = 20   # an eligible document has so many


class _Buckets(dict):
    """Bucket of each feature; starts anew when it holds too many bytes."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets, self.held = buckets, 0

    def __missing__(self, feature: bytes) -> int:
        if self.held > CACHE_BYTES:
            self.clear()
            self.held = 0
        self.held += len(feature) + 100
        found = self[feature] = crc32(feature) % self.buckets
        return found


def _pieces(raw: bytes) -> Iterator[bytes]:
    """The translated text in pieces that end where a word ends."""
    at = 0
    while at < len(raw):
        stop = at + PIECE_BYTES
        while stop < len(raw) and TABLE[raw[stop]] != 0x20:
            stop += 1
        yield raw[at:stop].translate(TABLE)
        at = stop


def _features(raw: bytes, bucket: _Buckets, longest: int) -> Iterator[tuple[int, np.ndarray]]:
    """(number of words, buckets of the features that end in them) per piece of a text."""
    before: list[bytes] = []
    for piece in _pieces(raw):
        words = piece.split()
        found = list(map(bucket.__getitem__, words))
        if longest > 1:
            run = before + words
            for k in range(2, longest + 1):
                for end in range(max(k, len(before) + 1), len(run) + 1):
                    found.append(bucket[b" ".join(run[end - k:end])])
            before = run[len(run) - min(len(run), longest - 1):]
        yield len(words), np.array(found, np.int64)


def bucket_counts(texts: DataFrame, rule: Rule = Rule()) -> np.ndarray:
    """Features of all texts per bucket: each task counts in an array, the arrays are added up.

    `texts` has the text as its only column.  The result has a fixed size.
    """
    longest, size = rule.longest, rule.buckets

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, counts = _Buckets(size), np.zeros(size, np.int64)
        for batch in batches:
            for start, stop in blocks(batch.column(0), PIECE_BYTES):
                part = [t for t in batch.column(0).slice(start, stop - start).to_pylist() if t]
                # Single words need no borders between texts.
                for text in [" ".join(part)] if longest == 1 else part:
                    for _, found in _features(text.encode(), bucket, longest):
                        counts += np.bincount(found, minlength=size)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    out = np.zeros(size, np.int64)
    for r in texts.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # at most `buckets` rows
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of the smoothed shares of each bucket."""
    size, s_all, t_all = len(source), int(source.sum()), int(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t + 1) * (s_all + size)) / (float(s + 1) * (t_all + size))))
        for s, t in zip(source.tolist(), target.tolist())], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Gumbel noise of a document, in thousandths; depends on the seed and the id alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def scored(docs: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every row of `docs`."""
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"), F.col("`text`").cast("string").alias("text"))
    gain = gains(bucket_counts(rows.select("text"), rule),
                 bucket_counts(target.select(F.col("`text`").cast("string").alias("text")), rule))
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # `buckets` numbers
    longest, seed, size = rule.longest, rule.seed, rule.buckets

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, gain = _Buckets(size), shared.value
        for batch in batches:
            for start, stop in blocks(batch.column(1), PIECE_BYTES):
                part = batch.slice(start, stop - start)
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    n_words = n = total = 0
                    for words, found in _features((text or "").encode(), bucket, longest):
                        n_words, n, total = n_words + words, n + len(found), total + int(gain[found].sum())
                    weight = total // n if n else 0
                    out.append((n, n_words, weight, weight + noise(doc_id, seed)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, pa.int64()) for c in zip(*out)]],
                    ["doc_id", "n_features", "n_words", "weight", "score"])

    return rows.mapInArrow(work, SCALED)


def resample(docs: DataFrame, target: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One row per document: doc_id, n_features, weight, score, rank (all long).

    Words are runs of letters, digits and characters beyond ASCII, A-Z lowered; features all runs
    of up to `longest` of them.  Ranks 1, 2, 3, ... go to the `percent` (rounded down) of the
    documents with `least_words` that have the highest scores, ties to the smaller doc_id; null ids come
    after all others.  All other documents have no rank.  Rows equal in score and id are ranked in any
    order.  Null texts have no words; texts of any length are read in pieces; other columns are not read.
    An empty table gives no rows, and an empty target has no features.
    """
    table = staged(scored(docs, target, rule), "scores")
    may = F.col("n_words") >= rule.least_words
    ranked = radix_rank(table.filter(may).drop("n_words"), [("score", True), ("doc_id", False)], "_place")
    drawn = table.filter(may).count() * rule.percent // 100
    return ranked.withColumn("rank", F.when(F.col("_place") < drawn, F.col("_place") + 1)).drop("_place").unionByName(
        table.filter(~may).drop("n_words").withColumn("rank", F.lit(None).cast("long")))


SQL = """
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(range(0, 8), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i::BIGINT) AS c
    FROM (SELECT unnest(range(0, 256)) AS i))),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS word FROM benchmark),
words AS (SELECT doc_id, unnest(w) AS word FROM d),
feature AS (
  SELECT word, xor(list_reduce(list_transform(range(0, strlen(word)), lambda i:
           ('0x' || substr(hex(encode(word)), 2 * i::INT + 1, 2))::BIGINT), lambda c, x:
           xor(c >> 8, t[(xor(c, x) & 255)::INT + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM b), crc_table),
s AS (SELECT bucket, count(*) AS s FROM words JOIN feature USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN feature USING (word) GROUP BY bucket),
gain AS (SELECT word, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM words) + 10000)
           / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM b) + 10000)))) AS gain
         FROM feature LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weights AS (SELECT doc_id, floor(avg(gain))::BIGINT AS weight FROM words JOIN gain USING (word) GROUP BY doc_id),
scores AS (
  SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::UBIGINT + 0.5::DOUBLE)
      / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= floor(10 * (SELECT count(*) FROM placed) / 100) THEN place END AS rank
FROM scores LEFT JOIN (SELECT doc_id, place FROM placed) USING (doc_id)"""
