"""Byte-level BPE by DuckDB recursive queries inside each task.

A task splits its texts with the tokenizer's pattern and encodes every different piece once:
a recursive query keeps token-position rows, looks their pairs up in the merge table and, at
each step, contracts every piece's leftmost pair of minimum rank, until no pair is left.
Ids are decoded by joining them with the vocabulary and an aggregation in their order.
No shuffle; a task holds a block of text, the vocabulary and two caches of pieces, of bounded size.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from examloom.llm.common import arrow_rows, blocks, staged

BLOCK_BYTES = 1 << 19     # texts worked on together
BATCH_ROWS = 500          # rows a task in Python gets at once
PIECES_AT_ONCE = 200_000  # matches of one text taken at once
BYTES_AT_ONCE = 1 << 17   # bytes of pieces in one recursive query
CACHE_PIECES = 200_000    # pieces from which a worker's cache grows old; the one before it is dropped
LONG_PIECE = 64           # bytes from which equal pairs of a piece are contracted together
DECODE_ROWS = 1 << 18     # ids decoded in one query
DECODE_RUN = 1 << 16      # ids of one text aggregated as one string

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])
DIGESTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

# Rows: piece w, position, token, position and token of the next row, id of the pair's token.
RECURSION = """
WITH RECURSIVE s AS (
  SELECT t.w, pos, tok, npos, nxt, m, false AS done FROM start t LEFT JOIN merges ON l = tok AND r = nxt
  UNION ALL
  SELECT * FROM (
  WITH best AS (SELECT w, min((m::BIGINT << 32) + pos) AS b FROM s WHERE NOT done GROUP BY w),
  {step}
  SELECT w, pos, tok, npos, nxt, m, false FROM next LEFT JOIN merges ON l = tok AND r = nxt
  UNION ALL
  SELECT s.w, s.pos, s.tok, s.npos, s.nxt, NULL, true FROM s JOIN best ON s.w = best.w
  WHERE b IS NULL AND NOT done)
)
SELECT w, pos, tok FROM s WHERE done ORDER BY w, pos"""
ENCODE = RECURSION.format(step="""
  hit AS (SELECT s.w, s.pos AS p, s.npos AS q, s.m AS merged FROM s JOIN best ON s.w = best.w
          WHERE s.pos = (best.b & 4294967295)),
  pair AS (SELECT hit.*, s.nxt AS qnxt, s.npos AS qnpos FROM hit JOIN s ON s.w = hit.w AND s.pos = hit.q),
  next AS (SELECT s.w, s.pos, CASE WHEN s.pos = p THEN merged ELSE s.tok END AS tok,
                  CASE WHEN s.pos = p THEN qnpos ELSE s.npos END AS npos,
                  CASE WHEN s.pos = p THEN qnxt WHEN s.npos = p THEN merged ELSE s.nxt END AS nxt
           FROM s JOIN pair ON s.w = pair.w WHERE s.pos <> q)""")
# For long pieces: all places of the minimum rank, every second one where they overlap; only
# the leftmost if the new token could form a pair of a lower rank (`risky`).
ENCODE_LONG = RECURSION.format(step="""
  spot AS (SELECT s.w, s.pos, s.npos, s.m, best.b & 4294967295 AS leftmost,
                  coalesce(lag(s.npos) OVER (PARTITION BY s.w ORDER BY s.pos) <> s.pos, true) AS opens
           FROM s JOIN best ON s.w = best.w WHERE s.m = best.b >> 32),
  run AS (SELECT *, sum(opens::INT) OVER (PARTITION BY w ORDER BY pos) AS run FROM spot),
  nth AS (SELECT *, row_number() OVER (PARTITION BY w, run ORDER BY pos) AS k FROM run),
  hit AS (SELECT w, pos AS p, npos AS q, m AS merged FROM nth LEFT JOIN risky ON id = m
          WHERE CASE WHEN id IS NULL THEN k % 2 = 1 ELSE pos = leftmost END),
  pair AS (SELECT hit.*, s.nxt AS qnxt, s.npos AS qnpos FROM hit JOIN s ON s.w = hit.w AND s.pos = hit.q),
  kept AS (SELECT s.* FROM s JOIN best ON s.w = best.w ANTI JOIN pair ON s.w = pair.w AND s.pos = pair.q
           WHERE b IS NOT NULL AND NOT done),
  own AS (SELECT kept.w, pos, coalesce(pair.merged, tok) AS tok,
                 CASE WHEN merged IS NULL THEN npos ELSE qnpos END AS npos,
                 CASE WHEN merged IS NULL THEN nxt ELSE qnxt END AS nxt
          FROM kept LEFT JOIN pair ON kept.w = pair.w AND kept.pos = pair.p),
  next AS (SELECT own.w, own.pos, own.tok, own.npos, coalesce(pair.merged, own.nxt) AS nxt
           FROM own LEFT JOIN pair ON own.w = pair.w AND own.npos = pair.p)""")
DECODE = """
SELECT doc, run, string_agg(chars, '' ORDER BY pos) AS text
FROM ids JOIN vocabulary USING (id) GROUP BY doc, run ORDER BY doc, run"""


class Codec:
    """Encoder and decoder of one worker, on a DuckDB connection of its own."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.con = duckdb.connect(config={
            "threads": 1, "memory_limit": "300MB",
            # What a query has freed goes back to the system, not to the next query.
            "allocator_flush_threshold": "1MB", "allocator_bulk_deallocation_flush_threshold": "1MB"})
        self.con.execute("SET preserve_insertion_order = false")
        left, right, merged = array("i"), array("i"), array("i")
        for t, i in self.ranks.items():
            for k in range(1, len(t)):
                l, r = self.ranks.get(t[:k]), self.ranks.get(t[k:])
                if l is not None and r is not None:
                    left.append(l), right.append(r), merged.append(i)
        self._table("merges", **{c: np.frombuffer(x, np.int32) for c, x in zip("lrm", (left, right, merged))})
        self.con.execute("""CREATE TABLE risky AS
            SELECT a.m AS id FROM merges a JOIN merges b ON b.l = a.m WHERE b.m < a.m
            UNION SELECT a.m FROM merges a JOIN merges b ON b.r = a.m WHERE b.m < a.m""")
        self._table("vocabulary", id=pa.array(list(self.ranks.values()), pa.int32()),
                    chars=pa.array([t.decode("latin-1") for t in self.ranks]))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.cache: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}  # the cache before it; what is found there moves over

    def _table(self, name: str, **columns):
        self.con.register("given", pa.table(columns))
        self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")

    def _contract(self, pieces: list[bytes], sql: str) -> list[bytes]:
        """Ids of pieces, as little-endian 32-bit numbers."""
        sizes = np.array([len(p) for p in pieces])
        ends = np.cumsum(sizes)
        flat = np.frombuffer(b"".join(pieces), np.uint8)
        pos = np.arange(len(flat), dtype=np.int64)
        w = np.repeat(np.arange(len(pieces), dtype=np.int32), sizes)
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        tok = self.single[flat]
        start = pa.table({
            "w": w, "pos": pos, "tok": tok, "npos": np.where(last, -1, pos + 1),
            "nxt": np.where(last, -1, np.roll(tok, -1)).astype(np.int32)})
        self.con.register("start", start)
        out = self.con.execute(sql).fetchnumpy()
        self.con.unregister("start")
        cuts = np.searchsorted(out["w"], np.arange(len(pieces) + 1))
        ids = np.ascontiguousarray(out["tok"], "<u4").tobytes()
        return [ids[4 * a:4 * b] for a, b in zip(cuts[:-1], cuts[1:])]

    def _learn(self, pieces: set[str]) -> None:
        """See that the cache holds the ids of all these pieces."""
        if len(self.cache) >= CACHE_PIECES:
            self.cache, self.older = {}, self.cache
        open_pieces = []
        for piece in pieces.difference(self.cache):
            if known := self.older.get(piece):
                self.cache[piece] = known
                continue
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is None:
                open_pieces.append((len(raw), piece, raw))
            else:
                self.cache[piece] = whole.to_bytes(4, "little")
        open_pieces.sort()  # pieces of like length take like numbers of steps
        block, size = [], 0
        for i, (n, piece, raw) in enumerate(open_pieces):
            block.append((piece, raw))
            size += n
            more = open_pieces[i + 1][0] if i + 1 < len(open_pieces) else None
            if size >= BYTES_AT_ONCE or more is None or (n < LONG_PIECE <= more):
                sql = ENCODE_LONG if n >= LONG_PIECE else ENCODE
                for (p, _), ids in zip(block, self._contract([r for _, r in block], sql)):
                    self.cache[p] = ids
                block, size = [], 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        out = [b""] * len(texts)
        short = {i: self.pattern.findall(t) for i, t in enumerate(texts) if len(t) <= PIECES_AT_ONCE}
        self._learn({p for found in short.values() for p in found})
        for i, found in short.items():
            out[i] = b"".join(map(self.cache.__getitem__, found))
        for i, text in enumerate(texts):
            if i not in short:
                matches, parts = (m[0] for m in self.pattern.finditer(text)), []
                while found := list(islice(matches, PIECES_AT_ONCE)):
                    self._learn(set(found))
                    parts.append(b"".join(map(self.cache.__getitem__, found)))
                out[i] = b"".join(parts)
        return out

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """The bytes that the ids of each text stand for."""
        parts: list[list[bytes]] = [[] for _ in encoded]
        block, rows = [], 0
        for doc, ids in enumerate(encoded):
            for run, at in enumerate(range(0, len(ids), 4 * DECODE_RUN)):
                found = np.frombuffer(ids, "<u4", min(DECODE_RUN, len(ids) // 4 - at // 4), at)
                block.append((doc, run, found))
                rows += len(found)
                if rows >= DECODE_ROWS:
                    self._decode(block, parts)
                    block, rows = [], 0
        if block:
            self._decode(block, parts)
        return [b"".join(p) for p in parts]

    def _decode(self, block, parts) -> None:
        sizes = [len(ids) for _, _, ids in block]
        n = sum(sizes)
        self.con.register("ids", pa.table({
            "doc": np.repeat(np.array([b[0] for b in block], np.int32), sizes),
            "run": np.repeat(np.array([b[1] for b in block], np.int32), sizes),
            "pos": np.arange(n, dtype=np.int32),
            "id": np.concatenate([b[2] for b in block]).astype(np.int32)}))
        for doc, _, text in self.con.execute(DECODE).fetchall():
            parts[doc].append(text.encode("latin-1"))
        self.con.unregister("ids")


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec; later tasks of a reused worker find its cache filled."""
    if (path, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


TRAINING = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("exact", T.BooleanType())])


def _run(docs: DataFrame, path: str, pattern: str, row, schema) -> DataFrame:
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for batch in batches:
            for start, stop in blocks(batch.column(1), BLOCK_BYTES):
                doc_ids, texts = (batch.column(i).slice(start, stop - start).to_pylist() for i in (0, 1))
                encoded = own.encode(texts)
                decoded = own.decode(encoded)
                columns = zip(*[row(*x) for x in zip(doc_ids, texts, encoded, decoded)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), t) for c, t in zip(columns, types)], names)

    kinds = {"long": pa.int64(), "bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(),
             "boolean": pa.bool_()}
    types = [kinds[f.dataType.typeName()] for f in schema.fields]
    rows = docs.select(F.col("`doc_id`").cast("long").alias("doc_id"),
                       F.coalesce(F.col("`text`").cast("string"), F.lit("")).alias("text"))
    with arrow_rows(docs.sparkSession, BATCH_ROWS):  # it holds when rows are made, so they are staged
        return staged(rows.mapInArrow(work, schema), "byte-bpe")


def _whole(doc_id, text: str, ids: bytes, decoded: bytes):
    return doc_id, len(ids) // 4, ids, decoded


def _digested(doc_id, text: str, ids: bytes, decoded: bytes):
    return doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


def _training(doc_id, text: str, ids: bytes, decoded: bytes):
    return doc_id, len(ids) // 4, ids, decoded == text.encode()


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit), decoded bytes.

    `path` names a file of ranks that every executor can open, `pattern` the split into
    pieces.  Null texts count as empty and give no ids.  Rows are independent of each other, so
    null and repeated ids are passed on; an empty table gives no rows.  The result is staged.
    """
    return _run(docs, path, pattern, _whole, SCHEMA)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As `encode_documents`, with the digests of ids and decoded bytes in their place."""
    return _run(docs, path, pattern, _digested, DIGESTS)


def training_rows(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """As `encode_documents`, with a flag that the ids decode to the text in place of the bytes."""
    return _run(docs, path, pattern, _training, TRAINING)
