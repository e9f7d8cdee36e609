"""Substring dedup over words: what also starts in a document of smaller id, by suffix automata.

Every window of `WINDOW` words has an anchor, the run of `GRAM` words of least hash in it; equal windows
have equal anchors at the same place.  Windows of one anchor that follow each other make a
segment.  Anchors of a single document hold no repeats and are left out by a bit map.  The other
segments, each different text once with its least document, are the reference: they are dealt into
shards by their anchors, a suffix automaton of each shard is built in a task, and the shard's
segments are streamed through it for matching statistics that know the least document of
every match.  A window is removed from all documents beyond that one.  Automata meet the segments by
key and not by broadcast, as their number grows with the corpus.  An anchor with more
segments than a shard holds is dealt over several; windows that are new to each of those are compared
over shards by digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from examloom.llm import shingles, sketches
from examloom.llm.automaton import NOBODY, SuffixAutomaton
from examloom.llm.common import arrow_rows, attach, blocks, flat_bytes, identified, partitions, staged

WINDOW = 13
GRAM = 5
BATCH_ROWS = 2_000        # sent to Python at once
PIECE_BYTES = 1 << 18     # hashed at once
BATCH_BYTES = 1 << 20     # of texts cut at once
SHARD_WORDS = 20_000      # of reference segments in an automaton
DOCUMENTS = 500           # whose reference segments are cut out together
SLICE = 500               # segments of one anchor in a shard
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28  # of a bit map: 32 MB at most; more anchors only fill it
NO_ID = NOBODY            # null ids are later than all others

_RNG = np.random.Generator(np.random.PCG64(13))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i for i < n; the longest of each base is kept."""
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        steps = np.full(max(n, PIECE_BYTES + 1), base, np.uint64)
        steps[0] = 1
        found = _POWERS[base] = np.cumprod(steps)
    return found[:n]


def _sums(values: np.ndarray, base: int) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers(base, len(values)), out=out[1:])
    return out


def _between(sums: np.ndarray, a: np.ndarray, b: np.ndarray, inverse: int) -> np.ndarray:
    """Polynomial hash of the values a to b, wherever they stand."""
    return (sums[b] - sums[a]) * _powers(inverse, len(sums))[a]


def _words(flat: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text, hash) of the words, in pieces that end where a word ends."""
    at = 0
    while at < len(flat):
        stop = min(len(flat), at + PIECE_BYTES)
        while stop < len(flat) and not _SPACE[flat[stop]]:
            stop += 1
        data = flat[at:stop]
        borders = ends[(ends > at) & (ends < stop)] - at
        word = ~_SPACE[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        first[borders] |= word[borders]
        last[borders - 1] |= word[borders - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
        h = _between(_sums(_BYTE[data], _BASES[0]), start, end, _INVERSES[0])
        yield np.searchsorted(ends, start + at, "right") - 1, shingles.mix(h + (end - start).astype(np.uint64))
        at = stop


def _least(values: np.ndarray, span: int) -> np.ndarray:
    """Index of the least value of each run of `span`, the leftmost of equal ones."""
    n = len(values)
    low = np.uint64((1 << 20) - 1)  # a piece has fewer words
    padded = np.full(-(-n // span) * span, np.uint64(2**64 - 1))
    padded[:n] = (values & ~low) | np.arange(n, dtype=np.uint64)
    table = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(table, axis=1).reshape(-1)
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - span + 1
    return (np.minimum(behind[:m], ahead[span - 1:span - 1 + m]) & low).astype(np.int64)


def segments(flat: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Per piece: text, first word, number of words, anchor hash and two hashes of each segment."""
    seen = np.zeros(len(ends), np.int64)
    text, number, h = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for new_text, new_h in _words(flat, ends):
        counts = np.bincount(new_text, minlength=len(ends))
        place = np.arange(len(new_text)) - (np.cumsum(counts) - counts)[new_text] + seen[new_text]
        seen += counts
        # The last words of the piece before are in front again: their windows were not whole.
        text, number, h = (np.concatenate(x) for x in ((text, new_text), (number, place), (h, new_h)))
        m = len(h) - WINDOW + 1
        if m <= 0:
            continue
        n = len(h) - GRAM + 1
        gram = h[:n]
        for j in range(1, GRAM):
            gram = shingles.mix(gram * np.uint64(_BASES[1]) + h[j:j + n])
        anchor = _least(gram, WINDOW - GRAM + 1)
        starts = np.flatnonzero(text[:m] == text[WINDOW - 1:])
        if len(starts):
            anchor = anchor[starts]
            new = np.ones(len(starts), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (text[starts[1:]] != text[starts[:-1]])
            first = np.flatnonzero(new)
            a, b = starts[first], starts[np.append(first[1:], len(starts)) - 1] + WINDOW
            shape = ((b - a) * 64 + anchor[first] - a).astype(np.uint64)
            ids = [shingles.mix(_between(_sums(h, base), a, b, inverse) + shape)
                   for base, inverse in zip(_BASES, _INVERSES)]
            yield text[a], number[a], b - a, gram[anchor[first]], *ids
        text, number, h = text[m:], number[m:], h[m:]


def _parts(batches, column: int):
    for batch in batches:
        for start, stop in blocks(batch.column(column), PIECE_BYTES):
            part = batch.slice(start, stop - start)
            yield part, segments(*flat_bytes(part.column(column)))


def _spread(h: np.ndarray) -> np.ndarray:
    """Anchors have the least hashes of their windows; this spreads them over a map."""
    return shingles.mix(h + np.uint64(_BASES[0]))


def _map_of(rows: DataFrame) -> np.ndarray:
    """Bit map of a staged table's first column (a long), about sixteen bits a row."""
    wanted = max(LEAST_BITS, min(MOST_BITS, 16 * rows.count()))
    return sketches.bit_map(rows, lambda b: [_spread(b.column(0).to_numpy().view(np.uint64))],
                            1 << (wanted - 1).bit_length())


def _anchor_rows(texts: DataFrame) -> DataFrame:
    """(h, id): each anchor of a text once a piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _parts(batches, 1):
            for text, _, _, h, _, _ in found:
                order = np.lexsort((text, h))
                text, h = text[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[new].view(np.int64)), part.column(0).take(pa.array(text[new]))], ["h", "id"])

    return texts.select("id", "text").mapInArrow(work, "h long, id long")


def _digests(a: np.ndarray, b: np.ndarray) -> pa.Array:
    """Pairs of 64-bit hashes as one binary column."""
    pairs = np.stack([a, b], axis=1)
    return pa.Array.from_buffers(pa.binary(16), len(a), [None, pa.py_buffer(pairs.tobytes())]).cast(pa.binary())


def _segment_rows(texts: DataFrame, bits) -> DataFrame:
    """h, seg, id, text_key, word, n of the segments whose anchor is in the map."""
    names = ["h", "seg", "id", "text_key", "word", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in _parts(batches, 1):
            for text, word, n, h, s1, s2 in found:
                on = np.flatnonzero(sketches.marked(bits.value, _spread(h)))
                at = pa.array(text[on])
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[on].view(np.int64)), _digests(s1[on], s2[on]), part.column(0).take(at),
                    part.column(2).take(at), pa.array(word[on]), pa.array(n[on].astype(np.int32))], names)

    return texts.select("id", "text", "text_key").mapInArrow(
        work, "h long, seg binary, id long, text_key long, word long, n int")


def _meet(texts: DataFrame, lists: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Texts joined with the one row of `lists` (staged) for their id and key, and the texts without
    any.  Only texts whose id may be in `lists`, by a bit map, are shuffled."""
    bits = texts.sparkSession.sparkContext.broadcast(_map_of(lists.select("id")))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = _spread(batch.column(0).to_numpy().view(np.uint64))
            yield batch.append_column("may", pa.array(sketches.marked(bits.value, ids)))

    flagged = texts.mapInArrow(flag, "id long, text string, text_key long, doc_id long, may boolean")
    met = flagged.filter("may").drop("may").join(lists, ["id", "text_key"], "left")
    return met, flagged.filter("NOT may").drop("may")


def _word_pieces(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a text, those of about BATCH_BYTES at a time."""
    at = 0
    while at < len(raw):
        stop = at + BATCH_BYTES
        while stop < len(raw) and not _SPACE[raw[stop]]:
            stop += 1
        yield raw[at:stop].split()
        at = stop


REFERENCE = "h long, slice int, slices int, seg binary, n_rows long, first long, raw binary"


def _reference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted segments of each document, cut out of its words."""
    names = ["h", "slice", "slices", "seg", "n_rows", "first", "raw"]
    for batch in batches:
        batch = batch.filter(pc.greater(pc.fill_null(pc.list_value_length(batch.column(2)), 0), 0))
        for start in range(0, batch.num_rows, DOCUMENTS):
            part = batch.slice(start, DOCUMENTS)
            lists = part.column(2)
            segments_ = lists.flatten()
            row = pc.list_parent_indices(lists)
            word = segments_.field("word")
            order = pc.sort_indices(pa.table({"row": row, "word": word}), [("row", "ascending"), ("word", "ascending")])
            segments_, row = segments_.take(order), row.take(order)
            raws, at = [], 0
            places = list(zip(row.to_pylist(), segments_.field("word").to_pylist(), segments_.field("n").to_pylist()))
            for i, text in enumerate(part.column(1).to_pylist()):
                words, base = [], 0
                for piece in _word_pieces(text.encode()):
                    words += piece
                    while at < len(places) and places[at][0] == i and places[at][1] + places[at][2] <= base + len(words):
                        first = places[at][1] - base
                        raws.append(b" ".join(words[first:first + places[at][2]]))
                        at += 1
                    cut = max(0, len(words) - 2 * WINDOW)
                    base, words = base + cut, words[cut:]
            yield pa.RecordBatch.from_arrays([
                *[segments_.field(name) for name in names[:5]], part.column(0).take(row), pa.array(raws, pa.binary())], names)


def _runs(places: list[int]) -> list[tuple[int, int]]:
    """Words covered by the windows at the places (ascending), as (first word, number)."""
    out: list[tuple[int, int]] = []
    for p in places:
        if out and p <= out[-1][0] + out[-1][1]:
            out[-1] = (out[-1][0], p + WINDOW - out[-1][0])
        else:
            out.append((p, WINDOW))
    return out


JUDGED = ("seg binary, n_rows long, first long, spans array<struct<start:int,size:int>>, "
          "windows array<struct<start:int,window:binary>>")


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """An automaton for each shard of consecutive reference rows, and its rows streamed through it."""
    span = pa.list_(pa.struct([("start", pa.int32()), ("size", pa.int32())]))
    window = pa.list_(pa.struct([("start", pa.int32()), ("window", pa.binary())]))
    names = ["seg", "n_rows", "first", "spans", "windows"]

    def shard(held) -> pa.RecordBatch:
        automaton, out = SuffixAutomaton(), []
        for _, _, _, _, first, words in held:
            automaton.add(words, first)
        automaton.settle()
        for seg, n_rows, slices, _, first, words in held:
            owners = automaton.least_owners(words, WINDOW)
            new = [i for i, owner in enumerate(owners) if owner >= first] if slices > 1 else []
            out.append((seg, n_rows, first, _runs([i for i, owner in enumerate(owners) if owner < first]),
                        [(i, hashlib.blake2b(b" ".join(words[i:i + WINDOW]), digest_size=16).digest()) for i in new]))
        kinds = [pa.binary(), pa.int64(), pa.int64(), span, window]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    held, size, last = [], 0, None
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(7)]
        for h, part, slices, seg, n_rows, first, raw in zip(*columns):
            if (h, part) != last and size >= SHARD_WORDS:
                yield shard(held)
                held, size = [], 0
            words = raw.split()
            held.append((seg, n_rows, slices, part, first, words))
            size, last = size + len(words), (h, part)
    if held:
        yield shard(held)


def _compared(judged: DataFrame) -> DataFrame:
    """Spans of anchors that lie in several shards: windows new to each, but not the first of all."""
    rows = staged(judged.select("seg", "first", F.inline("windows")), "new-windows")
    if not rows.limit(1).count():
        return judged.drop("windows")
    least = staged(rows.groupBy("window").agg(F.min("first").alias("least"), F.count("*").alias("_n")), "least")
    late = attach(rows, least, "window", "_n").filter("first > least")
    more = late.groupBy("seg").agg(F.collect_set(  # at most the windows of one segment
        F.struct("start", F.lit(WINDOW).alias("size"))).alias("more"))
    return judged.drop("windows").join(more, "seg", "left").withColumn(
        "spans", F.concat("spans", F.coalesce("more", F.array().cast(judged.schema["spans"].dataType)))).drop("more")


def repeats(texts: DataFrame) -> DataFrame:
    """(id, text_key, start, size): runs of words that are repeats; they may overlap."""
    context = texts.sparkSession.sparkContext
    again = staged(_anchor_rows(texts).groupBy("h").agg(F.min("id").alias("a"), F.max("id").alias("b"))
                   .filter("a < b").select("h"), "anchors")
    rows = staged(_segment_rows(texts, context.broadcast(_map_of(again))), "segments")
    groups = staged(rows.groupBy("h", "seg").agg(
        F.min(F.struct("id", "text_key", "word", "n")).alias("at"), F.max("id").alias("last"),
        F.count("*").alias("n_rows")), "segment-groups")
    alive = staged(groups.groupBy("h").agg(F.min("at.id").alias("a"), F.max("last").alias("b"), F.count("*").alias("_variants"))
                   .filter("a < b").select("h", "_variants", F.ceil(F.col("_variants") / SLICE).cast("int").alias("slices")), "alive")
    wanted = attach(groups.drop("last"), alive, "h", "_variants").select(
        "at.id", "at.text_key", F.struct(
            "h", F.pmod(F.xxhash64("seg"), "slices").cast("int").alias("slice"), "slices", "seg", "n_rows",
            "at.word", "at.n").alias("segment"))
    lists = staged(wanted.groupBy("id", "text_key").agg(F.collect_list("segment").alias("wanted")), "wanted")  # of one document
    met, _ = _meet(texts, lists, "wanted")
    reference = met.select("id", "text", "wanted").mapInArrow(_reference, REFERENCE)
    shards = reference.repartition(partitions(texts.sparkSession), "h", "slice").sortWithinPartitions("h", "slice", "seg")
    judged = _compared(staged(shards.mapInArrow(_judge, JUDGED), "judged"))
    verdicts = staged(judged.withColumnRenamed("n_rows", "_n"), "verdicts")
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("size")))
    marked = attach(rows.drop("h"), verdicts, "seg", "_n").select(
        "id", "text_key", "word", F.inline(F.when(F.col("id") > F.col("first"), whole).otherwise(F.col("spans"))))
    return marked.select("id", "text_key", (F.col("word") + F.col("start")).alias("start"), "size")


RESULT = "doc_id long, n_words long, n_removed long, kept string"


def _cut_one(text: str, spans) -> tuple[int, int, str]:
    raw = text.encode()
    if not spans:
        count, parts = 0, []
        for words in _word_pieces(raw):
            count += len(words)
            parts.append(b" ".join(words))
        return count, 0, b" ".join(p for p in parts if p).decode()
    runs = sorted((s["start"], s["start"] + s["size"]) for s in spans)
    count, removed, parts, at = 0, 0, [], 0
    for words in _word_pieces(raw):
        keep = np.ones(len(words), bool)
        end = count + len(words)
        while at < len(runs) and runs[at][0] < end:
            keep[max(0, runs[at][0] - count):max(0, runs[at][1] - count)] = False
            if runs[at][1] > end:  # goes on in the next piece
                runs[at] = (end, runs[at][1])
                break
            at += 1
        count, removed = end, removed + int(len(words) - keep.sum())
        parts += [w for w, k in zip(words, keep.tolist()) if k]
    return count, removed, b" ".join(parts).decode()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, stop in blocks(batch.column(1), BATCH_BYTES):
            part = batch.slice(start, stop - start)
            spans = part.column(2).to_pylist() if part.num_columns > 2 else [None] * part.num_rows
            n, removed, kept = zip(*map(_cut_one, part.column(1).to_pylist(), spans))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"])


def remove(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the kept words, joined by one space).

    Words are runs without white space, as they are.  Null texts have no words.  Null ids are later than
    all others and not than each other; documents of one id never cut each other.  Very long texts are
    read in pieces.  Other columns are not read; an empty table gives no rows.
    """
    texts = identified(docs, NO_ID)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        spans = staged(repeats(texts).groupBy("id", "text_key").agg(
            F.collect_set(F.struct("start", "size")).alias("spans")), "word-spans")  # of one document each
    met, plain = _meet(texts, spans, "spans")
    return met.select("doc_id", "text", "spans").mapInArrow(_cut, RESULT).unionByName(
        plain.select("doc_id", "text").mapInArrow(_cut, RESULT))
