"""Long repeats: bytes covered by a string of `LENGTH` bytes that also starts earlier.

Every such string has an anchor: of its `GRAM`-byte strings the one of least hash.  Equal strings
have equal anchors at the same place, so only texts around anchors that occur again can hold
repeats.  The strings that share one anchor make a segment of `LENGTH` to 2 * LENGTH - GRAM
bytes.  Equal segments are grouped: all but the earliest are repeats as a whole.  Different
segments of one anchor text meet in a task, in blocks of bounded size, where a run-compressed
Burrows-Wheeler index of earlier segments is built and later ones are streamed through it for
their matching statistics; places that match for `LENGTH` bytes or more are repeats.
An anchor text with more segments than a block takes is split, and what each block finds to be
first is compared over blocks by digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from examloom.llm import shingles, sketches
from examloom.llm.common import arrow_rows, attach, blocks, partitions, staged
from examloom.llm.run_index import RunIndex

LENGTH = 100
GRAM = 32
PIECE_BYTES = 1 << 18    # of texts looked at together
HASHED_BYTES = 1 << 16   # hashed at once: few enough for a processor's cache
INDEX_BYTES = 1 << 19    # segments looked at together
CLASSES = 4              # of places in a segment
SLICE = 1_000            # segments of one anchor text that meet in a block
MAP_BITS = 1 << 26       # 8 MB; more anchors only fill it
DOCUMENT_BITS = 1 << 24
BATCH_ROWS = 2_000       # sent to Python at once
ROWS = 2_000             # held as objects before they are written, or after they are read
NO_ID = (1 << 63) - 1    # null ids are later than all others


def _texts(docs: DataFrame) -> DataFrame:
    """id, text, text_key, doc_id.  The key tells documents of one id apart; where all ids are
    unique it is 0 and takes no room."""
    text = F.coalesce(F.col("`text`").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col("`doc_id`").cast("long"), F.lit(NO_ID)).alias("id"),
                       text.alias("text"), F.col("`doc_id`").cast("long").alias("doc_id"))
    repeated = rows.groupBy("id").count().filter("count > 1").limit(1).count()
    return rows.select("id", "text", (F.xxhash64("text") if repeated else F.lit(0).cast("long")).alias("text_key"),
                       "doc_id")


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return flat, ends - ends[0]


def anchors(flat: np.ndarray, ends: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """(document, start, end, anchor place, anchor hash) of the segments in concatenated texts.

    Worked on in overlapping pieces; the strings of one anchor that two pieces hold become
    one segment again.
    """
    found = []
    span = length - gram + 1
    total = len(flat)
    powers, inverse = shingles._powers(shingles._BASE, HASHED_BYTES + length), shingles._powers(
        shingles._INVERSE, HASHED_BYTES + length)
    low = np.uint64((1 << 20) - 1)
    for begin in range(0, max(0, total - length + 1), HASHED_BYTES):
        data = flat[begin:min(total, begin + HASHED_BYTES + length - 1)]
        n, m = len(data) - gram + 1, len(data) - length + 1
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(RAW[data] * powers[:len(data)], out=sums[1:])
        h = shingles.mix((sums[gram:] - sums[:n]) * inverse[:n])
        # Least (hash, place) of each run of `span` grams: of 2, 4, ... of them, then of two runs that overlap.
        value, width = (h & ~low) | np.arange(n, dtype=np.uint64), 1
        while 2 * width <= span:
            value, width = np.minimum(value[:-width], value[width:]), 2 * width
        if width < span:
            value = np.minimum(value[:width - span], value[span - width:])
        place = (value & low).astype(np.int64)
        # The documents that the piece's strings start in, and the strings that end there as well.
        a, b = np.searchsorted(ends, begin, "right") - 1, np.searchsorted(ends, begin + m - 1, "right")
        starting = np.diff(np.clip(ends[a:b + 1], begin, begin + m))
        at = np.flatnonzero(np.arange(begin, begin + m) + length <= np.repeat(ends[a + 1:b + 1], starting))
        if not len(at):
            continue
        doc, place = np.repeat(np.arange(a, b), starting)[at], place[at]
        new = np.ones(len(at), bool)
        new[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        found.append((doc[first], at[first] + begin, at[last] + begin + length, place[first] + begin, h[place[first]]))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    doc, start, end, place, hashes = (np.concatenate(x) for x in zip(*found))
    joined = np.zeros(len(doc), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1])
    keep = np.flatnonzero(~joined)
    return doc[keep], start[keep], end[np.append(keep[1:], len(doc)) - 1], place[keep], hashes[keep]


RAW = np.random.Generator(np.random.PCG64(7)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _parts(batches, text: int):
    for batch in batches:
        for start, stop in blocks(batch.column(text), PIECE_BYTES):
            part = batch.slice(start, stop - start)
            yield part, *_bytes(part.column(text))


def _spread(h: np.ndarray) -> np.ndarray:
    """Anchors have the least hashes of their places; this spreads them over a map."""
    return shingles.mix(h + np.uint64(0x9E3779B97F4A7C15))


def _segment_ids(flat, start, end, place) -> list[bytes]:
    """128-bit digests of segments and the place of the anchor in them."""
    raw = flat.tobytes()
    return [hashlib.blake2b(raw[a:b], digest_size=16, salt=int(p - a).to_bytes(2, "little")).digest()
            for a, b, p in zip(start.tolist(), end.tolist(), place.tolist())]


def _anchor_rows(texts: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, ends in _parts(batches, 0):
            yield pa.RecordBatch.from_arrays([pa.array(anchors(flat, ends)[4].view(np.int64))], ["h"])

    return texts.select("text").mapInArrow(work, "h long")


def _segment_rows(texts: DataFrame, bits) -> DataFrame:
    """Segments whose anchor is in the map: h, seg (digest), id, text_key, start, size."""
    names = ["h", "seg", "id", "text_key", "start", "size"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, flat, ends in _parts(batches, 1):
            doc, start, end, place, h = anchors(flat, ends)
            on = sketches.marked(bits.value, _spread(h))
            doc, start, end, place, h = doc[on], start[on], end[on], place[on], h[on]
            at = pa.array(doc)
            yield pa.RecordBatch.from_arrays([
                pa.array(h.view(np.int64)), pa.array(_segment_ids(flat, start, end, place), pa.binary()),
                part.column(0).take(at), part.column(2).take(at), pa.array(start - ends[doc]),
                pa.array((end - start).astype(np.int32))], names)

    return texts.select("id", "text", "text_key").mapInArrow(
        work, "h long, seg binary, id long, text_key long, start long, size int")


def _segment_bytes(texts: DataFrame, bits) -> DataFrame:
    """seg, anchor (its place in the segment), raw of the segments whose anchor is in the map."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, flat, ends in _parts(batches, 0):
            _, start, end, place, h = anchors(flat, ends)
            on = sketches.marked(bits.value, _spread(h))
            start, end, place = start[on], end[on], place[on]
            raw, seen = flat.tobytes(), {}
            for seg, a, b, p in zip(_segment_ids(flat, start, end, place), start.tolist(), end.tolist(), place.tolist()):
                seen.setdefault(seg, (p - a, raw[a:b]))
            yield pa.RecordBatch.from_arrays([
                pa.array(list(seen), pa.binary()), pa.array([x[0] for x in seen.values()], pa.int32()),
                pa.array([x[1] for x in seen.values()], pa.binary())], ["seg", "anchor", "raw"])

    return texts.select("text").mapInArrow(work, "seg binary, anchor int, raw binary")


def repeated_places(segments: list[tuple[int, int, bytes]], length: int = LENGTH) -> list[np.ndarray]:
    """For segments (bucket, anchor, raw), ordered by bucket and then by time: whether the string
    of `length` bytes at each place also stands in an earlier segment of the bucket.

    Buckets are halved again and again in time: at each scale, the earlier half of every group
    is indexed and the later half streamed.  The anchor's first byte becomes a symbol of the group,
    so that segments of other groups, or out of line, cannot match.
    """
    found = [np.zeros(len(raw) - length + 1, bool) for _, _, raw in segments]
    bucket = np.array([b for b, _, _ in segments])
    begin = np.concatenate([[True], bucket[1:] != bucket[:-1]])
    first = np.flatnonzero(begin)
    place = np.arange(len(bucket)) - first[np.cumsum(begin) - 1]
    largest = int(place.max()) + 1
    symbols = [np.frombuffer(raw, np.uint8) for _, _, raw in segments]
    half = 1
    while half < largest:
        group = place // (2 * half)
        late = (place // half) % 2 == 1
        key = bucket * np.int64(largest + 1) + group
        used = np.isin(key, key[late])
        names = {k: 256 + i for i, k in enumerate(np.unique(key[used]).tolist())}

        def grouped(i):
            out = symbols[i].astype(np.int32)
            out[segments[i][1]] = names[int(key[i])]
            return out

        early_rows, late_rows = np.flatnonzero(used & ~late), np.flatnonzero(late)
        index = RunIndex([grouped(i) for i in early_rows], 256 + len(names))
        matched = index.matching([grouped(i) for i in late_rows]) >= length
        for row, i in enumerate(late_rows):
            found[i] |= matched[row, :len(found[i])]
        half *= 2
    return found


def places_of_segments(segments: list[tuple[int, int, bytes]], length: int = LENGTH,
                       gram: int = GRAM) -> list[np.ndarray]:
    """As `repeated_places`, for whole segments, of which few need the index.

    The places of a segment fall into classes by how far the string reaches to the left of
    the anchor.  All strings of a class hold one core, so only segments with equal cores can
    match there; where the class's whole stretch is equal as well, the later is a repeat.
    """
    found = [np.zeros(len(raw) - length + 1, bool) for _, _, raw in segments]
    reach = length - gram
    step = -(-(reach + 1) // CLASSES)
    bounds = [(l, min(l + step - 1, reach)) for l in range(0, reach + 1, step)]
    groups: dict[tuple, dict] = {}
    for i, (bucket, anchor, raw) in enumerate(segments):
        for least, most in bounds:
            start, stop = max(0, anchor - most), min(len(raw) - length, anchor - least)
            if start > stop:
                continue
            stretches = groups.setdefault((bucket, most, raw[anchor - least:anchor + length - most]), {})
            if stretches.setdefault((anchor - start, raw[start:stop + length]), (i, start))[0] != i:
                found[i][start:stop + 1] = True
    met = [(n, at, stretch, i, start) for n, stretches in enumerate(groups.values()) if len(stretches) > 1
           for (at, stretch), (i, start) in stretches.items()]
    if met:
        for (_, _, _, i, start), places in zip(met, repeated_places([m[:3] for m in met], length)):
            found[i][start:start + len(places)] |= places
    return found


def _intervals(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Joined (start, end) of the strings at the marked places."""
    at = np.flatnonzero(places)
    if not len(at):
        return []
    new = np.concatenate([[True], at[1:] > at[:-1] + length])
    first = np.flatnonzero(new)
    return [(int(at[a]), int(at[b]) + length) for a, b in zip(first, np.append(first[1:], len(at)) - 1)]


def _resolve(length: int):
    names = ["id", "text_key", "start", "size", "window"]

    def rows(spans, windows) -> pa.RecordBatch:
        """Runs of repeats without, single strings with their digest."""
        out = spans + windows
        columns = list(zip(*out)) if out else [[]] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)

    def block(held) -> Iterator[pa.RecordBatch]:
        spans, windows = [], []
        numbers: dict[tuple[int, int], int] = {}
        segments = [(numbers.setdefault(key, len(numbers)), anchor, raw) for key, _, _, _, _, anchor, raw in held]
        for (_, slices, id_, text_key, start, _, raw), places in zip(held, places_of_segments(segments, length)):
            for a, b in _intervals(places, length):
                spans.append((id_, text_key, start + a, b - a, None))
            if slices > 1:
                for a in np.flatnonzero(~places).tolist():
                    windows.append((id_, text_key, start + a, length,
                                    hashlib.blake2b(raw[a:a + length], digest_size=16).digest()))
                if len(windows) >= ROWS:
                    yield rows([], windows)
                    windows = []
        yield rows(spans, windows)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):  # few rows as objects at a time
                part = whole.slice(at, ROWS)
                for h, piece, slices, id_, text_key, start, anchor, raw in zip(*(c.to_pylist() for c in part.columns)):
                    if (h, piece) != last and size >= INDEX_BYTES:
                        yield from block(held)
                        held, size = [], 0
                    last = (h, piece)
                    held.append((last, slices, id_, text_key, start, anchor, raw))
                    size += len(raw)
        if held:
            yield from block(held)

    return work


def _earliest(*more: str) -> Column:
    return F.struct("id", "text_key", "start", *more)


def repeats(texts: DataFrame) -> DataFrame:
    """(id, text_key, start, size): runs of bytes that are repeats; they may overlap."""
    spark = texts.sparkSession

    def ids(batch):
        return [_spread(batch.column(0).to_numpy().view(np.uint64))]

    again = _anchor_rows(texts).groupBy("h").count().filter("count > 1").select("h")
    bits = spark.sparkContext.broadcast(sketches.bit_map(again, ids, MAP_BITS))
    rows = staged(_segment_rows(texts, bits), "segments")
    groups = staged(rows.groupBy("h", "seg").agg(
        F.min(_earliest()).alias("first")), "segment-groups")
    # Every segment that is not the first of its group is a repeat; places are unique, so no
    # group's size matters here.
    marks = rows.select("id", "text_key", "start", "size").join(
        groups.select("first.*"), ["id", "text_key", "start"], "left_anti")

    several = staged(groups.groupBy("h").agg(F.count("*").alias("_variants")).filter("_variants > 1"), "several")
    bits = spark.sparkContext.broadcast(sketches.bit_map(several.select("h"), ids, MAP_BITS))
    raw = _segment_bytes(texts, bits).groupBy("seg").agg(F.first("anchor").alias("anchor"), F.first("raw").alias("raw"))
    slices = F.ceil(F.col("variants") / SLICE).cast("int")
    variants = attach(groups.select("h", "seg", "first"), several.withColumn("variants", F.col("_variants")), "h", "_variants")
    variants = variants.join(raw, "seg").select(
        "h", F.pmod(F.xxhash64("seg"), slices).cast("int").alias("slice"), slices.alias("slices"),
        *[F.col(f"first.{c}").alias(c) for c in ("id", "text_key", "start")], "anchor", "raw")
    met = variants.repartition(partitions(spark), "h", "slice").sortWithinPartitions(
        "h", "slice", "id", "text_key", "start")
    resolved = staged(met.mapInArrow(
        _resolve(LENGTH), "id long, text_key long, start long, size int, window binary"), "resolved")
    marks = marks.unionByName(resolved.filter("window IS NULL").drop("window"))

    # Strings first in their block of a split anchor text: repeats, but for the first of all blocks.
    firsts = resolved.filter("window IS NOT NULL")
    least = staged(firsts.groupBy("window").agg(F.min(_earliest()).alias("first"), F.count("*").alias("_n"))
                   .filter("_n > 1"), "split-strings")
    late = attach(firsts, least, "window", "_n").filter(_earliest() != F.col("first"))
    return staged(marks.unionByName(late.select("id", "text_key", "start", "size")), "repeats")


def _kept(text: str, spans) -> tuple[int, int, int, bytes]:
    raw = text.encode()
    parts, at, removed, runs, run_end = [], 0, 0, 0, None
    for start, size in sorted(spans):
        end = start + size
        if end <= at and runs:
            continue
        if run_end is None or start > run_end:
            parts.append(raw[at:start])
            runs += 1
            removed += size
        else:
            removed += end - run_end
        at = run_end = end
    parts.append(raw[at:])
    return len(raw), removed, runs, b"".join(parts)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]
    for batch in batches:
        for start, stop in blocks(batch.column(1), PIECE_BYTES):
            part = batch.slice(start, stop - start)
            done = [_kept(text, [(s["start"], s["size"]) for s in spans or ()])
                    for text, spans in zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
            n, removed, runs, kept = zip(*done)
            yield pa.RecordBatch.from_arrays([
                part.column(0), pa.array(n), pa.array(removed), pa.array(runs), pa.array(kept, pa.binary())], names)


def remove(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Null texts are empty.  Null ids are later than all others; documents of one id are ordered
    by a hash of their texts, and rows equal in id and text are one document.  An empty
    table gives no rows.
    """
    texts = _texts(docs)
    with arrow_rows(docs.sparkSession, BATCH_ROWS):
        marks = repeats(texts)
        spans = staged(marks.groupBy("id", "text_key").agg(
            F.collect_set(F.struct("start", "size")).alias("spans")), "spans")  # of one document each
    bits = docs.sparkSession.sparkContext.broadcast(sketches.bit_map(
        spans.select("id"), lambda b: [_id_hash(b.column(0))], DOCUMENT_BITS))

    def has_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("marked", pa.array(sketches.marked(bits.value, _id_hash(batch.column(0)))))

    # Only texts with marks are shuffled to meet them.
    flagged = texts.mapInArrow(
        has_marks, "id long, text string, text_key long, doc_id long, marked boolean")
    plain = flagged.filter("NOT marked").select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    met = flagged.filter("marked").join(spans, ["id", "text_key"], "left").select("doc_id", "text", "spans")
    return plain.mapInArrow(_cut, RESULT).unionByName(met.mapInArrow(_cut, RESULT))


def _id_hash(ids: pa.Array) -> np.ndarray:
    return _spread(ids.to_numpy().view(np.uint64))
