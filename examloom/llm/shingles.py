"""Words and word shingles of text blocks as 64-bit hashes, with array operations.

A word's hash is a polynomial of random values of its bytes, taken from running sums over the
block, then mixed; a shingle's combines those of its words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

PIECE = 1 << 20  # bytes hashed at once; a longer word is hashed whole
_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        steps = np.full(max(n, PIECE + 1), base, np.uint64)
        steps[0] = 1
        found = np.cumprod(steps)
        if n <= 4 * PIECE:
            _POWERS[base] = found
    return found[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _piece_words(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words; `breaks`: places where a word ends at the latest."""
    word = ~_SEPARATOR[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = breaks[(breaks > 0) & (breaks < len(data))]
    first[inner] |= word[inner]
    starts = np.flatnonzero(first)
    last = word.copy()
    last[:-1] &= ~word[1:]
    last[inner - 1] |= word[inner - 1]
    ends = np.flatnonzero(last) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(data))[starts]
    return starts, mix(hashes + (ends - starts).astype(np.uint64))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all words of an Arrow text column without nulls, in order."""
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    found, at = [], 0
    while at < len(flat):
        stop = min(len(flat), at + PIECE)
        while stop < len(flat) and not _SEPARATOR[flat[stop]]:
            stop += 1
        starts, hashes = _piece_words(flat[at:stop], ends - at)
        found.append((starts + at, hashes))
        at = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    starts, hashes = (np.concatenate(x) for x in zip(*found))
    return np.searchsorted(ends, starts, "right") - 1, hashes


def shingle_sets(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct k-word shingles of each text, ordered by row and hash.

    A text with fewer words has one shingle, all its words; one without words has none.
    """
    rows, hashes = words(texts)
    counts = np.bincount(rows, minlength=len(texts))
    total = len(hashes)
    combined = hashes.copy()
    for j in range(1, k):
        follow = np.zeros(total, np.uint64)
        follow[:total - j] = hashes[j:]
        same = np.zeros(total, bool)
        same[:total - j] = rows[j:] == rows[:total - j]
        combined = np.where(same, mix(combined * np.uint64(_BASE) + follow), combined)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])
    place = np.arange(total) - begin[rows]
    whole = place + k <= counts[rows]
    short = (counts[rows] < k) & (place == 0)
    keep = whole | short
    rows, combined = rows[keep], combined[keep]
    order = np.lexsort((combined, rows))
    rows, combined = rows[order], combined[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (combined[1:] != combined[:-1])
    return rows[new], combined[new]
