"""A run-compressed Burrows-Wheeler index over segments, and matching statistics against it.

Symbols are small integers.  Every segment ends in a symbol of its own, so no match reaches
across segments.  The index keeps the runs of the transform, where each leads (LF), and the
text position at both ends of each run; all patterns are streamed through it at once, one
symbol per step from their ends, each with a row, a text position and a match length.
"""

from __future__ import annotations

import numpy as np


class RunIndex:
    def __init__(self, segments: list[np.ndarray], alphabet: int):
        """`segments`: symbols below `alphabet`."""
        longest = max(map(len, segments)) + 1
        text = np.concatenate([np.append(s, alphabet + i) for i, s in enumerate(segments)]).astype(np.int32)
        n = len(text)
        # Ranks of all substrings of 1, 2, 4, ... symbols; the last tell all suffixes apart.
        self.ranks = [np.unique(text, return_inverse=True)[1].astype(np.int32)]
        width = 1
        while width < longest:
            pair = self.ranks[-1].astype(np.int64) * (n + 2)
            pair[:n - width] += self.ranks[-1][width:] + 1
            self.ranks.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
            width *= 2
        suffixes = np.empty(n, np.int32)
        suffixes[self.ranks[-1]] = np.arange(n, dtype=np.int32)
        bwt = text[suffixes - 1]
        self.start = np.flatnonzero(np.concatenate([[True], bwt[1:] != bwt[:-1]]))
        ends = np.append(self.start[1:], n) - 1
        self.symbol = bwt[self.start]
        self.first, self.last, self.end = suffixes[self.start].astype(np.int64), suffixes[ends].astype(np.int64), ends
        order = np.lexsort((self.start, self.symbol))
        lengths = ends - self.start + 1
        self.leads = np.empty(len(order), np.int64)
        self.leads[order] = np.cumsum(lengths[order]) - lengths[order]
        self.order, self.n = order, n
        self.keys = self.symbol[order].astype(np.int64) * (n + 1) + self.start[order]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at p and q, by the substring ranks."""
        p, q, out = p.copy(), q.copy(), np.zeros(len(p), np.int64)
        for level in range(len(self.ranks) - 1, -1, -1):
            rank = self.ranks[level]
            inside = (p < self.n) & (q < self.n)
            same = inside & (rank[np.minimum(p, self.n - 1)] == rank[np.minimum(q, self.n - 1)]) & (p != q)
            step = same.astype(np.int64) << level
            p, q, out = p + step, q + step, out + step
        return out

    def matching(self, patterns: list[np.ndarray]) -> np.ndarray:
        """(pattern, place) -> length of the longest match that starts there; 0 beyond the end."""
        sizes = np.array([len(p) for p in patterns])
        width = int(sizes.max())
        symbols = np.full((len(patterns), width), -1, np.int32)
        for i, p in enumerate(patterns):
            symbols[i, :len(p)] = p
        out = np.zeros((len(patterns), width), np.int32)
        row = np.zeros(len(patterns), np.int64)
        ref = np.full(len(patterns), self.first[0])
        length = np.zeros(len(patterns), np.int64)
        for j in range(width - 1, -1, -1):
            on = np.flatnonzero(sizes > j)
            c = symbols[on, j]
            r, p, k = row[on], ref[on], length[on]
            run = np.searchsorted(self.start, r, "right") - 1
            go = self.symbol[run] == c
            lead, at, size = self.leads[run] + r - self.start[run], p, k
            jump = np.flatnonzero(~go)
            if len(jump):
                # The nearest runs of the symbol on both sides; the one with the longer match.
                cj, pj, kj = c[jump], p[jump], k[jump]
                place = np.searchsorted(self.keys, cj.astype(np.int64) * (self.n + 1) + r[jump])
                up, down = self.order[np.maximum(place - 1, 0)], self.order[np.minimum(place, len(self.order) - 1)]
                has_up = (place > 0) & (self.symbol[up] == cj)
                has_down = (place < len(self.order)) & (self.symbol[down] == cj)
                same_up = np.where(has_up, np.minimum(kj, self.common(pj, self.last[up])), -1)
                same_down = np.where(has_down, np.minimum(kj, self.common(pj, self.first[down])), -1)
                take_up = same_up >= same_down
                best = np.where(take_up, same_up, same_down)
                none = best < 0
                lead[jump] = np.where(none, 0, np.where(
                    take_up, self.leads[up] + self.end[up] - self.start[up], self.leads[down]))
                at[jump] = np.where(none, self.first[0] + 1, np.where(take_up, self.last[up], self.first[down]))
                size[jump] = np.where(none, -1, best)
            row[on], ref[on], length[on] = lead, at - 1, size + 1
            out[on, j] = length[on]
        return out
