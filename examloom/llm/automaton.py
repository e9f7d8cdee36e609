"""Suffix automaton of several sequences, with the least owner of every substring."""

from __future__ import annotations

from collections.abc import Hashable, Sequence

NOBODY = (1 << 63) - 1  # owners are smaller or equal


class SuffixAutomaton:
    """States are classes of substrings that end at the same places; a link leads to the class of
    the longest suffix that ends at more places."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [NOBODY]

    def _state(self, follow: dict, link: int, length: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.owner.append(NOBODY)
        return len(self.next) - 1

    def _split(self, p: int, symbol: Hashable, q: int) -> int:
        """Part of class q that is one symbol longer than p, as a class of its own."""
        part = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = part
            p = self.link[p]
        self.link[q] = part
        return part

    def _target(self, p: int, symbol: Hashable) -> int:
        q = self.next[p][symbol]
        return q if self.length[q] == self.length[p] + 1 else self._split(p, symbol, q)

    def add(self, sequence: Sequence[Hashable], owner: int) -> None:
        follow, links, length, owners = self.next, self.link, self.length, self.owner
        last = 0
        for symbol in sequence:
            if symbol in follow[last]:
                last = self._target(last, symbol)
            else:
                new, p = self._state({}, 0, length[last] + 1), last
                while p >= 0 and symbol not in follow[p]:
                    follow[p][symbol] = new
                    p = links[p]
                if p >= 0:
                    links[new] = self._target(p, symbol)
                last = new
            if owner < owners[last]:
                owners[last] = owner

    def settle(self) -> None:
        """Hand owners down the links, longest classes first; call it after the last `add`."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            link = self.link[state]
            if self.owner[state] < self.owner[link]:
                self.owner[link] = self.owner[state]

    def least_owners(self, sequence: Sequence[Hashable], window: int) -> list[int]:
        """For each run of `window` symbols the least owner of it, NOBODY where there is none.

        The matching statistic of each end, the longest suffix that the automaton holds, is kept up
        to `window` symbols.
        """
        follow, links, length, owners = self.next, self.link, self.length, self.owner
        found, state, matched = [], 0, 0
        for at, symbol in enumerate(sequence):
            step = follow[state].get(symbol)
            while step is None and state:
                state = links[state]
                matched = length[state]
                step = follow[state].get(symbol)
            if step is not None:
                state, matched = step, matched + 1
            if matched > window:
                while length[links[state]] >= window:
                    state = links[state]
                matched = min(matched, length[state])
            if at >= window - 1:
                found.append(owners[state] if matched >= window else NOBODY)
        return found
